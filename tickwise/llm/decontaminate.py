"""Benchmark decontamination by Wu-Manber multi-pattern search.

Texts are lower-cased (A-Z) and reduced to their words, ASCII letters and
digits or any character beyond ASCII, with one space around each. The patterns
are the windows of so many consecutive words of the benchmark items (an item of
fewer words is one window), written in the same form, so that an occurrence of
the bytes is an occurrence of the words.

For the patterns of one length class the tables are those of the method: a
shift table tells for each hashed block of bytes how far the next possible
end of an occurrence lies, positions whose block ends a pattern head select the
bucket of that hash, and bytes are compared directly with each pattern of the
bucket. Many places of the buffer are searched in step, one numpy lane each.

The benchmark is a stated query set. It is cut into blocks of a bounded number
of bytes by a hash of the item, and every text is searched for every block, one
block after another: a block is compiled and broadcast, the places that it hits are
written under the hash of their text, and its broadcast is dropped before the next
one comes. The last block is searched as the result is read, which adds what was
written. So a task, an executor and the driver hold one block, however many there
are; with a single block nothing is written and no text is shuffled.

Defined cases: null or empty texts have no words; a document without words is
not contaminated; repeated rows are answered row by row; an item without words
never occurs; an item with a null id marks words but is not listed; items that
share an id count as one; empty tables give empty results; no other column is
read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwise.llm.common import as_bytes, free_name, received, send, shared, store

WINDOW_WORDS = 10
#: Bytes of item text in one block of the query set.
BLOCK_BYTES = 2_000_000
#: Bytes of normalised text searched at once, and the lanes they are dealt to.
BUFFER_BYTES, LANES = 8_000_000, 16_384
FOUND = "struct<n_words:bigint,spans:array<struct<start:bigint,end:bigint>>,items:array<string>>"

_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32
              for c in range(256))


def normalise(text: bytes) -> bytes:
    """The words of a text with one space before, between and after them."""
    return b" " + b" ".join(text.translate(_FOLD).split()) + b" "


def windows(item: bytes, n: int) -> list[bytes]:
    """The word windows of a text as patterns."""
    words = item.translate(_FOLD).split()
    if not words:
        return []
    return [b" " + b" ".join(words[i:i + n]) + b" " for i in range(max(1, len(words) - n + 1))]


class Matcher:
    """Shift table and suffix buckets for patterns of at least ``m`` bytes."""

    def __init__(self, patterns: list[bytes]):
        self.patterns = patterns
        self.m = m = min(map(len, patterns))
        self.block = b = min(8, max(2, m // 3))
        self.mask = np.uint64((1 << 8 * b) - 1)
        heads = np.frombuffer(b"".join(p[:m] for p in patterns), np.uint8).reshape(-1, m)
        self.bits = min(24, max(12, int(np.ceil(np.log2(len(patterns) * 8 * m + 1)))))
        self.shift = np.full(1 << self.bits, m - b + 1, np.uint8 if m < 256 else np.int32)
        for end in range(b - 1, m):
            np.minimum.at(self.shift, self.slots(self.keys(heads, end)), m - 1 - end)
        self.buckets = defaultdict(list)
        for i, slot in enumerate(self.slots(self.keys(heads, m - 1)).tolist()):
            self.buckets[slot].append(i)
        # the first bytes of a pattern, mixed with its bucket: most places of a bucket go here
        self.first = np.zeros(1 << self.bits, bool)
        self.first[self.slots(self.keys(heads, b - 1) ^ (self.keys(heads, m - 1) << np.uint64(1)))] = True

    def keys(self, heads: np.ndarray, end: int) -> np.ndarray:
        part = np.zeros((len(heads), 8), np.uint8)
        part[:, :self.block] = heads[:, end - self.block + 1:end + 1]
        return part.view("<u8").ravel()

    def slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, buffer: bytes, n: int) -> list[tuple[int, int]]:
        """(start, pattern) of each occurrence in the first ``n`` bytes of
        ``buffer``, which goes on for 8 bytes at least."""
        if n < self.m:
            return []
        words = np.ndarray((len(buffer) - 7,), "<u8", buffer, 0, (1,))
        lanes = min(LANES, n // self.m + 1)
        edges = np.linspace(self.m - 1, n, lanes + 1).astype(np.int64)
        at, stop, ends = edges[:-1], edges[1:], []
        back, first = self.block - 1, self.m - 1
        while len(at):
            keys = words[at - back] & self.mask
            step = self.shift[self.slots(keys)].astype(np.int64)
            if len(hit := np.flatnonzero(step == 0)):
                place, key = at[hit], keys[hit]
                ends.append(place[self.first[self.slots((words[place - first] & self.mask) ^ (key << np.uint64(1)))]])
            at = at + np.maximum(step, 1)
            if not (going := at < stop).all():
                at, stop = at[going], stop[going]
        if not ends:
            return []
        place = np.concatenate(ends)
        slots = self.slots(words[place - back] & self.mask).tolist()
        out = []
        for end, slot in zip(place.tolist(), slots):
            start = end - first
            out += [(start, i) for i in self.buckets[slot] if buffer.startswith(self.patterns[i], start)]
        return out


class Index:
    """Compiled query set: a matcher for each length class, and what a pattern is of."""

    def __init__(self, items: list[tuple[str | None, bytes]], n: int = WINDOW_WORDS):
        owners: dict[bytes, set] = defaultdict(set)
        for item_id, text in items:
            for w in windows(text, n):
                owners[w].add(item_id)
        classes = defaultdict(list)
        for p in owners:
            classes[min(len(p).bit_length(), 6)].append(p)
        self.owners = dict(owners)
        self.matchers = [Matcher(ps) for _, ps in sorted(classes.items())]

    def search(self, texts: list[bytes]) -> list[tuple[int, dict[int, int], set]]:
        """For each normalised text: number of words, hit words as start -> end
        of occurrences (the longest from a start), and the items that occur."""
        starts = np.zeros(len(texts) + 1, np.int64)
        np.cumsum([len(t) + 1 for t in texts], out=starts[1:])
        buffer = b"\n".join([*texts, bytes(8)])
        spaces = np.flatnonzero(np.frombuffer(buffer, np.uint8) == 32)
        first = np.searchsorted(spaces, starts)
        out = [(max(0, t.count(b" ") - 1), {}, set()) for t in texts]
        for m in self.matchers:
            if found := m.find(buffer, int(starts[-1])):
                at = np.array([s for s, _ in found], np.int64)
                docs = np.searchsorted(starts, at, "right") - 1
                words = np.searchsorted(spaces, at) - first[docs]
                for d, w, (_, i) in zip(docs.tolist(), words.tolist(), found):
                    p = m.patterns[i]
                    out[d][1][w] = max(out[d][1].get(w, 0), w + p.count(b" ") - 1)
                    out[d][2].update(self.owners[p])
        return [(0 if t == b"  " else n, hits, items) for t, (n, hits, items) in zip(texts, out)]


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Disjoint spans that cover the same, in order; touching ones become one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _parts(texts, size: int = BUFFER_BYTES) -> Iterator[list[bytes]]:
    part, n = [], 0
    for t in texts:
        part.append(normalise(t))
        n += len(part[-1])
        if n >= size:
            yield part
            part, n = [], 0
    if part:
        yield part


def _search_udf(load):
    """One block for each text, added to what the blocks before it have found."""
    @F.pandas_udf(FOUND)
    def search(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        index = load()
        for texts, old_spans, old_items in batches:
            found = [x for part in _parts(texts) for x in index.search(part)]
            spans = [merged([*((s["start"], s["end"]) for s in old), *hits.items()]) if hits or len(old) else []
                     for old, (_, hits, _) in zip(old_spans, found)]
            yield pd.DataFrame({
                "n_words": [n for n, _, _ in found],
                "spans": [[{"start": a, "end": b} for a, b in x] for x in spans],
                "items": [sorted({*old, *(i for i in items if i is not None)})
                          for old, (_, _, items) in zip(old_items, found)]})
    return search


def query_blocks(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text",
                 block_bytes: int = BLOCK_BYTES) -> Iterator[list[tuple[str | None, bytes]]]:
    """The items, a block at a time; about ``block_bytes`` of text or one item in each."""
    items = benchmark.select(F.col(id_col).cast("string").alias("id"), as_bytes(text_col).alias("text"))
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = int(total // block_bytes) + 1
    for b in range(n):
        rows = items.filter(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == b).collect()
        yield [(r["id"], bytes(r["text"])) for r in rows]


def _found_before(docs: DataFrame, hits: list[DataFrame], key: str, old: str) -> DataFrame:
    """``docs`` with spans and items, in ``old``, that earlier blocks have found in texts of that
    key. Texts that are hit have one row each on the right, so a text of many copies costs no
    more there, and Spark may split its copies on the left."""
    @F.pandas_udf("array<struct<start:bigint,end:bigint>>")
    def joined(parts: pd.Series) -> pd.Series:
        return pd.Series([[{"start": a, "end": b} for a, b in merged([(s["start"], s["end"]) for s in x])] for x in parts])
    rows = reduce(DataFrame.unionByName, hits)
    one = rows.groupBy(key).agg(F.flatten(F.collect_list("spans")).alias("spans"), F.flatten(F.collect_list("items")).alias("items"))
    return docs.join(one.select(key, F.struct(joined("spans").alias("spans"), F.array_distinct("items").alias("items")).alias(old)),
                     key, "left")


def search(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", out_col: str = "found",
           window_words: int = WINDOW_WORDS, id_col: str = "item_id", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with what of the benchmark occurs in each whole text: struct n_words, spans
    (disjoint hit word ranges, end exclusive), items (ids as sorted strings)."""
    spans, items = (f"array<{t}>" for t in ("struct<start:bigint,end:bigint>", "string"))
    text, key, old = as_bytes(text_col), free_name(docs, "text_key"), free_name(docs, "found_before")
    nothing = F.array().cast(spans), F.array().cast(items)
    blocks, hits = query_blocks(benchmark, id_col, block_bytes=block_bytes), []
    block = next(blocks)
    for following in blocks:
        sent = send(benchmark, Index(block, window_words))
        found = docs.select(F.sha2(text, 256).alias(key), _search_udf(received(sent))(text, *nothing).alias("f"))
        hits.append(store(found.filter(F.size("f.spans") > 0).select(key, "f.spans", "f.items").dropDuplicates([key]),
                          "benchmark-hits"))
        sent.destroy()
        block = following
    last = _search_udf(shared(benchmark, Index(block, window_words)))
    if not hits:
        return docs.withColumn(out_col, last(text, *nothing))
    before = _found_before(docs.withColumn(key, F.sha2(text, 256)), hits, key, old)
    known = F.coalesce(F.col(old)["spans"], nothing[0]), F.coalesce(F.col(old)["items"], nothing[1])
    return before.withColumn(out_col, last(text, *known)).drop(key, old)


def hit_words(found: Column) -> Column:
    """Number of words inside occurrences."""
    return F.aggregate(found["spans"], F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])
