"""Repeated byte strings across documents, by suffixes sorted deep-shallow.

Every byte is removed that a string of SPAN bytes covers which also starts in a
document with a smaller id. Strings never cross documents, overlaps count, and
strings are judged on the input.

Only suffixes that can repeat are sorted:

1. Every string of SPAN bytes is assigned to its anchor, the leftmost of its
   20-byte grams with the least hash. Equal strings have equal anchors, so a
   string can repeat only if the anchor's gram occurs in two documents. Anchors
   that repeat in one batch are proven there; one row per gram and batch goes on,
   sorted by gram, and a task sees in passing which grams repeat.
2. The documents of repeated anchors send, for each, the bytes of the strings
   assigned to it. Equal contexts of a batch are combined before the shuffle: the one
   of the smallest id goes on, the others are covered whole.
3. Equal contexts of a gram are one set of suffixes with several owners. The suffixes
   of a gram's sets, where it has more than one, are sorted to SPAN bytes: multikey sorting by eight bytes at
   a time to a shallow depth, then blind tries for groups that are still equal.
   Suffixes that end in one leaf are equal strings, and the smallest id among their
   owners covers all others.

Equal texts are found by two hashes beforehand: of equal texts all but those of
the smallest id are repeated whole, and take no part in 2 and 3.

Defined cases: a null or empty text has no bytes; texts shorter than SPAN lose
nothing; rows that share an id never remove bytes of one another, and each is
searched for itself; a null id is larger than all others, null ids do not remove
bytes of one another; an empty table gives an empty result; other columns are not
read. Kept bytes need not be valid UTF-8.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwise.llm.common import as_bytes, release, store
from tickwise.llm.minhash import mix

SPAN, GRAM = 50, 20
#: Depth to which suffixes are sorted before blind tries take over.
SHALLOW = 16
#: Bytes of text whose anchors are found at once, and contexts sorted at once.
BUFFER_BYTES, CONTEXTS = 2_000_000, 20_000
NO_ID = (1 << 63) - 1


def gram_hashes(buffer: bytes, n: int) -> np.ndarray:
    """A hash of the GRAM bytes from each of the first ``n`` places of
    ``buffer``, which goes on for GRAM bytes at least."""
    words = np.ndarray((len(buffer) - 7,), "<u8", buffer, 0, (1,))
    h = np.full(n, 0x9E3779B97F4A7C15, np.uint64)
    for at in sorted({*range(0, GRAM - 7, 8), GRAM - 8}):
        h = mix(h * np.uint64(0xD6E8FEB86659FD93) + words[at:at + n])
    return h


def _leftmost_least(h: np.ndarray, width: int) -> np.ndarray:
    """For each start of ``width`` places, the first place of the least hash."""
    value, place, size = h, np.arange(len(h), dtype=np.int32), 1

    def join(step: int) -> None:
        nonlocal value, place
        right = value[step:] < value[:-step]
        place = np.where(right, place[step:], place[:-step])
        value = np.where(right, value[step:], value[:-step])
    while size * 2 <= width:
        join(size)
        size *= 2
    if width > size:
        join(width - size)
    return place


def anchors(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """Text number, hash, place of the gram, first and last start of the strings
    of each anchor; places count from the start of the text."""
    lengths = np.array([len(t) for t in texts], np.int64)
    starts = np.cumsum(lengths) - lengths
    n = int(lengths.sum())
    if n < SPAN:
        return (np.zeros(0, np.int64), np.zeros(0, np.uint64), *[np.zeros(0, np.int64)] * 3)
    h = gram_hashes(b"".join([*texts, bytes(SPAN)]), n)
    least = _leftmost_least(h, SPAN - GRAM + 1)
    edge = np.zeros(n + 1, np.int64)
    has = lengths >= SPAN
    np.add.at(edge, starts[has], 1)
    np.add.at(edge, (starts + lengths - SPAN + 1)[has], -1)
    s = np.flatnonzero(edge.cumsum()[:-1] > 0)
    if not len(s):
        return (np.zeros(0, np.int64), np.zeros(0, np.uint64), *[np.zeros(0, np.int64)] * 3)
    place = least[s].astype(np.int64)
    first = np.flatnonzero(np.r_[True, (place[1:] != place[:-1]) | (s[1:] != s[:-1] + 1)])
    last = np.r_[first[1:] - 1, len(s) - 1]
    doc = np.searchsorted(starts, s[first], "right") - 1
    # an empty text starts where the next one does; the text of a start is the last that begins there
    base = starts[doc]
    return doc, h[place[first]], place[first] - base, s[first] - base, s[last] - base


def _parts(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    begin, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= BUFFER_BYTES:
            yield begin, i + 1
            begin, size = i + 1, 0
    if begin < len(texts):
        yield begin, len(texts)


def _runs(keys: np.ndarray) -> np.ndarray:
    """Starts of the runs of equal numbers, and the end."""
    return np.r_[np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]), len(keys)] if len(keys) else np.zeros(1, np.int64)


_ANCHORS = pa.schema([("key", pa.int64()), ("id", pa.int64()), ("at", pa.int32())])
MARK = -1  # in ``at``: the gram repeats; below it, -2 - place of an anchor already known to repeat


def _emit_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, texts = batch.column("id").to_numpy(zero_copy_only=False), batch.column("data").to_pylist()
        for a, b in _parts(texts):
            doc, h, at, _, _ = anchors(texts[a:b])
            if not len(doc):
                continue
            order = np.argsort(h, kind="stable")
            key, who, at = h[order].view(np.int64), ids[a:b][doc[order]], at[order]
            runs = _runs(key)
            low, high = (f.reduceat(who, runs[:-1]) for f in (np.minimum, np.maximum))
            twice = np.repeat(low < high, np.diff(runs))
            marks = key[runs[:-1]][low < high]
            spread = mix(who[twice].view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + at[twice].astype(np.uint64))
            yield pa.record_batch([
                np.concatenate([key[~twice], marks, spread.view(np.int64)]),
                np.concatenate([who[~twice], np.zeros(len(marks), np.int64), who[twice]]),
                np.concatenate([at[~twice], np.full(len(marks), MARK), -2 - at[twice]]).astype(np.int32)], schema=_ANCHORS)


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows sorted by key: id, at of the anchors whose gram is in two documents.
    Of the gram that a batch ends in, its least and greatest id are kept; its anchors
    wait only as long as all of them are of one document."""
    out = pa.schema([("id", pa.int64()), ("at", pa.int32())])
    bounds = np.iinfo(np.int64)
    last, least, most, marked = None, bounds.max, bounds.min, False
    waiting: list[tuple[np.ndarray, np.ndarray]] = []
    for batch in batches:
        key, who, at = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
        if not len(key):
            continue
        runs, single = _runs(key), at >= 0
        mark = np.logical_or.reduceat(at == MARK, runs[:-1])
        low = np.minimum.reduceat(np.where(single, who, bounds.max), runs[:-1])
        high = np.maximum.reduceat(np.where(single, who, bounds.min), runs[:-1])
        if key[0] == last:
            mark[0], low[0], high[0] = mark[0] | marked, min(low[0], least), max(high[0], most)
        else:
            waiting = []
        twice = mark | (low < high)
        known = (at < MARK) | single & np.repeat(twice, np.diff(runs))
        found = [*(waiting if twice[0] else []), (who[known], at[known])]
        if twice[0] or len(runs) > 2:
            waiting = []
        if not twice[-1]:
            own = np.flatnonzero(single[runs[-2]:]) + runs[-2]
            waiting.append((who[own], at[own]))
        last, least, most, marked = key[-1], low[-1], high[-1], mark[-1]
        ids, places = (np.concatenate(c) for c in zip(*found))
        yield pa.record_batch([ids, np.where(places < 0, -2 - places, places).astype(np.int32)], schema=out)


def blind_trie(strings: list[bytes]) -> list[list[int]]:
    """Numbers of equal strings together, the groups in byte order. The strings
    are of one length. A node tells at which place its strings differ; on the
    way down only such places are looked at, and one comparison at the leaf
    tells where the string leaves the trie."""
    root: list = [None, strings[0], [0]]  # a leaf: None, string, numbers; a node: place, children
    for number, s in enumerate(strings[1:], 1):
        node = root
        while node[0] is not None:
            node = node[1].get(s[node[0]]) or next(iter(node[1].values()))
        if node[1] == s:
            node[2].append(number)
            continue
        other = node[1]
        place = next(i for i in range(len(s)) if s[i] != other[i])
        node = root
        while node[0] is not None and node[0] < place:
            node = node[1][s[node[0]]]
        leaf = [None, s, [number]]
        if node[0] == place:
            node[1][s[place]] = leaf
        else:
            node[:] = [place, {other[place]: list(node), s[place]: leaf}]
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        if node[0] is None:
            out.append(node[2])
        else:
            stack += [node[1][c] for c in sorted(node[1], reverse=True)]
    return out


def sort_suffixes(buffer: bytes, starts: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes by group and SPAN bytes, and for each place of that
    order the number of its class of equal strings. ``buffer`` goes on for SPAN
    bytes at least after each start."""
    words = np.ndarray((len(buffer) - 7,), ">u8", buffer, 0, (1,))
    order = np.argsort(group, kind="stable")
    segment = np.cumsum(np.r_[True, group[order][1:] != group[order][:-1]]) if len(order) else group
    for depth in range(0, SHALLOW, 8):
        symbol = words[starts[order] + depth].astype(np.uint64)
        step = np.lexsort((symbol, segment))
        order, symbol, segment = order[step], symbol[step], segment[step]
        segment = np.cumsum(np.r_[True, (segment[1:] != segment[:-1]) | (symbol[1:] != symbol[:-1])])
    runs = _runs(segment)
    sizes = np.diff(runs)
    # a group whose suffixes all equal its first one would be a trie of one leaf
    place = starts[order]
    first = np.repeat(place[runs[:-1]], sizes)
    same = np.ones(len(order), bool)
    for depth in sorted({*range(SHALLOW, SPAN - 7, 8), SPAN - 8}):
        same &= words[place + depth] == words[first + depth]
    one = np.logical_and.reduceat(same, runs[:-1]) if len(order) else np.zeros(0, bool)
    label, count = np.repeat(one.cumsum() - 1, sizes), int(one.sum())
    at = (place + SHALLOW).tolist()
    for a, b in zip(runs[:-1][~one].tolist(), runs[1:][~one].tolist()):
        leaves = blind_trie([buffer[x:x + SPAN - SHALLOW] for x in at[a:b]])
        if len(leaves) > 1:
            order[a:b] = order[a:b][[i for leaf in leaves for i in leaf]]
        for leaf in leaves:
            label[a:a + len(leaf)] = count
            count += 1
            a += len(leaf)
    return order, label


_CONTEXTS = pa.schema([("key", pa.int64()), ("id", pa.int64()), ("t", pa.int64()), ("lo", pa.int32()),
                       ("n", pa.int32()), ("context", pa.binary())])
_SPANS = pa.schema([("id", pa.int64()), ("t", pa.int64()), ("lo", pa.int32()), ("n", pa.int32())])


def _emit_contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The contexts of the wanted anchors; those of a batch that a smaller id has too
    become spans at once (no context, a key that spreads them)."""
    for batch in batches:
        ids, ts = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("id", "t"))
        texts, wanted = batch.column("data").to_pylist(), batch.column("ats")
        for a, b in _parts(texts):
            doc, h, at, lo, hi = anchors(texts[a:b])
            places = wanted.slice(a, b - a)
            owner = np.repeat(np.arange(b - a), pc.list_value_length(places).fill_null(0).to_numpy())
            chosen = np.isin(doc * (1 << 32) + at, owner * (1 << 32) + places.flatten().to_numpy())
            doc, key, lo, hi = doc[chosen], h[chosen].view(np.int64).tolist(), lo[chosen], hi[chosen]
            who, t, doc, lo, hi = ids[a:b][doc], ts[a:b][doc], doc.tolist(), lo.tolist(), (hi + SPAN).tolist()
            contexts = [texts[a + d][x:y] for d, x, y in zip(doc, lo, hi)]
            least: dict[tuple[int, bytes], int] = {}
            for k, c, i in zip(key, contexts, who.tolist()):
                if least.get((k, c), NO_ID) >= i:
                    least[k, c] = i
            known = np.array([least[k, c] < i for k, c, i in zip(key, contexts, who.tolist())], bool)
            yield pa.record_batch([
                pa.array(np.where(known, t ^ np.array(lo, np.int64), np.array(key, np.int64))), pa.array(who), pa.array(t),
                pa.array(lo, pa.int32()), pa.array([len(c) for c in contexts], pa.int32()),
                pa.array([None if k else c for k, c in zip(known.tolist(), contexts)], pa.binary())], schema=_CONTEXTS)


def _covered(rows: list[tuple]) -> list[tuple[int, int, int, int]]:
    """Spans (id, t, lo, n) from whole groups of (key, id, t, lo, n, context). Equal
    contexts of a gram are one set of suffixes with all of its owners; the suffixes of
    a gram's sets are sorted, and the least id of a leaf covers the others that are in it."""
    out: list[tuple[int, int, int, int]] = []
    of_key: dict[int, dict[bytes, list]] = {}
    for r in rows:
        of_key.setdefault(r[0], {}).setdefault(r[5], []).append(r)
    several = []
    for sets in of_key.values():
        if len(sets) > 1:
            if len({r[1] for owners in sets.values() for r in owners}) > 1:
                several.append(sets)
        else:  # all leaves have the same owners, there is nothing to sort
            owners = next(iter(sets.values()))
            if len(owners) > 1:
                least = min(r[1] for r in owners)
                out += [r[1:5] for r in owners if r[1] > least]
    mine = [c for sets in several for c in sets.items()]
    if not mine:
        return out
    buffer = b"".join([*(context for context, _ in mine), bytes(SPAN)])
    sizes = np.array([len(context) for context, _ in mine])
    windows = sizes - SPAN + 1
    begin = np.cumsum(windows) - windows
    own = np.repeat(np.arange(len(mine)), windows)
    offset = np.arange(len(own)) - np.repeat(begin, windows)
    group = np.repeat(np.arange(len(several)), [len(sets) for sets in several])[own]
    order, label = sort_suffixes(buffer, (np.cumsum(sizes) - sizes)[own] + offset, group)
    ids = np.array([min(r[1] for r in owners) for _, owners in mine])[own]
    least = np.full(label.max() + 1, NO_ID)
    np.minimum.at(least, label, ids[order])
    of_leaf = np.empty(len(own), np.int64)
    of_leaf[order] = least[label]
    greatest = np.maximum.reduceat(of_leaf, begin)
    # runs of places in a set whose leaf has a smaller id than every owner of the set
    at = np.flatnonzero(of_leaf < ids)
    cut = np.flatnonzero(np.r_[True, (at[1:] != at[:-1] + 1) | (own[at[1:]] != own[at[:-1]])]) if len(at) else at
    runs: dict[int, list[tuple[int, int]]] = {}
    for x, y in zip(at[cut].tolist(), at[np.r_[cut[1:] - 1, len(at) - 1]].tolist() if len(at) else []):
        runs.setdefault(int(own[x]), []).append((int(offset[x]), int(y - x) + SPAN))
    for i, ((_, owners), top) in enumerate(zip(mine, greatest.tolist())):
        for r in owners:
            if top < r[1]:
                out.append(r[1:5])
            else:  # the owner with the least id
                out += [(r[1], r[2], r[3] + x, n) for x, n in runs.get(i, [])]
    return out


def _sorted_contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From contexts sorted by key: the covered spans. Rows without a context are spans
    already and pass."""
    rows: list[tuple] = []

    def spans(part: list[tuple]) -> pa.RecordBatch:
        found = _covered(part)
        columns = list(zip(*found)) if found else [[]] * 4
        return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, _SPANS)], schema=_SPANS)
    for batch in batches:
        has = pc.is_valid(batch.column(5))
        passing = batch.filter(pc.invert(has))
        yield pa.record_batch([passing.column(i) for i in range(1, 5)], schema=_SPANS)
        batch = batch.filter(has)
        rows += zip(*(batch.column(i).to_pylist() for i in range(6)))
        if len(rows) >= CONTEXTS:
            last = rows[-1][0]
            end = next((i for i in range(len(rows) - 1, -1, -1) if rows[i][0] != last), -1) + 1
            yield spans(rows[:end])
            rows = rows[end:]
    yield spans(rows)


def _ddl(schema: pa.Schema) -> str:
    kinds = {pa.int64(): "long", pa.int32(): "int", pa.binary(): "binary"}
    return ", ".join(f"{f.name} {kinds[f.type]}" for f in schema)


def repeated_anchors(rows: DataFrame) -> DataFrame:
    """id, ats: the places of the document's anchors whose gram is in two documents."""
    found = (rows.select("id", "data").mapInArrow(_emit_anchors, _ddl(_ANCHORS)).repartition("key")
             .sortWithinPartitions("key").mapInArrow(_repeated, "id long, at int"))
    return found.groupBy("id").agg(F.collect_list("at").alias("ats"))


def sorted_spans(rows: DataFrame, wanted: DataFrame, copies: DataFrame) -> DataFrame:
    """id, t, spans covered by smaller ids, of rows that are no whole copies."""
    own = rows.select("id", "t", "data").join(wanted, "id").join(copies, ["id", "t"], "left_anti")
    spans = (own.mapInArrow(_emit_contexts, _ddl(_CONTEXTS)).repartition("key").sortWithinPartitions("key")
             .mapInArrow(_sorted_contexts, _ddl(_SPANS)))
    return spans.groupBy("id", "t").agg(F.collect_list(F.struct("lo", "n")).alias("spans"))


def repeated_spans(rows: DataFrame) -> DataFrame:
    """id, t, spans (lo, n; overlapping, unsorted) of ``rows`` (id, t, u, data);
    ``u`` is a second hash of the text. Whole repeated texts have a null for spans."""
    spark = rows.sparkSession
    seen = store(rows.select("id", "t", "u"), "suffix-texts")
    least = store(seen.groupBy("t", "u").agg(F.min("id").alias("least"), F.max("id").alias("most"))
                  .filter("least < most").select("t", "u", "least"), "suffix-copies")
    copies = store(seen.join(least, ["t", "u"]).filter("id > least").select("id", "t").distinct(), "suffix-whole")
    wanted = store(repeated_anchors(rows), "suffix-anchors")
    release(spark)
    merged = store(sorted_spans(rows, wanted, copies), "suffix-spans")
    release(spark)
    return merged.unionByName(copies.withColumn("spans", F.lit(None).cast("array<struct<lo:int,n:int>>")))


def cut(data: bytes, spans: list[tuple[int, int]]) -> tuple[list[tuple[int, int]], bytes]:
    """Maximal removed runs (start, end), and the bytes that stay."""
    runs: list[tuple[int, int]] = []
    for lo, n in sorted(spans):
        if runs and lo <= runs[-1][1]:
            runs[-1] = (runs[-1][0], max(runs[-1][1], lo + n))
        else:
            runs.append((lo, lo + n))
    ends = [0, *(b for _, b in runs)]
    return runs, b"".join(data[a:b] for a, b in zip(ends, [*(a for a, _ in runs), len(data)]))


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_bytes, runs (start, end of each removed run, end exclusive) and kept
    (the remaining bytes), one row for each row of ``docs``."""
    rows = docs.select(F.col(id_col).alias("given"), as_bytes(text_col).alias("data")).select(
        "given", F.coalesce(F.col("given").cast("long"), F.lit(NO_ID)).alias("id"), F.xxhash64("data").alias("t"),
        F.xxhash64(F.lit("second"), "data").alias("u"), "data")
    spans = repeated_spans(rows.drop("given")).withColumn("found", F.lit(True))

    @F.pandas_udf("struct<n_bytes:long,runs:array<struct<start:int,end:int>>,kept:binary>")
    def remove(data: pd.Series, found: pd.Series, spans: pd.Series) -> pd.DataFrame:
        out = []
        for d, f, s in zip(data, found, spans):
            if f and s is None:
                s = [{"lo": 0, "n": len(d)}] if len(d) >= SPAN else []
            runs, kept = cut(d, [(x["lo"], x["n"]) for x in s]) if f and len(s) else ([], d)
            out.append((len(d), [{"start": a, "end": b} for a, b in runs], kept))
        return pd.DataFrame(out, columns=["n_bytes", "runs", "kept"])

    whole = rows.select("given", "id", "t", "data").join(spans, ["id", "t"], "left")
    return whole.select(F.col("given").alias("id"), remove("data", F.coalesce("found", F.lit(False)), "spans").alias("r")).select("id", "r.*")
