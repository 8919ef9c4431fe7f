"""Near-duplicate documents by SuperMinHash, banding, verification and union-find.

Texts are lower-cased (A-Z), and a document's set is its distinct word shingles,
as 64-bit hashes. Documents with equal sets form one class and are collapsed
before anything is compared, so copies cost nothing further.

A SuperMinHash signature is made level by level: at level j every element takes
the j-th step of its own random permutation of the slots and offers j plus a
random part for the slot it reaches. The ranks of one element are correlated, so
signatures vary less than with independent hashes, and a document stops at the
first level that leaves no slot which the next could lower.

Classes that agree in a band share a bucket. Links are confirmed on full sets
with integers, and components are grown in two steps, each of which compares only
what is not yet known to be connected:

1. every class with the first member of its buckets that it meets most often, where
   the sizes of the two sets allow the similarity;
2. in buckets that still hold several components, all members of different ones.
   Buckets that hang together are compared as one where that sends fewer shingles. A
   unit of either kind is cut into blocks of about BLOCK_TOKENS shingles, and a task
   gets two blocks of it with their full sets. It counts the shingles that sets have
   in common through the shingles' posting lists, joins by union-find as it goes, and
   puts out links only. What travels grows with the pairs of blocks, not of members;
   the counting in tasks does grow with the square of a group that stays unlinked.

No step drops a candidate. Links become components by union-find in every task
and by minimum labels with pointer jumping across tasks; every round is written
to the shared folder.

Defined cases: a text without words (null, empty, white space) has an empty set
and is linked with nothing; fewer words than a shingle make one shingle; rows
that share an id keep their own sets and are members of their own classes; a
null id counts only if all ids of a component are null, and is then its
representative; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwise.llm.common import as_bytes, store

SHINGLE_WORDS, PERCENT = 5, 80
#: Slots of a signature; 32 bands of 4 miss a pair of similarity 0.8 once in 20 million.
SLOTS, BANDS = 128, 32
#: Shingles of a block of a bucket's members: 8 MB of sets.
BLOCK_TOKENS = 1_000_000
#: Elements whose signatures are made at once.
ELEMENTS = 200_000


def shingles(text: bytes, n: int) -> np.ndarray:
    """The sorted distinct shingle hashes of a text in UTF-8."""
    import xxhash

    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    flat = b" ".join(words)
    if len(words) <= n:
        return np.array([xxhash.xxh3_64_intdigest(flat)], np.uint64)
    spaces = np.flatnonzero(np.frombuffer(flat, np.uint8) == 32)
    starts = [0, *(spaces[:len(words) - n] + 1).tolist()]
    ends = [*spaces[n - 1:].tolist(), len(flat)]
    digest = xxhash.xxh3_64_intdigest
    return np.unique(np.fromiter((digest(flat[a:b]) for a, b in zip(starts, ends)), np.uint64, len(starts)))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def signatures(sets: list[np.ndarray], slots: int = SLOTS) -> np.ndarray:
    """One row of ``slots`` numbers for each set; level in the upper half, the
    random part below. Rows of empty sets stay at the largest number."""
    out = np.full((len(sets), slots), np.iinfo(np.uint64).max, np.uint64)
    flat = out.reshape(-1)
    element = np.concatenate([np.zeros(0, np.uint64), *sets])
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = None
    for level in range(slots):
        if not len(element):
            break
        draw = mix(element + np.uint64((2 * level + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        pick = level + ((draw & np.uint64(0xFFFFFFFF)) * np.uint64(slots - level) >> np.uint64(32)).astype(np.int64)
        if level == 0:
            slot = pick
        else:
            rows = np.arange(len(element))
            slot = order[rows, pick].astype(np.int64)
            order[rows, pick] = order[rows, level]
        np.minimum.at(flat, owner * slots + slot, np.uint64(level << 32) | draw >> np.uint64(32))
        # a document goes on while some slot could still be lowered by the next level
        open_ = (out.max(1) >> np.uint64(32)) > level
        going = open_[owner]
        if level == 0:
            element, owner, first = element[going], owner[going], pick[going]
            order = np.tile(np.arange(slots, dtype=np.uint8 if slots <= 256 else np.int32), (len(element), 1))
            order[np.arange(len(element)), first] = 0
        elif not going.all():
            element, owner, order = element[going], owner[going], order[going]
    return out


def band_keys(signs: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """One key for each band of each signature; keys of different bands differ."""
    parts = signs.reshape(len(signs), bands, -1)
    keys = np.broadcast_to(mix(np.arange(1, bands + 1, dtype=np.uint64)), (len(signs), bands)).copy()
    for i in range(parts.shape[2]):
        keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, i])
    return keys.view(np.int64)


def _pieces(texts, n: int) -> Iterator[list[np.ndarray]]:
    part, size = [], 0
    for t in texts:
        part.append(shingles(t, n))
        size += len(part[-1])
        if size >= ELEMENTS:
            yield part
            part, size = [], 0
    if part:
        yield part


def sketch_column(text: Column, words: int) -> Column:
    """struct: n (size of the set), digest (of the set), bands (keys; none of an empty set)."""
    @F.pandas_udf("struct<n:bigint,digest:binary,bands:array<bigint>>")
    def sketch(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        import xxhash
        for texts in batches:
            for sets in _pieces(texts, words):
                keys = band_keys(signatures(sets))
                yield pd.DataFrame({"n": [len(s) for s in sets],
                                    "digest": [xxhash.xxh3_128_digest(s.tobytes()) for s in sets],
                                    "bands": [k if len(s) else k[:0] for s, k in zip(sets, keys)]})
    return sketch(text)


def _by_shuffle(left: DataFrame, right: DataFrame, on: str) -> DataFrame:
    """A join that is planned alike at every size: neither side has a bound, so none is broadcast."""
    return left.join(right.hint("merge"), on)


def confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """a, b of the pairs whose full sets are similar enough. ``a`` is a bucket's first member."""
    @F.pandas_udf("boolean")
    def similar(left: pd.Series, right: pd.Series) -> pd.Series:
        out = []
        for x, y in zip(left, right):
            both = len(np.intersect1d(x, y, assume_unique=True))
            out.append(100 * both >= percent * (len(x) + len(y) - both))
        return pd.Series(out, dtype=bool)

    own = sets.filter("is_first").select(F.col("node").alias("a"), F.col("tokens").alias("set_a"))
    other = sets.select(F.col("node").alias("b"), F.col("tokens").alias("set_b"))
    return _by_shuffle(_by_shuffle(pairs, other, "b"), own, "a").filter(similar("set_a", "set_b")).select("a", "b")


def links_inside(nodes: np.ndarray, labels: np.ndarray, sets: list[np.ndarray], sides: np.ndarray, percent: int
                 ) -> list[tuple[int, int]]:
    """Links between members of one bucket that join its components. ``sides``: with two of
    them (two blocks), only members of different sides are compared. The members
    of the largest component are not compared with one another."""
    _, group = np.unique(labels, return_inverse=True)
    top = list(range(group.max() + 1))

    def root(x: int) -> int:
        while top[x] != x:
            top[x] = top[top[x]]
            x = top[x]
        return x
    sizes = np.array([len(x) for x in sets], np.int64)
    tokens, row = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
    holders = row[np.argsort(tokens, kind="stable")]       # posting lists, one after another
    _, place, many = np.unique(tokens, return_inverse=True, return_counts=True)
    first = np.cumsum(many) - many
    ends = np.cumsum(sizes)
    main = np.bincount(group).argmax()
    two = sides.min() != sides.max()
    out = []
    for i in np.flatnonzero(group != main).tolist():
        mine = place[ends[i] - sizes[i]:ends[i]]
        n, start = many[mine], first[mine]
        n, start = n[n > 1], start[n > 1]
        if not len(n):
            continue
        at = np.repeat(start - (np.cumsum(n) - n), n) + np.arange(n.sum())
        both = np.bincount(holders[at], minlength=len(sets))
        near = 100 * both >= percent * (sizes[i] + sizes - both)
        near[i] = False
        if two:
            near &= sides != sides[i]
        for j in np.flatnonzero(near).tolist():
            x, y = root(group[i]), root(group[j])
            if x != y:
                top[y] = x
                out.append((int(nodes[i]), int(nodes[j])))
    return out


def links_of_buckets(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """a, b: links that join the components inside the units of ``_open_units``."""
    blocks = F.ceil(F.col("total") / BLOCK_TOKENS).cast("int")
    mine = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    placed = members.withColumn("blocks", blocks).withColumn("block", mine)
    other = placed.select("whole", "key", "node", "label", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    unit = ["whole", "key", "low", "high"]
    rows = (other.select("whole", "key", "node", "label", "block", F.least("block", "other").alias("low"),
                         F.greatest("block", "other").alias("high")))
    rows = _by_shuffle(rows, sets.select("node", "tokens"), "node").repartition(*unit).sortWithinPartitions(*unit)

    def compare(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, known = [], None

        def links() -> pd.DataFrame:
            part = pd.concat(held) if len(held) > 1 else held[0]
            found = links_inside(part["node"].to_numpy(), part["label"].to_numpy(), list(part["tokens"]),
                                 part["block"].to_numpy(), percent) if part["label"].nunique() > 1 else []
            return pd.DataFrame(found, columns=["a", "b"]).astype("int64")
        for frame in frames:
            change = np.flatnonzero((frame[unit] != frame[unit].shift()).any(axis=1))
            for begin, end in zip(change, [*change[1:], len(frame)]):
                part = frame.iloc[begin:end]
                mark = tuple(part[unit].iloc[0])
                if held and mark != known:
                    yield links()
                    held = []
                known = mark
                held.append(part)
        if held:
            yield links()
    return rows.select(*unit, "node", "label", "block", "tokens").mapInPandas(compare, "a long, b long")


def forest(links: DataFrame) -> DataFrame:
    """Fewer links with the same components: every task joins its own by union-find."""
    def contract(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        above: dict[int, int] = {}

        def root(x: int) -> int:
            top = x
            while above.get(top, top) != top:
                top = above[top]
            while x != top:
                above[x], x = top, above.get(x, top)
            return top
        for frame in frames:
            for a, b in zip(frame["a"].tolist(), frame["b"].tolist()):
                x, y = root(a), root(b)
                above[max(x, y)] = min(x, y)
        ends = [x for x in above if root(x) != x]
        yield pd.DataFrame({"a": np.array(ends, np.int64), "b": np.array([above[x] for x in ends], np.int64)})
    return links.mapInPandas(contract, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """node, label (least node of its component) of all nodes that have a link.
    Every round takes the least label among a node and its neighbours, and then
    the label of that label; labels only fall, so an equal sum ends the rounds."""
    spread = forest(links)
    back = spread.select(F.col("b").alias("a"), F.col("a").alias("b"))
    ends = spread.select("a", F.col("a").alias("b")).unionByName(back.select("a", F.col("a").alias("b")))
    edges = store(spread.unionByName(back).unionByName(ends).distinct(), "near-edges")
    state = store(edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("label")), "near-labels")
    before = None
    while (total := state.agg(F.sum(F.col("label").cast("decimal(38,0)"))).first()[0]) != before:
        before = total
        theirs = state.select(F.col("node").alias("b"), "label")
        least = edges.join(theirs, "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("label"))
        jump = state.select(F.col("node").alias("label"), F.col("label").alias("further"))
        state = store(least.join(jump, "label").select("node", F.col("further").alias("label")), "near-labels")
    return state


def _labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """``rows`` of nodes with the label of each, its own number while it has no link."""
    return rows.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))


def _open_units(members: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """whole, key, node, label, total (shingles) of the members of what is compared: buckets that
    hold several components (but none of two members whose sizes rule a link out), or
    all buckets that hang together, as one, where that sends fewer shingles."""
    rows = store(_labelled(members, labels), "near-members")
    buckets = store(rows.groupBy("key").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("size"), F.min("node").alias("first"),
                                            F.min("n").alias("least"), F.max("n").alias("most"),
                                            F.min("label").alias("low"), F.max("label").alias("high"))
                    .filter((F.col("low") != F.col("high"))
                            & ((F.col("size") > 2) | (F.col("least") * 100 >= F.col("most") * percent)))
                    .select("key", "total", "first"), "near-open")
    rows = store(rows.join(buckets, "key"), "near-open-members")
    groups = components(rows.filter("node <> first").select(F.col("node").alias("a"), F.col("first").alias("b"))).select(
        "node", F.col("label").alias("group"))

    def sent(total: str):
        return F.col(total) * F.ceil(F.col(total) / BLOCK_TOKENS)
    apart = (buckets.join(groups.withColumnRenamed("node", "first"), "first").groupBy("group")
             .agg(F.sum(sent("total")).alias("apart")))
    nodes = rows.select("node", "label", "n").distinct().join(groups, "node")
    whole = nodes.groupBy("group").agg(F.sum("n").alias("all"))
    chosen = store(whole.join(apart, "group").select("group", "all", (sent("all") <= F.col("apart")).alias("whole")), "near-groups")
    one = nodes.join(chosen.filter("whole"), "group").select("whole", F.col("group").alias("key"), "node", "label", F.col("all").alias("total"))
    each = rows.join(groups, "node").join(chosen.filter("NOT whole"), "group").select("whole", "key", "node", "label", "total")
    return one.unionByName(each)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE_WORDS,
                    percent: int = PERCENT) -> DataFrame:
    """id, t (hash of the text), n_shingles, component_id (least id of the
    component) and class_id (number of the class of equal sets, -1 without
    words), one row for each row of ``docs``."""
    rows = docs.select(F.col(id_col).alias("id"), as_bytes(text_col).alias("text"))
    t = F.xxhash64("text")
    sketched = store(rows.select("id", t.alias("t"), sketch_column(F.col("text"), words).alias("s"))
                     .select("id", "t", "s.*"), "near-sketches")
    full = sketched.filter("n > 0")
    classes = store(full.groupBy("digest").agg(F.min("id").alias("least"), F.min("t").alias("t"), F.any_value("n").alias("n"),
                                               F.any_value("bands").alias("bands"))
                    .withColumn("node", F.monotonically_increasing_id()), "near-classes")
    members = classes.select("node", "n", F.explode("bands").alias("key"))
    first = store(members.groupBy("key").agg(F.min(F.struct("node", "n")).alias("first"), F.count(F.lit(1)).alias("c"))
                  .filter("c > 1").select("key", "first"), "near-buckets")
    shared = store(members.join(first, "key"), "near-shared")
    needed = store(shared.groupBy("node").agg(F.max(F.col("node") == F.col("first.node")).alias("is_first"))
                   .join(classes.select("node", "t"), "node"), "near-needed")

    @F.pandas_udf("array<bigint>")
    def tokens(texts: pd.Series) -> pd.Series:
        return pd.Series([shingles(x, words).view(np.int64) for x in texts], dtype=object)
    texts = _by_shuffle(rows.withColumn("t", t), needed, "t").dropDuplicates(["node"])
    sets = store(texts.select("node", "is_first", tokens("text").alias("tokens")), "near-sets")
    sizes_allow = F.least("n", "first.n") * 100 >= F.greatest("n", "first.n") * percent
    # of the first members that a class meets, the one that it meets most often
    met = shared.filter((F.col("node") != F.col("first.node")) & sizes_allow).groupBy(
        F.col("first.node").alias("a"), F.col("node").alias("b")).agg(F.count(F.lit(1)).alias("times"))
    stars = met.groupBy("b").agg(F.max_by("a", F.col("times") * F.lit(1 << 32) - F.col("a") % F.lit(1 << 32)).alias("a"))
    links = store(confirm(stars, sets, percent), "near-links")
    left = store(links_of_buckets(_open_units(shared.select("key", "node", "n"), components(links), percent), sets, percent), "near-links")
    links = links.unionByName(left)
    labels = components(links)
    named = _labelled(classes.select("digest", "node", "least"), labels)
    least = named.groupBy("label").agg(F.min("least").alias("component_id"))
    named = store(named.join(least, "label").select("digest", F.col("label").alias("class_id"), "component_id"), "near-named")
    return sketched.drop("bands").join(named, "digest", "left").select(
        "id", "t", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id"))
        .alias("component_id"), F.coalesce("class_id", F.lit(-1)).alias("class_id"))
