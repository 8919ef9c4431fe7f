"""Audit of how document filters interact, from sorted posting lists.

A filter's posting list holds the ids of the rows that fail it, ascending. Lists
are kept per part (a source) and per range of RANGE consecutive row numbers, which
are given by the scan, so a part that holds most of the rows is spread over as many
lists as it has ranges, and no list is longer than a range.

Whatever the order of the filters, a step removes the rows that fail its filter and
none of the earlier ones: the difference of a list and the union of the lists before
it. A task builds, for a part and a range, the unions of all 32 sets of filters and
from them the 80 differences (5 filters, 16 sets of earlier ones each), by merges that
gallop: the list with the least head is searched, in doubling steps and then by
bisection, for the least head of the others, and all ids up to there are taken at
once. The same is done for the lists of rows with a label (good, toxic). Sizes add up
over ranges; every order is then a sum of looked-up sizes.

Filters (a null text is empty; words are maximal runs without white space, case kept):
A under 50 words; B distinct words below 65 percent of the words; C letters A-Z above
5 percent of the code points; D holds one of ``#$%&*|``; E equal to the text of a row
with a smaller id in the whole table, whether that row is removed or not.

Defined cases: an empty text fails A only (and E); a null source is part ''; a null id
is above all others and has no label; rows that share an id are rows of their own, and
none of them is the smaller one; several labels of an id count if one of them is 1;
an empty table has no parts; other columns are not read.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from itertools import permutations
from math import factorial

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwise.llm.common import as_bytes, as_text, store

FILTERS = "ABCDE"
#: Consecutive row numbers whose failing rows make one list.
RANGE = 1 << 16
_CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_SYMBOL = re.compile(rb"[#$%&*|]")


def own_failures(text: str) -> int:
    """Bit i is set if the text fails filter i, A to D."""
    data = text.encode()
    words = data.split()                 # of bytes: splits at space and \x09-\x0D alone
    capitals = len(data) - len(data.translate(None, _CAPITALS))
    return ((len(words) < 50) | (100 * len(set(words)) < 65 * len(words)) << 1 | (100 * capitals > 5 * len(text)) << 2
            | (_SYMBOL.search(data) is not None) << 3)


def gallop(ids: list[int], bound: int, start: int) -> int:
    """Position of the first id from ``start`` on that is not below ``bound``."""
    step, low, n = 1, start, len(ids)
    while low + step < n and ids[low + step] < bound:
        low += step
        step *= 2
    return bisect_left(ids, bound, low, min(low + step + 1, n))


def union(lists: list[list[int]]) -> list[int]:
    """Ids of any of the sorted lists, by a k-way merge in slices."""
    heads = [[x, 0] for x in lists if x]
    out: list[int] = []
    while len(heads) > 1:
        heads.sort(key=lambda h: h[0][h[1]])
        first, at = heads[0]
        bound = heads[1][0][heads[1][1]]
        end = gallop(first, bound, at)
        out += first[at:end]
        heads[0][1] = end
        if end < len(first) and first[end] == bound:   # the id of both is taken from the other list
            heads[0][1] = end = end + 1
        if end == len(first):
            del heads[0]
    for ids, at in heads:
        out += ids[at:]
    return out


def difference(ids: list[int], other: list[int]) -> int:
    """How many of ``ids`` are not in ``other``; both sorted."""
    i = j = left = 0
    while i < len(ids) and j < len(other):
        end = gallop(ids, other[j], i)
        left += end - i
        i = end
        if i < len(ids):
            j = gallop(other, ids[i], j)
            if j < len(other) and other[j] == ids[i]:
                i, j = i + 1, j + 1
    return left + len(ids) - i


def differences(postings: list[list[int]]) -> tuple[list[list[int]], list[int]]:
    """``sizes[f][s]``: how many ids of filter f are in none of the lists of the set s
    (a bit mask without f); and the size of the union of every set."""
    unions: list[list[int]] = [[]]
    for s in range(1, 1 << len(postings)):
        unions.append(union([postings[f] for f in range(len(postings)) if s >> f & 1]))
    return ([[difference(ids, unions[s]) if not s >> f & 1 else 0 for s in range(len(unions))]
             for f, ids in enumerate(postings)], [len(u) for u in unions])


def postings(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             part_col: str = "source") -> DataFrame:
    """part, block, n (rows), lists (failing row numbers of each filter, sorted), good and
    toxic (row numbers with such a label, sorted)."""
    @F.pandas_udf("int")
    def failures(texts: pd.Series) -> pd.Series:
        return texts.map(own_failures).astype("int32")

    last = F.lit("9223372036854775808").cast("decimal(20,0)")
    text = as_text(text_col)
    rows = store(docs.select(F.monotonically_increasing_id().alias("row"),
                             F.coalesce(F.col(id_col).cast("decimal(20,0)"), last).alias("id"),
                             as_text(part_col).alias("part"), F.xxhash64(text).alias("h"),
                             F.md5(as_bytes(text_col)).alias("digest"), failures(text).alias("mask")), "audit-rows")
    first = store(rows.groupBy("h", "digest").agg(F.min("id").alias("least"), F.max("id").alias("most"))
                  .filter("least < most").drop("most"), "audit-copies")
    known = labels.select(F.col("doc_id").cast("decimal(20,0)").alias("id"), "quality", "toxic").filter("id is not null")
    label = known.groupBy("id").agg(F.max("quality").alias("good"), F.max("toxic").alias("toxic"))
    full = (rows.join(first, ["h", "digest"], "left").join(label, "id", "left")
            .withColumn("mask", F.col("mask") + F.when(F.col("id") > F.col("least"), 16).otherwise(0)))

    def listed(condition):
        return F.sort_array(F.collect_list(F.when(condition, F.col("row"))))
    return (full.groupBy("part", F.expr(f"row div {RANGE}").alias("block"))
            .agg(F.count(F.lit(1)).alias("n"),
                 F.array(*(listed(F.expr(f"mask & {1 << f}") != 0) for f in range(len(FILTERS)))).alias("lists"),
                 listed(F.col("good") == 1).alias("good"), listed(F.col("toxic") == 1).alias("toxic")))


_SIZES = "array<struct<filter:int,earlier:int,removed:bigint,good:bigint,toxic:bigint,failing:bigint,gone:bigint>>"


def interactions(posted: DataFrame) -> DataFrame:
    """part, filter, earlier (mask of the filters before it), and over all ranges: n (rows), failing
    (rows that fail the filter), removed (those that fail none of the earlier ones), good and toxic
    (of these, the ones with that label), gone (rows removed by the filter or an earlier one)."""
    @F.pandas_udf(_SIZES)
    def merged(lists: pd.Series, good: pd.Series, toxic: pd.Series) -> pd.Series:
        out = []
        for kept, g, t in zip(lists, good, toxic):
            of = [[int(x) for x in ids] for ids in kept]
            sizes, unions = differences(of)
            marked = [differences([sorted(set(ids).intersection(label.tolist())) for ids in of])[0] for label in (g, t)]
            out.append([{"filter": f, "earlier": s, "removed": sizes[f][s], "good": marked[0][f][s],
                         "toxic": marked[1][f][s], "failing": len(of[f]), "gone": unions[s | 1 << f]}
                        for f in range(len(of)) for s in range(len(unions)) if not s >> f & 1])
        return pd.Series(out)

    sizes = posted.select("part", "n", F.explode(merged("lists", "good", "toxic")).alias("x")).select("part", "n", "x.*")
    return sizes.groupBy("part", "filter", "earlier").agg(
        *(F.sum(c).alias(c) for c in ("n", "failing", "removed", "good", "toxic", "gone")))


def orders(sizes: DataFrame) -> DataFrame:
    """One row per part, filter_order (all of them) and step: kept, removed, redundant, unique_fails,
    good_lost, toxic_lost, and shapley (what the filter removes, summed over all orders)."""
    k = len(FILTERS)
    plan = []
    for order in permutations(range(k)):
        for i, f in enumerate(order):
            plan.append(("".join(FILTERS[g] for g in order), i + 1, f, sum(1 << g for g in order[:i])))
    steps = F.broadcast(sizes.sparkSession.createDataFrame(   # of fixed size: 120 orders of 5 filters
        plan, "filter_order string, step int, filter int, earlier int"))
    times = F.element_at(F.array(*(F.lit(factorial(i) * factorial(k - 1 - i)) for i in range(k))),
                         F.bit_count("earlier") + 1)
    alone = F.col("earlier") == F.expr(f"{(1 << k) - 1} - shiftleft(1, filter)")
    sums = store(sizes, "audit-sizes")
    whole = sums.groupBy("part", "filter").agg(F.sum(times * F.col("removed")).alias("shapley"),
                                               F.max(F.when(alone, F.col("removed"))).alias("unique_fails"))
    return (sums.join(whole, ["part", "filter"]).join(steps, ["filter", "earlier"]).select(
        "part", "filter_order", "step", (F.col("n") - F.col("gone")).alias("kept"), "removed",
        (F.col("failing") - F.col("removed")).alias("redundant"), "unique_fails", F.col("good").alias("good_lost"),
        F.col("toxic").alias("toxic_lost"), "shapley"))


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          part_col: str = "source") -> DataFrame:
    """The rows of ``orders`` for ``docs``."""
    posted = store(postings(docs, labels, id_col, text_col, part_col), "audit-postings")
    return orders(interactions(posted))
