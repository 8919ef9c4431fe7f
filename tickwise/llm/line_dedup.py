"""Line dedup over overlapping three-line windows, in DataFrame functions only.

A text is split at newlines. Every three consecutive lines are one window,
known by two 64-bit hashes; a window of blank lines only (spaces or nothing)
does not count. The first occurrence of a window in the whole table, by
document id and then by line, stays; every later one marks its three lines, and
the marked lines of a document are merged into spans and removed. The first
occurrence of a line is never removed: what covers it would be later than
itself.

Counts per window are pre-aggregated before the shuffle. The windows that
occur more than once are written to the shared folder; the occurrences meet
them in a join whose skewed partitions Spark splits, or by broadcast where
Spark finds the written table small.

Defined cases: a null or empty text is one empty line and loses nothing (a
null stays null); a text of fewer than three lines loses nothing; rows that
share an id count as one document, the same window at the same line of them is
one occurrence, and each row loses its own lines; null ids come after all others
and count as one document; an empty table gives an empty result; further
columns, of any name, are passed on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwise.llm.common import as_text, free_name, store

WINDOW = 3


def _order(id_col: Column, line: Column) -> Column:
    """Document id and line as one number, so that the least is kept by a hash aggregation."""
    last = F.lit("9223372036854775808").cast("decimal(20,0)")
    return (F.coalesce(id_col.cast("decimal(20,0)"), last) * F.lit(1 << 32).cast("decimal(11,0)")
            + line.cast("decimal(10,0)"))


def windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, t (hash of the text), line (from 0), a, b (hashes of the lines from there)."""
    lines = docs.select(F.col(id_col).alias("id"), as_text(text_col).alias("text")).select(
        "id", F.xxhash64("text").alias("t"), F.split("text", "\n", -1).alias("lines"))
    hashed = lines.filter(F.size("lines") >= WINDOW).select(
        "id", "t", F.transform("lines", lambda x: F.struct(F.xxhash64(x).alias("h"), (F.trim(x) == "").alias("blank")))
        .alias("lines"))
    n = F.size("lines") - (WINDOW - 1)
    part = hashed.select("id", "t", F.posexplode(
        F.arrays_zip(*(F.slice("lines", i + 1, n).alias(f"l{i}") for i in range(WINDOW)))).alias("line", "w"))
    hs = [F.col(f"w.l{i}.h") for i in range(WINDOW)]
    blank = F.col("w.l0.blank")
    for i in range(1, WINDOW):
        blank = blank & F.col(f"w.l{i}.blank")
    return part.filter(~blank).select("id", "t", "line", F.xxhash64(*hs).alias("a"),
                                      F.xxhash64(F.lit("second"), *reversed(hs)).alias("b"))


def later_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, t, line of each window that occurs before."""
    found = windows(docs, id_col, text_col)
    order = _order(F.col("id"), F.col("line"))
    first = store(found.groupBy("a", "b").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("n"))
                  .filter(F.col("n") > 1).select("a", "b", "first"), "line-windows")
    return found.join(first, ["a", "b"]).filter(order > F.col("first")).select("id", "t", "line")


def _spans(starts: Column) -> tuple[Column, Column]:
    """First lines and ends (exclusive) of the spans that the windows from the
    sorted ``starts`` cover; touching spans are one."""
    begins = F.filter(starts, lambda x, i: (i == 0) | (x > F.get(starts, i - 1) + WINDOW))
    ends = F.transform(F.filter(starts, lambda x, i: (i == F.size(starts) - 1) | (F.get(starts, i + 1) > x + WINDOW)),
                       lambda x: x + WINDOW)
    return begins, ends


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", out_col: str = "kept") -> DataFrame:
    """``docs`` with a struct: n_lines, n_removed, spans (begin and end line of
    each removed run, end exclusive) and the text of the lines that stay."""
    named = {n: free_name(docs, n) for n in ("id", "t", "starts", "lines")}
    starts = (later_windows(docs, id_col, text_col).groupBy("id", "t")
              .agg(F.sort_array(F.collect_set("line")).alias("starts"))
              .select(*(F.col(n).alias(named[n]) for n in ("id", "t", "starts"))))
    joined = docs.join(starts, docs[id_col].eqNullSafe(F.col(named["id"]))
                       & (F.xxhash64(as_text(docs[text_col])) == F.col(named["t"])), "left")
    rows = joined.select(*[docs[c] for c in docs.columns],
                         F.split(as_text(docs[text_col]), "\n", -1).alias(named["lines"]),
                         F.coalesce(F.col(named["starts"]), F.array().cast("array<int>")).alias(named["starts"]))
    lines = F.col(named["lines"])
    begins, ends = _spans(F.col(named["starts"]))
    begin, end = free_name(rows, "begin"), free_name(rows, "end")
    rows = rows.withColumns({begin: begins, end: ends})
    begins, ends = F.col(begin), F.col(end)
    gaps = F.arrays_zip(F.concat(F.array(F.lit(0)), ends).alias("a"),
                        F.concat(begins, F.array(F.size(lines))).alias("b"))
    left = F.flatten(F.transform(gaps, lambda g: F.slice(lines, g["a"] + 1, g["b"] - g["a"])))
    removed = F.aggregate(F.arrays_zip(begins.alias("a"), ends.alias("b")), F.lit(0), lambda n, s: n + s["b"] - s["a"])
    result = F.struct(
        F.size(lines).cast("bigint").alias("n_lines"), removed.cast("bigint").alias("n_removed"),
        F.arrays_zip(begins.alias("begin"), ends.alias("end")).alias("spans"),
        F.when(F.size(begins) == 0, docs[text_col].cast("string")).otherwise(F.array_join(left, "\n")).alias("text"))
    passed = [F.col(c) for c in docs.columns if c.lower() != out_col.lower()]
    return rows.select(*passed, result.alias(out_col))
