"""Quality classifier: gradient-boosted trees over statistics of a text.

The statistics describe the shape of a text (sizes, character classes, lines,
repetition), never its id, language tag or source. The trees are fitted on the
driver to at most ``max_rows`` labelled rows, those with the smallest hash of
their id; statistics of these rows and scores of all rows come from the same
function, run by Spark over whole texts.

Defined cases: a null or empty text has all statistics 0 and gets a score like
any other; labels that are null do not count, of several labels of an id the
majority counts (a tie is 1); without labels every score is 0.5; repeated rows
score row by row (in training they are one row); empty tables give empty
results; other columns are passed on or not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwise.llm.boosting import Trees, fit
from tickwise.llm.common import as_text, free_name, held_out, shared

#: Bound of the training sample.
MAX_TRAINING_ROWS = 20_000

STATISTICS = ("log_bytes", "log_words", "word_length", "long_words", "short_words", "upper", "digits", "symbols",
              "pipes", "exclamations", "stops", "commas", "beyond_ascii", "lines_per_word", "line_length",
              "repeated_lines", "ended_lines", "distinct_words", "top_word", "repeated_windows", "wordless",
              "capital_words", "marked_words")

_UPPER, _DIGIT = bytes(range(65, 91)), bytes(range(48, 58))
_SYMBOL, _HIGH = b"#*$%&<>=~^_@\\{}[]", bytes(range(128, 256))
_MARKS = "#*$%&!|<>"


def _share(data: bytes, chars: bytes) -> float:
    return (len(data) - len(data.translate(None, chars))) / (len(data) or 1)


def statistics(text: str) -> list[float]:
    """The values named in STATISTICS; shares are between 0 and 1."""
    data = text.encode("utf-8", "replace")
    words = text.split()
    lines = [x for x in text.split("\n") if x.strip()]
    n, lower = len(words), [w.lower() for w in words]
    if not n:
        return [float(np.log1p(len(data)))] + [0.0] * (len(STATISTICS) - 1)
    counts = Counter(lower)
    pairs = list(zip(lower, lower[1:], lower[2:]))
    lengths = [len(w) for w in words]
    return [
        float(np.log1p(len(data))), float(np.log1p(n)), sum(lengths) / n,
        sum(x > 12 for x in lengths) / n, sum(x < 3 for x in lengths) / n,
        _share(data, _UPPER), _share(data, _DIGIT), _share(data, _SYMBOL), _share(data, b"|"), _share(data, b"!"),
        _share(data, b"."), _share(data, b","), _share(data, _HIGH),
        len(lines) / n, min(1e6, len(data) / len(lines)), 1 - len(set(lines)) / len(lines),
        sum(x.rstrip()[-1] in ".!?:;\"')" for x in lines) / len(lines),
        len(counts) / n, max(counts.values()) / n, 1 - len(set(pairs)) / len(pairs) if pairs else 0.0,
        sum(w == w.upper() for w in counts) / len(counts),
        sum(a[0] != b[0] for a, b in zip(words, lower)) / n, sum(w[-1] in _MARKS for w in words) / n,
    ]


def statistics_column(text: Column) -> Column:
    """array<double>: the statistics of a text."""
    @F.pandas_udf("array<double>")
    def values(texts: pd.Series) -> pd.Series:
        return pd.Series([statistics(t) for t in texts], dtype=object)
    return values(as_text(text))


def training_rows(docs: DataFrame, labels: DataFrame, label: str, max_rows: int, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """id, text, label of the rows to learn from, not held out, ``max_rows`` at
    most. Only ids of labels, a table of bounded size, are broadcast."""
    chosen = (labels.filter(F.col(label).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col))
              .groupBy(F.col(id_col).alias("id"))
              .agg((F.avg(F.col(label).cast("double")) >= 0.5).cast("int").alias("label"))
              .orderBy(F.xxhash64("id"), "id").limit(max_rows))
    rows = docs.select(F.col(id_col).alias("id"), as_text(text_col).alias("text"))
    return rows.join(F.broadcast(chosen), "id")


def one_for_each_id(rows: DataFrame) -> pd.DataFrame:
    """id, label, x of the training rows on the driver, in the order of ids."""
    got = rows.groupBy("id").agg(F.min("label").alias("label"), F.min("x").alias("x"))
    return got.toPandas().sort_values("id")


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", max_rows: int = MAX_TRAINING_ROWS,
          id_col: str = "doc_id", text_col: str = "text",
          values: Callable[[Column], Column] = statistics_column, **how) -> Trees:
    """Trees fitted to the labels of rows that are not held out."""
    rows = training_rows(docs, labels, label, max_rows, id_col, text_col)
    got = one_for_each_id(rows.select("id", "label", values(F.col("text")).alias("x")))
    x = np.array(got["x"].tolist(), dtype=float) if len(got) else np.zeros((0, len(STATISTICS)))
    return fit(x, got["label"].to_numpy(dtype=float), **how)


def score_column(df: DataFrame, model: Trees, text: Column) -> Column:
    """double: the score of each whole text."""
    load = shared(df, model)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        trees = load()
        for texts in batches:
            x = np.array([statistics(t) for t in texts], dtype=float).reshape(len(texts), len(STATISTICS))
            yield pd.Series(trees.score(x))
    return score(as_text(text))


def score(docs: DataFrame, model: Trees, text_col: str = "text", out_col: str = "score") -> DataFrame:
    """``docs`` with the score of each text (a column of that name is replaced)."""
    return docs.withColumn(out_col, score_column(docs, model, F.col(text_col)))


def keep_good(docs: DataFrame, model: Trees, threshold: float, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that score ``threshold`` or more, with their columns."""
    name = free_name(docs, "score")
    return score(docs, model, text_col, name).filter(F.col(name) >= threshold).select(*[docs[c] for c in docs.columns])
