"""The corpus pipeline: documents through five of the text operators.

STAGES lists (name, function). A function takes (spark, docs, sf_dir) and
returns the rows that go on to the next stage, each with the columns of
``documents`` (the last one: digests of the encoded texts). ``run`` applies all
of them to ``documents``; every stage's rows are written to the shared folder
and read again.

Defined cases, beyond those of the operators: a document that loses all of its
lines goes; rows that share id and text are one document from the near-duplicate
stage on; further columns are passed on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwise.llm import bpe, decontaminate, line_dedup, minhash, quality_model
from tickwise.llm.common import as_bytes, free_name, small_batches, store, table
from tickwise.llm.queries import GOOD_FROM, listed, vocabulary


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the quality classifier, fitted to ``labels``, does not reject."""
    small_batches(spark)
    model = quality_model.train(docs, table(spark, sf_dir, "labels"))
    return quality_model.keep_good(docs, model, GOOD_FROM)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines of windows that occur before; a text that loses all lines goes."""
    out = free_name(docs, "kept")
    done = line_dedup.dedup(docs, out_col=out)
    kept, changed = F.col(out), F.col(f"{out}.n_removed") > 0
    new = {"text": kept["text"], "n_chars": F.when(changed, F.length(kept["text"]).cast("bigint"))
           .otherwise(docs["n_chars"] if "n_chars" in docs.columns else None)}
    return (done.filter(~changed | (kept["n_removed"] < kept["n_lines"]))
            .select(*(new[c].alias(c) if c in new else F.col(c) for c in docs.columns)))


def one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row with the least id of every component, and all rows without words."""
    small_batches(spark)
    near = store(minhash.near_duplicates(docs), "near")
    order = F.struct(F.col("id").isNull().alias("no_id"), "id", "t")
    chosen = (near.filter("class_id >= 0").groupBy("class_id").agg(F.min(order).alias("r")).select("r.id", "r.t")
              .unionByName(near.filter("class_id < 0").select("id", "t")))
    key, mine = free_name(docs, "key"), free_name(docs, "mine")

    def identity(id_col, t):
        return F.concat_ws(":", F.coalesce(id_col.cast("string"), F.lit("")), t.cast("string"))
    wanted = store(chosen.select(identity(F.col("id"), F.col("t")).alias(mine)).distinct(), "near-chosen")
    rows = docs.withColumn(key, identity(F.col("doc_id"), F.xxhash64(as_bytes("text"))))
    return rows.join(wanted, rows[key] == wanted[mine], "left_semi").dropDuplicates([key]).drop(key)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows in which no window of a benchmark item occurs."""
    small_batches(spark)
    out = free_name(docs, "found")
    found = decontaminate.search(docs, table(spark, sf_dir, "benchmark"), out_col=out)
    return found.filter(F.size(f"{out}.spans") == 0).drop(out)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, number of tokens, and digests of the ids and of the decoded bytes."""
    small_batches(spark)
    path, pattern = vocabulary()
    ids = bpe.encode(docs.select("doc_id", "lang", "source", "text"), path, pattern)
    return bpe.decode(ids.drop("text"), path).select(
        "doc_id", "lang", "source", F.size("ids").cast("bigint").alias("n_tokens"),
        listed(F.col("ids")).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality classifier", good_quality),
    ("line dedup", without_repeated_lines),
    ("near duplicates", one_of_near_duplicates),
    ("benchmark decontamination", without_benchmark),
    ("byte-level BPE", encoded),
]
#: Trees and merges are not SQL; the tests hold the rows against brute-force stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
