"""Shards by weighted rendezvous hashing, in DataFrame functions only.

Every shard scores every record key: u is a number between 0 and 1 taken from the
MD5 of the key and the shard's number, the score is -ln(u) / weight, and the least
score wins. A key thus goes to a shard with a chance in proportion to its weight,
decided by the key, the shard numbers and the weights alone. A further shard wins
only the keys for which it scores least, all others stay; a shard that goes, or
whose weight changes, moves keys from or to itself only. Assigning is a map over
the rows, without a shuffle.

``manifest`` also gives each record its slot, the place in its shard in the order
of a hash of id and text. Equal records are counted before the shuffle, the order
is cut into FOLDS parts of the hash range, and a slot is the number of records in
earlier folds and of those before it in its own, so no task orders a whole shard.
A record that occurs often is one row until the end, when its slots are dealt out
in blocks.

Defined cases: a null key is a key of its own; rows that share a key share a shard
and have slots of their own; a null text has no bytes; a shard of weight 0 gets
nothing; an empty table gives an empty result; further columns, of any name, are
passed on by ``assign`` and ``write``, and not read by ``manifest``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickwise.llm.common import as_bytes, free_name, store

#: Hexadecimal digits of the record hash that name a fold: 4096 folds a shard, at every size.
FOLD_DIGITS = 3
#: Slots of one record that are written out at once.
BLOCK = 10_000


def record_key(col: Column | str) -> Column:
    """The key as text; a null is no text's equal."""
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(F.concat(F.lit("k:"), c.cast("string")), F.lit("n"))


def shard_of(key: Column, weights: Sequence[float]) -> Column:
    """Number of the shard that scores least for the key (ties: the lower number)."""
    if not any(w > 0 for w in weights) or any(w < 0 for w in weights):
        raise ValueError("weights must not be negative, and one at least above 0")

    def score(shard: int, weight: float) -> Column:
        drawn = F.conv(F.substring(F.md5(F.concat(key, F.lit(f":{shard}")).cast("binary")), 1, 13), 16, 10).cast("double")
        return -F.log((drawn + 0.5) / F.lit(float(1 << 52))) / F.lit(float(weight))
    bids = [F.struct(score(s, w).alias("score"), F.lit(s).alias("shard")) for s, w in enumerate(weights) if w > 0]
    return F.array_min(F.array(*bids))["shard"]


def assign(docs: DataFrame, weights: Sequence[float], id_col: str = "doc_id", out_col: str = "shard") -> DataFrame:
    """``docs`` with the shard of each row; a column named ``out_col`` is replaced."""
    shard = shard_of(record_key(docs[id_col]), weights)
    return docs.select(*[docs[c] for c in docs.columns if c.lower() != out_col.lower()], shard.alias(out_col))


def write(docs: DataFrame, weights: Sequence[float], path: str, id_col: str = "doc_id", out_col: str = "shard",
          files: int = 1) -> None:
    """One folder of Parquet files for each shard, of up to ``files`` files each. Rows of a
    shard are dealt to its files by a hash of the whole row, so that one key does not
    make one file."""
    placed = assign(docs, weights, id_col, out_col)
    deal = free_name(placed, "deal")
    others = [F.col(c).cast("string") for c in placed.columns if c != out_col]
    dealt = placed.withColumn(deal, F.pmod(F.xxhash64(*others, F.spark_partition_id()), F.lit(files)))
    (dealt.repartition(len(weights) * files, out_col, deal).drop(deal)
     .write.mode("overwrite").partitionBy(out_col).parquet(path))


def manifest(docs: DataFrame, weights: Sequence[float], grown: Sequence[float] | None = None, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """One row per record: id, size (bytes of the text plus 1), text_crc32, shard, slot (from 0,
    without gaps in every shard) and grown_shard (its shard under the weights ``grown``)."""
    text = as_bytes(text_col)
    key = record_key(F.col("id"))
    # records that agree in all of these are interchangeable and counted, before the shuffle
    records = (docs.select(F.col(id_col).alias("id"), (F.octet_length(text) + 1).cast("bigint").alias("size"),
                           F.crc32(text).alias("text_crc32"))
               .groupBy("id", "size", "text_crc32").agg(F.count(F.lit(1)).alias("n")))
    order = F.md5(F.concat_ws(":", key, F.col("size").cast("string"), F.col("text_crc32").cast("string")).cast("binary"))
    placed = store(records.withColumns({
        "shard": shard_of(key, weights), "grown_shard": shard_of(key, grown) if grown is not None else F.lit(None).cast("int"),
        "place": order}).withColumn("fold", F.substring("place", 1, FOLD_DIGITS)), "shard-records")
    folds = placed.groupBy("shard", "fold").agg(F.sum("n").alias("n"))
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("fold").rowsBetween(Window.unboundedPreceding, -1))
    starts = folds.select(F.col("shard"), F.col("fold"), F.coalesce(before, F.lit(0)).alias("fold_start"))
    inside = F.sum("n").over(Window.partitionBy("shard", "fold").orderBy("place", "id", "size", "text_crc32")
                             .rowsBetween(Window.unboundedPreceding, -1))
    slots = store(placed.withColumn("inside", F.coalesce(inside, F.lit(0))).join(starts, ["shard", "fold"])
                  .select("id", "size", "text_crc32", "n", "shard", "grown_shard",
                          (F.col("fold_start") + F.col("inside")).alias("start")), "shard-slots")
    few = slots.filter(F.col("n") <= BLOCK).withColumn("end", F.col("start") + F.col("n"))
    # a record of many copies: its slots in blocks, dealt to all tasks
    blocks = slots.filter(F.col("n") > BLOCK).select("*", F.explode(F.sequence(
        F.lit(0).cast("bigint"), F.expr(f"(n - 1) div {BLOCK}"))).alias("block")).repartition("start", "block")
    many = blocks.select(*slots.drop("start").columns, (F.col("start") + F.col("block") * BLOCK).alias("start"),
                         (F.col("start") + F.least("n", (F.col("block") + 1) * BLOCK)).alias("end"))
    return (few.unionByName(many)
            .select("id", "size", "text_crc32", "shard", F.explode(F.sequence("start", F.col("end") - 1)).alias("slot"),
                    "grown_shard"))
