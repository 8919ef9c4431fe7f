"""Data-quality and pipeline-health checks as DataFrames with a status column.

Each check is one aggregation (partial + final, so hot symbols are reduced
map-side); "recent" checks compare against ``as_of`` (default: the newest
timestamp of the input, an uncorrelated scalar subquery; pass
``F.current_timestamp()`` for live use).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwise import schemas as S
from tickwise.functions.columns import not_system, recent, round_half_away, safe_ratio
from tickwise.plans.reports import _as_of
from tickwise.session import materialize


# Status texts (fixed values)
NEGATIVE_PRICES = "FAIL: negative/zero prices"
EXTREME_RANGE = "WARN: extreme range"


def dq_nulls(clean: DataFrame) -> DataFrame:
    """Rows with a null symbol, close, volume or window_start; PASS at 0."""
    bad = (F.col("symbol").isNull() | F.col("close_price").isNull()
           | F.col("volume").isNull() | F.col("window_start").isNull())
    n = F.count_if(bad)
    return clean.agg(n.alias("null_rows"),
                     F.when(n == 0, "PASS").otherwise("WARNING").alias("status"))


def dq_duplicates(clean: DataFrame, keys=("symbol", "window_start"),
                  tolerance: int = S.DUPLICATE_TOLERANCE) -> DataFrame:
    """Number of key groups with more than one row; PASS at <= tolerance."""
    dup = (clean.groupBy(*keys).agg(F.count(F.lit(1)).alias("cnt"))
           .filter(F.col("cnt") > 1))
    n = F.count(F.lit(1))
    return dup.agg(n.alias("duplicate_groups"),
                   F.when(n <= tolerance, "PASS").otherwise("WARNING").alias("status"))


def dq_price_sanity(clean: DataFrame, as_of=None, interval: str = "1 hour") -> DataFrame:
    """Per symbol over the last ``interval``: min, max, avg close and a status."""
    a = _as_of(clean, "window_start", as_of)
    lo, hi = F.min("close_price"), F.max("close_price")
    status = (F.when(lo <= 0, NEGATIVE_PRICES)
              .when(safe_ratio(hi, lo) > S.PRICE_RANGE_RATIO, EXTREME_RANGE)
              .otherwise("PASS"))
    return (clean.filter(recent("window_start", a, interval)).groupBy("symbol")
            .agg(lo.alias("min_price"), hi.alias("max_price"),
                 round_half_away(F.avg("close_price"), 2).alias("avg_price"),
                 status.alias("status"))
            .orderBy("symbol"))


def data_freshness(clean: DataFrame, as_of=None,
                   limit: str = S.FRESHNESS_LIMIT) -> DataFrame:
    """FRESH when the newest window starts within ``limit`` of ``as_of``."""
    a = _as_of(clean, "created_at", as_of)
    latest = F.max("window_start")
    return clean.agg(latest.alias("latest_window"),
                     F.when(latest > a - F.expr(f"INTERVAL {limit}"), "FRESH")
                     .otherwise("STALE").alias("status"))


def load_verification(clean: DataFrame, as_of=None,
                      interval: str = S.RECENT_LOAD) -> DataFrame:
    """Per symbol, rows inserted in the last ``interval``."""
    a = _as_of(clean, "created_at", as_of)
    return (clean.filter(recent("created_at", a, interval)).groupBy("symbol")
            .agg(F.count(F.lit(1)).alias("new_rows"),
                 round_half_away(F.min("close_price"), 2).alias("min_price"),
                 round_half_away(F.max("close_price"), 2).alias("max_price"),
                 round_half_away(F.sum("volume"), 0).alias("total_volume"),
                 F.min("window_start").alias("earliest_window"),
                 F.max("window_start").alias("latest_window"))
            .orderBy("symbol"))


def load_status(clean: DataFrame, anomalies: DataFrame, as_of=None,
                interval: str = S.RECENT_LOAD) -> DataFrame:
    """New clean rows and new anomalies in the last ``interval``; SUCCESS if rows > 0."""
    a = _as_of(clean, "created_at", as_of)
    rows = clean.filter(recent("created_at", a, interval)).agg(
        F.count(F.lit(1)).alias("new_rows"))
    anoms = anomalies.filter(not_system() & recent("created_at", a, interval)).agg(
        F.count(F.lit(1)).alias("new_anomalies"))
    # 1 x 1 rows: the cross join is a broadcast of a single row
    return rows.crossJoin(anoms).select(
        "new_rows", "new_anomalies",
        F.when(F.col("new_rows") > 0, "SUCCESS").otherwise("WARNING").alias("status"))


def pipeline_health(clean: DataFrame, as_of=None,
                    interval: str = S.RECENT_LOAD) -> DataFrame:
    """Per symbol: total rows, rows inserted in ``interval``, newest window and insert.

    The reference phrases "new rows" as a correlated subquery per symbol;
    here it is a conditional count in the same aggregation (one scan).
    """
    clean = materialize(clean, "health-input") if as_of is None else clean
    a = _as_of(clean, "created_at", as_of)
    return (clean.groupBy("symbol")
            .agg(F.count(F.lit(1)).alias("total_rows"),
                 F.count_if(recent("created_at", a, interval)).alias("new_rows_10m"),
                 F.max("window_start").alias("latest_window"),
                 F.max("created_at").alias("last_insert"))
            .orderBy("symbol"))


def quality_summary(clean: DataFrame, anomalies: DataFrame, as_of=None,
                    interval: str = "1 hour") -> DataFrame:
    """Five scalars in one row: rows, anomalies, symbols, newest window,
    average ticks per window over the last ``interval``."""
    a = _as_of(clean, "window_start", as_of)
    c = clean.agg(F.count(F.lit(1)).alias("total_market_rows"),
                  F.count_distinct("symbol").alias("tracked_symbols"),
                  F.max("window_start").alias("latest_data"),
                  round_half_away(F.avg(F.when(recent("window_start", a, interval),
                                               F.col("record_count"))), 1)
                  .alias("avg_ticks_per_window"))
    n = anomalies.filter(not_system()).agg(F.count(F.lit(1)).alias("total_anomalies"))
    return c.crossJoin(n).select("total_market_rows", "total_anomalies", "tracked_symbols",
                                 "latest_data", "avg_ticks_per_window")


def row_counts(clean: DataFrame, anomalies: DataFrame) -> DataFrame:
    """(table_name, row_count) for both tables, system rows excluded."""
    a = clean.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(S.TOPIC_CLEAN).alias("table_name"), "row_count")
    b = anomalies.filter(not_system()).agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(S.TOPIC_ANOMALIES).alias("table_name"), "row_count")
    return a.unionByName(b)


def lake_files(spark: SparkSession, path: str) -> DataFrame:
    """path, length, modificationTime and partition folder of every Parquet file of a
    lake: one row per file, no file is opened (the content column is pruned)."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
             .option("recursiveFileLookup", "true").load(path).select("path", "length", "modificationTime"))
    return files.withColumn("partition", F.regexp_extract("path", r"^(.*)/[^/]+$", 1))


def newest_files(spark: SparkSession, path: str, n: int = S.NEWEST_FILES) -> DataFrame:
    """The ``n`` files written last."""
    return lake_files(spark, path).orderBy(F.desc("modificationTime"), "path").limit(n)


def newest_partitions(spark: SparkSession, path: str, n: int = S.NEWEST_PARTITIONS) -> DataFrame:
    """The ``n`` partition folders written last, with files and bytes."""
    return (lake_files(spark, path).groupBy("partition")
            .agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"),
                 F.max("modificationTime").alias("last_write"))
            .orderBy(F.desc("last_write"), "partition").limit(n))


def lake_partitions(lake: DataFrame) -> DataFrame:
    """Rows of every (date, asset_type) partition of a lake."""
    return lake.groupBy("date", "asset_type").agg(F.count(F.lit(1)).alias("row_count"))


def lake_inventory(spark: SparkSession, path: str, as_of=None,
                   interval: str = S.RECENT_LOAD) -> DataFrame:
    """Files, recently written files, bytes and partitions of a Parquet lake."""
    a = as_of if isinstance(as_of, Column) else (F.current_timestamp() if as_of is None
                                                 else F.lit(as_of))
    out = lake_files(spark, path).agg(
        F.count(F.lit(1)).alias("files"),
        F.count_if(recent("modificationTime", a, interval)).alias("recent_files"),
        F.sum("length").alias("bytes"), F.count_distinct("partition").alias("partitions"))
    return out.withColumn(
        "status", F.when(F.col("recent_files") > 0, "SUCCESS")
        .when(F.col("files") > 0, "OK").otherwise("INFO"))


def run_quality_checks(clean: DataFrame, anomalies: DataFrame | None = None, as_of=None) -> DataFrame:
    """All scalar checks as (check, value, status) rows, over one stored copy of
    ``clean``. ``anomalies`` is accepted for callers that have both tables; no
    check needs it."""
    clean = materialize(clean, "quality-input")

    def one(name, df, value_col):
        return df.select(F.lit(name).alias("check"),
                         F.col(value_col).cast("string").alias("value"), "status")
    a = _as_of(clean, "created_at", as_of)
    new = F.count_if(recent("created_at", a, S.RECENT_LOAD))
    load = clean.agg(new.alias("new_rows"), F.when(new > 0, "SUCCESS").otherwise("WARNING").alias("status"))
    return (one("nulls", dq_nulls(clean), "null_rows")
            .unionByName(one("duplicates", dq_duplicates(clean), "duplicate_groups"))
            .unionByName(one("freshness", data_freshness(clean, as_of), "latest_window"))
            .unionByName(one("load", load, "new_rows")))
