"""The relational store: batches merged once, even parallel reads (in-process Derby, no port)."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tickwise.operators.anomalies import detect_anomalies
from tickwise.sinks import jdbc
from tickwise.sources import tables as T
from tickwise.streaming.pipeline import jdbc_sink

DERBY = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}


def _windows(spark):
    w = T.windows_from_events(spark, SF_SMALL)
    return w.withColumns({c: F.col(c).cast("timestamp") for c in ("window_start", "window_end")})


def _counts(spark, url, *tables):
    return [jdbc.read_table_jdbc(spark, url, t, DERBY).count() for t in tables]


def test_replayed_batch_is_merged_once(spark):
    url = "jdbc:derby:memory:store_replay;create=true"
    w = _windows(spark)
    a = detect_anomalies(w, detected_at="window_end")
    for _ in range(3):
        jdbc.write_clean_jdbc(w, url, "CLEAN", DERBY, num_partitions=2, batch=(1, 0), origin="p")
        jdbc.write_anomalies_jdbc(a, url, "ANOMS", DERBY, num_partitions=2, batch=(1, 0), origin="p")
    assert _counts(spark, url, "CLEAN", "ANOMS") == [w.count(), a.count()]
    # another batch, run or pipeline is a batch of its own
    for batch, origin in (((1, 1), "p"), ((2, 0), "p"), ((1, 0), "it's another")):
        jdbc.write_clean_jdbc(w, url, "CLEAN", DERBY, batch=batch, origin=origin)
    assert _counts(spark, url, "CLEAN", jdbc.LEDGER) == [4 * w.count(), 5]
    # every value arrives
    back = jdbc.read_table_jdbc(spark, url, "CLEAN", DERBY).distinct()
    want = jdbc.clean_rows(w)
    assert back.exceptAll(want).count() == 0 and want.exceptAll(back).count() == 0


def test_crash_between_staging_and_merge_loses_and_doubles_nothing(spark):
    url = "jdbc:derby:memory:store_crash;create=true"
    w = _windows(spark)
    frames = {"CLEAN": jdbc.clean_rows(w), "ANOMS": detect_anomalies(w, detected_at="window_end")}
    n = [f.count() for f in frames.values()]

    def crash():
        raise RuntimeError("lost the driver")
    with pytest.raises(RuntimeError):
        jdbc.merge_batch(frames, url, DERBY, 1, 0, "p", before_merge=crash)
    assert _counts(spark, url, "CLEAN", "ANOMS") == [0, 0]
    assert jdbc.committed(spark, url, DERBY, "p", 1, 0) == set()
    # the merge of one of two tables fails: none of them has rows
    bad = dict(frames, ANOMS=frames["ANOMS"].withColumn("no_such_column", F.lit(1)))
    with pytest.raises(Exception):
        jdbc.merge_batch(bad, url, DERBY, 1, 0, "p")
    assert _counts(spark, url, "CLEAN", "ANOMS") == [0, 0]
    assert sorted(jdbc.merge_batch(frames, url, DERBY, 1, 0, "p")) == ["ANOMS", "CLEAN"]
    assert jdbc.merge_batch(frames, url, DERBY, 1, 0, "p") == []
    assert _counts(spark, url, "CLEAN", "ANOMS") == n
    with jdbc._connection(spark, url, DERBY) as con:      # no staging table is left
        assert not any(jdbc._exists(con, jdbc._staging(t, "p", 1, 0)) for t in frames)


def test_sink_of_a_stream_is_merged_once(spark, tmp):
    from tickwise.streaming.pipeline import make_batch_scorer
    url = "jdbc:derby:memory:store_sink;create=true"
    w = _windows(spark)
    calls = []

    def fail_once(windows, anomalies, batch_id):
        calls.append(batch_id)
        if len(calls) == 1:
            raise RuntimeError("a later sink is down")
    fn = make_batch_scorer(spark, f"{tmp}/lake", f"{tmp}/anoms", f"{tmp}/state", run_id=3,
                           extra_sinks=[jdbc_sink(url, DERBY, "CLEAN", "ANOMS"), fail_once])
    with pytest.raises(RuntimeError):
        fn(w, 0)
    fn(w, 0)
    assert _counts(spark, url, "CLEAN", "ANOMS") == [w.count(), spark.read.parquet(f"{tmp}/anoms").count()]


@pytest.mark.parametrize("columns", [["k"], ["k", "at", "id"]])
def test_even_reads_of_a_skewed_column(spark, columns):
    url = f"jdbc:derby:memory:store_even{len(columns)};create=true"
    n = 6000
    # two thirds of the rows share one key, and some have none
    rows = spark.range(n).select(
        F.col("id").cast("int").alias("id"), F.when(F.col("id") % 3 == 0, F.col("id") % 500 + 10).otherwise(7).cast("int").alias("k"),
        (F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") % 50)).alias("at"), F.lit("it's").alias("s"))
    rows = rows.withColumn("k", F.when(F.col("id") % 997 != 5, F.col("k")))
    jdbc._write(rows, url, "T", DERBY, 1000, None)
    back = jdbc.read_table_jdbc(spark, url, "T", DERBY, partition_column=columns, num_partitions=8)
    sizes = [r["n"] for r in back.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert back.count() == n and back.select("id").distinct().count() == n
    nulls = rows.filter("k IS NULL").count()
    even = sorted(sizes)[1:] if nulls in sizes else sizes
    if columns == ["k"]:        # the hot key cannot be cut by itself, the rest is even
        assert max(even) >= n * 0.6 and max(sorted(even)[:-1]) <= 2 * (n // 8)
    else:
        assert len(even) == 8 and max(even) <= 2 * min(even)
    assert jdbc.read_table_jdbc(spark, url, "T", DERBY, partition_column=columns[-1]).count() == n
