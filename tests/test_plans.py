"""Physical-plan shape: aggregation strategy, pushdown, pruning, no Python."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tickwise.operators.anomalies import detect_anomalies
from tickwise.plans import reports as R
from tickwise.sinks.lake import read_lake, write_lake
from tickwise.sources import tables as T


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_window_features_is_hash_aggregate(spark):
    p = _plan(T.windows_from_events(spark, SF_SMALL))
    assert "HashAggregate" in p and "SortAggregate" not in p
    assert "partial_min_by" in p          # map-side combine before the shuffle


def test_no_python_in_flagship(spark):
    p = _plan(detect_anomalies(T.windows_from_events(spark, SF_SMALL)))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas"):
        assert bad not in p


def test_rolling_scan_reads_stored_input_twice_not_upstream(spark):
    """The tick aggregation runs once (stored), not once per branch."""
    p = _plan(detect_anomalies(T.windows_from_events(spark, SF_SMALL)))
    assert "events.parquet" not in p      # branches read the stored window table
    assert p.count("Exchange hashpartitioning(_k0") >= 1


def test_lake_partition_pruning_and_pushdown(spark, tmp):
    write_lake(T.windows_from_events(spark, SF_SMALL), f"{tmp}/lake", batch_id=3)
    df = read_lake(spark, f"{tmp}/lake", "2024-01-10 00:00:00", "2024-01-12 00:00:00", "stock")
    df = df.select("symbol", "close_price")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan and "asset_type" in plan
    assert "PushedFilters: [IsNotNull(window_start), GreaterThanOrEqual(window_start" in plan
    assert "ReadSchema: struct<symbol:string,close_price:double" in plan
    lake = read_lake(spark, f"{tmp}/lake", "2024-01-10 00:00:00", "2024-01-12 00:00:00", "stock")
    files = [r[0] for r in lake.select("_metadata.file_path").distinct().collect()]
    assert files and all("asset_type=stock" in f for f in files)
    assert all(any(f"date=2024-01-{d}" in f for d in ("10", "11", "12")) for f in files)


def test_latest_per_symbol_hash_aggregates_big_table(spark, tmp):
    T.clean_from_events(spark, SF_SMALL).write.parquet(f"{tmp}/c")
    p = _plan(R.current_prices(spark.read.parquet(f"{tmp}/c")))
    assert "Window" not in p
    # the scan feeds a (partial) HashAggregate; only the tiny per-symbol
    # merge across asset types may sort
    scan_side = p[p.rindex("HashAggregate"):]
    assert "FileScan parquet" in scan_side and "SortAggregate" not in scan_side


def test_time_filter_pushed_to_scan(spark, tmp):
    T.windows_from_events(spark, SF_SMALL).write.parquet(f"{tmp}/w")
    w = spark.read.parquet(f"{tmp}/w")
    end = w.select(F.max("window_start")).scalar()
    p = _plan(R.price_series(w, "2024-01-03 00:00:00", "2024-01-04 00:00:00"))
    assert "GreaterThanOrEqual(window_start" in p and "LessThanOrEqual(window_start" in p
    assert end is not None


def _windows_over_keys_alone(plan: str) -> list[str]:
    """Order columns of the windows of a plan whose partition holds no chunk or group."""
    import re
    specs = [re.split(" ASC| DESC", x)[0].split(", ") for x in re.findall(r"windowspecdefinition\(([^()]*)", plan)]
    return [x[-1] for x in specs if not re.search(r"\b_(c|chunk|group)#", ", ".join(x[:-1]))]


def test_last_rows_have_no_window_over_the_key_alone(spark):
    from tickwise.operators.anomalies import last_rows
    w = T.windows_from_events(spark, SF_SMALL)
    last = last_rows(w.select("symbol", "asset_type", "window_start"), 20, chunk_rows=8)
    plan = _plan(last)
    assert "windowspecdefinition" in plan and not _windows_over_keys_alone(plan)
    from pyspark.sql import Window
    from pyspark.sql import functions as F
    newest = Window.partitionBy("symbol", "asset_type").orderBy(F.desc("window_start"))
    want = w.select("symbol", "asset_type", "window_start", F.row_number().over(newest).alias("r")).filter("r <= 20").drop("r")
    assert sorted(map(tuple, last.collect())) == sorted(map(tuple, want.collect()))


def test_two_level_scan_holds_no_key_in_one_task(spark):
    """One symbol of second-wide windows: only the totals of the groups are seen per key."""
    from pyspark.sql import functions as F
    from tickwise.operators import rolling as Roll
    from tickwise.session import materialize
    n = 200_000
    w = materialize(spark.range(n).select(
        F.lit("A").alias("symbol"), F.lit("crypto").alias("asset_type"),
        F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id")).alias("window_start"),
        F.timestamp_seconds(F.lit(1_700_000_001) + F.col("id")).alias("window_end"),
        (F.col("id") * 37 % 101).cast("double").alias("price_return_pct"),
        F.when(F.col("id") % 5 != 0, F.col("id") * 1.5).alias("total_volume"), F.lit(0.5).alias("rolling_volatility")), "seconds")
    two = Roll.rolling_stats(w, levels=2, chunk_rows=16)
    plan = _plan(two)
    over_key = _windows_over_keys_alone(plan)
    assert over_key and all("_group" in x for x in over_key)         # ordered by group: one row for 4096 windows
    stats = [f"{f}_{s}" for f in Roll.FEATURES for s in ("mean", "std")]
    got, want = ({r["window_start"]: [-1.0 if r[c] is None else r[c] for c in stats] for r in
                  df.filter(F.unix_seconds("window_start") % 1009 < 3).collect()}
                 for df in (two, Roll.rolling_stats(w, levels=1, chunk_rows=16)))
    assert got.keys() == want.keys() and len(got) > 400
    assert all(got[k] == pytest.approx(want[k], rel=1e-9) for k in got)
    # rows of the tasks that scan chunks: even, though all are of one key
    chunks = w.select((F.unix_seconds("window_start") / 16 / Roll.GROUP_CHUNKS).cast("long").alias("g")).distinct().count()
    assert chunks > 40


def test_newest_rows_keep_columns_of_any_type(spark):
    from pyspark.sql import functions as F
    from tickwise.plans import reports as R
    from tickwise.operators.features import to_clean
    clean = to_clean(T.windows_from_events(spark, SF_SMALL)).withColumn("notes", F.array("symbol", F.lit("x")))
    got = R.latest_rows(clean)
    assert got.columns == clean.columns
    short = R._latest_per_symbol(clean.drop("notes"))
    cols = sorted(set(short.columns))
    assert sorted(map(str, got.select(cols).collect())) == sorted(map(str, short.select(cols).collect()))
    assert all(r["notes"] == [r["symbol"], "x"] for r in got.collect())


def test_checks_read_the_events_once(spark):
    from tickwise.plans import catalog
    for name in ("quality_summary", "load_status", "row_counts"):
        assert "events.parquet" not in _plan(catalog.queries()[name](spark, SF_SMALL))   # only the stored windows
    q = catalog.queries()["run_quality_checks"](spark, SF_SMALL)
    assert "events.parquet" not in _plan(q)
