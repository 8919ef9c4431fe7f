"""Compaction of the lake: readers see it before or after, replays and late batches."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tickwise.sinks import lake as L
from tickwise.sources import tables as T


def _files(path):
    return sum(f.endswith(".parquet") for _, _, fs in os.walk(path) for f in fs)


def _same(a, b):
    cols = sorted(set(a.columns) - {"batch_id", "run_id"})
    a, b = a.select(cols), b.select(cols)
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def _batches(spark, path, n=6):
    """Windows of 30 days in batches of 5 days, each split by type as two sources write them."""
    w = T.windows_from_events(spark, SF_SMALL, "1 hour").cache()
    for k in range(n):
        lo, hi = (F.lit(f"2024-01-01 00:00:00").cast("timestamp_ntz") + F.expr(f"INTERVAL {d} DAYS") for d in (5 * k, 5 * k + 5))
        part = w.filter((F.col("window_start") >= lo) & ((F.col("window_start") < hi) | F.lit(k == n - 1)))
        L.write_lake(part, path, batch_id=k, run_id=1)
    return w


def test_compaction_changes_files_and_no_rows(spark, tmp):
    path = f"{tmp}/lake"
    w = _batches(spark, path)
    before = _files(path)
    done = L.compact_lake(spark, path, "2024-01-21")
    assert done == [f"2024-01-{d:02d}" for d in range(1, 21)]
    assert _same(L.read_lake(spark, path), w.withColumn("date", F.to_date("window_start")))
    assert spark.read.parquet(path).count() == w.count()        # a plain reader still sees the batches
    days = w.filter("window_start < timestamp_ntz'2024-01-21 00:00:00'").select(F.to_date("window_start"), "asset_type").distinct()
    assert _files(f"{path}/_compacted") == days.count() < before
    ranged = L.read_lake(spark, path, "2024-01-19 05:00:00", "2024-01-22 00:00:00", "stock")
    want = w.filter("window_start BETWEEN timestamp_ntz'2024-01-19 05:00:00' AND timestamp_ntz'2024-01-22 00:00:00' "
                    "AND asset_type = 'stock'").withColumn("date", F.to_date("window_start"))
    assert want.count() > 0 and _same(ranged, want)
    assert L.read_lake(spark, path, "2030-01-01 00:00:00").count() == 0
    assert L.compact_lake(spark, path, "2024-01-21") == []       # nothing is left to do


def test_replays_late_batches_and_vacuum(spark, tmp):
    path = f"{tmp}/lake"
    w = _batches(spark, path)
    old = L.read_lake(spark, path)                               # a reader from before
    L.compact_lake(spark, path, "2024-02-01")
    whole = w.withColumn("date", F.to_date("window_start"))
    assert _same(old, whole)
    day = w.filter("window_start < timestamp_ntz'2024-01-06 00:00:00'")
    L.write_lake(day, path, batch_id=0, run_id=1)                # a replay of a covered batch
    assert _same(L.read_lake(spark, path), whole)
    late = day.limit(5).withColumn("symbol", F.lit("late")).cache()
    L.write_lake(late, path, batch_id=6, run_id=1)
    both = whole.unionByName(late.withColumn("date", F.to_date("window_start")))
    assert _same(L.read_lake(spark, path), both)
    assert L.compact_lake(spark, path, "2024-02-01") == sorted(str(r[0]) for r in late.select(F.to_date("window_start")).distinct().collect())
    assert _same(L.read_lake(spark, path), both)
    files = _files(path)
    assert L.vacuum_lake(spark, path) > 0 and _files(path) < files
    assert not [d for d in os.listdir(path) if d.startswith("date=")] and len(os.listdir(f"{path}/_snapshots")) <= 2
    assert _same(L.read_lake(spark, path), both)
    L.write_lake(day, path, batch_id=0, run_id=1)                # a replay after the folders were removed
    assert _same(L.read_lake(spark, path), both)
    with pytest.raises(Exception):                               # a plain reader would see the replay alone
        assert spark.read.parquet(path).count() == both.count()


def test_compaction_that_dies_or_loses_changes_nothing(spark, tmp, monkeypatch):
    path = f"{tmp}/lake"
    w = _batches(spark, path, 2).filter("window_start < timestamp_ntz'2024-02-10 00:00:00'")
    real = L._Folder.write_text

    def dies(self, text, *names):
        if names[0] == "_snapshots":
            raise RuntimeError("lost the driver")
        return real(self, text, *names)
    monkeypatch.setattr(L._Folder, "write_text", dies)
    with pytest.raises(RuntimeError):
        L.compact_lake(spark, path, "2024-02-01")
    monkeypatch.setattr(L._Folder, "write_text", real)
    assert _same(L.read_lake(spark, path), w.withColumn("date", F.to_date("window_start")))

    def slower(self, text, *names):
        if names[0] == "_snapshots":
            real(self, "{}", *names)      # another compaction publishes first
        return real(self, text, *names)
    monkeypatch.setattr(L._Folder, "write_text", slower)
    with pytest.raises(RuntimeError, match="another"):
        L.compact_lake(spark, path, "2024-02-01")
    monkeypatch.setattr(L._Folder, "write_text", real)
    assert L.read_lake(spark, path).count() == w.count()
    assert len(L.compact_lake(spark, path, "2024-02-01")) > 0
    assert L.read_lake(spark, path).count() == w.count()
