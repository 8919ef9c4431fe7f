"""Parquet lake of feature windows, partitioned by ``date, asset_type``.

Writes are idempotent per micro-batch: each batch lands in its own
``run_id/batch_id`` partition below ``date/asset_type`` and is written with dynamic
partition overwrite, so a replayed batch replaces exactly what it wrote
before instead of appending a second copy.

``compact_lake`` rewrites closed days, which a stream leaves as thousands of small
files, into few: a generation of day folders under ``_compacted``, which plain readers
and Spark's file listing skip. A snapshot in ``_snapshots`` names the generation of
every compacted day; it is written aside and renamed, so a reader sees the lake before
or after a compaction, never in between. Each compacted day lists the batch folders
it covers: ``read_lake`` takes the day from its generation and, from the batch folders,
only those that are not covered (late batches), so a replayed old batch changes
nothing. ``vacuum_lake`` removes what no snapshot needs any more.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PARTITIONS = ("date", "asset_type", "run_id", "batch_id")
#: Rows of a compacted file.
FILE_ROWS = 1_000_000
_COMPACTED, _SNAPSHOTS, _COVERED = "_compacted", "_snapshots", "_covered"


def write_lake(windows: DataFrame, path: str, batch_id: int, run_id: int = 0,
               max_records_per_file: int | None = FILE_ROWS, by_symbol: bool = True) -> None:
    """Write window rows under ``path/date=../asset_type=../run_id=../batch_id=..``;
    rows already there for the same run and batch are replaced.

    Rows are hash-clustered by (date, asset_type, symbol) first: a writer task
    then holds whole day-partitions of symbols (at most one day / width rows
    per symbol, however hot) and writes few files; ``maxRecordsPerFile`` caps
    file size. ``by_symbol=False`` clusters by (date, asset_type): one file each,
    for batches that are small.
    """
    out = (windows.withColumn("date", F.to_date("window_start"))
           .withColumn("run_id", F.lit(int(run_id)).cast("long"))
           .withColumn("batch_id", F.lit(int(batch_id)).cast("long")))
    w = (out.repartition(*(["date", "asset_type"] + ["symbol"] * by_symbol)).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy(*PARTITIONS))
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", str(max_records_per_file))
    w.parquet(path)


class _Folder:
    """Names, small texts and renames in the file system of a lake."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.root = spark.sparkContext._jvm, path
        p = self.jvm.org.apache.hadoop.fs.Path(path)
        self.fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def at(self, *names: str):
        return self.jvm.org.apache.hadoop.fs.Path("/".join((self.root, *names)))

    def names(self, *folder: str) -> list[str]:
        p = self.at(*folder)
        return sorted(st.getPath().getName() for st in self.fs.listStatus(p)) if self.fs.exists(p) else []

    def leaves(self, day: str) -> list[str]:
        """asset_type=../run_id=../batch_id=.. of the batch folders of a day."""
        out = []
        for kind in self.names(day):
            for run in self.names(day, kind) if kind.startswith("asset_type=") else []:
                out += [f"{kind}/{run}/{b}" for b in self.names(day, kind, run) if b.startswith("batch_id=")]
        return out

    def read_text(self, *names: str) -> str:
        stream = self.fs.open(self.at(*names))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write_text(self, text: str, *names: str) -> bool:
        """Written aside and renamed; False if the name is taken."""
        aside = self.at(*names[:-1], f".{names[-1]}-{uuid.uuid4().hex}")
        stream = self.fs.create(aside, True)
        stream.write(bytearray(text.encode()))
        stream.close()
        if self.fs.exists(self.at(*names)) or not self.fs.rename(aside, self.at(*names)):
            self.fs.delete(aside, False)
            return False
        return True

    def delete(self, *names: str) -> None:
        self.fs.delete(self.at(*names), True)

    def snapshot(self) -> tuple[int, dict[str, str]]:
        """Number of the newest snapshot (0: none) and the generation of each compacted day."""
        numbers = [int(n[2:]) for n in self.names(_SNAPSHOTS) if n.startswith("v=")]
        return (max(numbers), json.loads(self.read_text(_SNAPSHOTS, f"v={max(numbers)}"))) if numbers else (0, {})

    def covered(self, generation: str, day: str) -> set[str]:
        return set(json.loads(self.read_text(_COMPACTED, generation, _COVERED, day)))


def _rows(spark: SparkSession, folder: _Folder, days: dict[str, str], first: str | None, last: str | None) -> DataFrame:
    """Rows of a lake under a snapshot, of the days from ``first`` to ``last``. The paths
    are named one by one, so no folder outside them is listed or read."""
    def wanted(day: str) -> bool:
        return (first is None or day >= f"date={first}") and (last is None or day <= f"date={last}")
    plain, packed = [], {}
    for day in folder.names():
        if not day.startswith("date=") or not wanted(day):
            continue
        if day not in days:
            plain.append(day)
        else:
            gone = folder.covered(days[day], day)
            plain += [f"{day}/{leaf}" for leaf in folder.leaves(day) if leaf not in gone]
    for day, generation in days.items():
        if wanted(day):
            packed.setdefault(generation, []).append(day)
    parts = [spark.read.option("basePath", folder.root).parquet(*(f"{folder.root}/{p}" for p in plain))] if plain else []
    for generation, names in sorted(packed.items()):
        base = f"{folder.root}/{_COMPACTED}/{generation}"
        parts.append(spark.read.option("basePath", base).parquet(*(f"{base}/{d}" for d in sorted(names))))
    if not parts:       # no day in the range: the lake's columns, and no rows
        every = [f"{_COMPACTED}/{g}" for g in sorted(set(days.values()))]
        return spark.read.parquet(f"{folder.root}/{every[0]}" if every else folder.root).filter(F.lit(False))
    same = [p.withColumns({"date": F.col("date").cast("date"), "run_id": F.col("run_id").cast("long"),
                           "batch_id": F.col("batch_id").cast("long")}) for p in parts]
    out = same[0]
    for p in same[1:]:
        out = out.unionByName(p)
    return out


def read_lake(spark: SparkSession, path: str, start=None, end=None,
              asset_type: str | None = None) -> DataFrame:
    """Read the lake for a time range, compacted days from their generation. The
    ``date`` bounds are derived from the range so Spark prunes partitions;
    ``window_start`` bounds go to the Parquet reader as pushed filters."""
    folder = _Folder(spark, path)
    _, days = folder.snapshot()

    def day(bound) -> str | None:
        return None if bound is None else str(bound)[:10]
    df = _rows(spark, folder, days, day(start), day(end)) if days else spark.read.parquet(path)
    cond = F.lit(True)
    if start is not None:
        cond = cond & (F.col("date") >= F.to_date(F.lit(start))) & \
            (F.col("window_start") >= F.lit(start).cast(df.schema["window_start"].dataType))
    if end is not None:
        cond = cond & (F.col("date") <= F.to_date(F.lit(end))) & \
            (F.col("window_start") <= F.lit(end).cast(df.schema["window_start"].dataType))
    if asset_type is not None:
        cond = cond & (F.col("asset_type") == asset_type)
    return df.filter(cond)


def compact_lake(spark: SparkSession, path: str, before: str | dt.date, rows_per_file: int = FILE_ROWS) -> list[str]:
    """Rewrite the days before ``before`` that are not compacted, or have batch folders
    that are not covered, into files of about ``rows_per_file`` rows, and publish them
    in one snapshot. Returns those days (``yyyy-mm-dd``). A compaction that dies, or
    meets another that was faster, leaves the lake as it was."""
    folder = _Folder(spark, path)
    version, days = folder.snapshot()
    todo = {}
    for name in folder.names():
        if name.startswith("date=") and name[5:] < str(before):
            leaves = set(folder.leaves(name))
            known = folder.covered(days[name], name) if name in days else set()
            if leaves - known:
                todo[name] = sorted(leaves | known)
    if not todo:
        return []
    generation = f"gen={version + 1}-{uuid.uuid4().hex[:8]}"
    base = f"{path}/{_COMPACTED}/{generation}"
    rows = _rows(spark, folder, days, min(todo)[5:], max(todo)[5:]).filter(F.col("date").isin([d[5:] for d in todo]))
    # as many writers for a day and type as its rows need, by a hash of the row's key
    files = rows.groupBy(F.col("date").alias("_day"), F.col("asset_type").alias("_type")).agg(
        F.ceil(F.count(F.lit(1)) / F.lit(rows_per_file)).alias("_files"))
    same = (F.col("date") == F.col("_day")) & F.col("asset_type").eqNullSafe(F.col("_type"))
    dealt = rows.join(files, same).withColumn("_file", F.pmod(F.xxhash64("symbol", "window_start"), F.col("_files"))) \
        .drop("_day", "_type", "_files")
    (dealt.repartition("date", "asset_type", "_file").drop("_file").sortWithinPartitions("date", "asset_type", "window_start")
     .write.partitionBy("date", "asset_type").parquet(base))
    for name, leaves in todo.items():
        folder.write_text(json.dumps(leaves), _COMPACTED, generation, _COVERED, name)
    if not folder.write_text(json.dumps(days | dict.fromkeys(todo, generation)), _SNAPSHOTS, f"v={version + 1}"):
        folder.delete(_COMPACTED, generation)
        raise RuntimeError(f"another compaction of {path} has published snapshot {version + 1}")
    return [d[5:] for d in sorted(todo)]


def vacuum_lake(spark: SparkSession, path: str) -> int:
    """Remove the batch folders that the newest snapshot covers, and generations and
    snapshots that it does not use. To be called when no reader uses an older one.
    From then on the lake is read with ``read_lake`` alone. Returns the number of
    folders removed."""
    folder = _Folder(spark, path)
    version, days = folder.snapshot()
    gone = 0
    for day, generation in days.items():
        covered = folder.covered(generation, day)
        leaves = folder.leaves(day)
        for leaf in covered.intersection(leaves):
            folder.delete(day, leaf)
            gone += 1
        if leaves and not set(leaves) - covered:
            folder.delete(day)
    for name in folder.names(_COMPACTED):
        if name not in days.values():
            folder.delete(_COMPACTED, name)
            gone += 1
    for name in folder.names(_SNAPSHOTS):
        if name != f"v={version}":
            folder.delete(_SNAPSHOTS, name)
    return gone
