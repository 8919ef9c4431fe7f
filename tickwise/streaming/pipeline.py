"""Structured Streaming: raw messages -> final windows -> scored anomalies.

* ``stream_features``: event-time watermark + tumbling-window aggregation in
  append mode, so every window is emitted exactly once, when final (the
  reference re-aggregates each 30 s micro-batch on its own and appends
  partial rows for the same window).
* ``stream_anomalies``: ``foreachBatch`` over those final windows. Each batch
  is scored against per-symbol moments of all earlier windows (a table of one
  row per symbol, versioned by batch id) — or, with a bounded ``lookback``,
  against the last ``lookback`` windows per symbol — so z-scores equal a
  batch run over the whole history.
* Every sink is idempotent per (run id, batch id): lake and anomaly files go to
  partitions of both, written with dynamic overwrite, the state table to version
  ``v=run-batch``. A run id belongs to a checkpoint: a new checkpoint on old
  paths gets the next one, so its batches, numbered from 0 again, replace
  nothing and continue the history. A batch replayed after a failure overwrites
  its own output; errors fail the query instead of being swallowed, so the batch
  is replayed rather than lost.
* Each source is a query of its own, with its own watermark, checkpoint and state,
  on shared outputs: a source that is behind loses nothing to one that is ahead,
  and one whose time stands still (a closed exchange) holds up nothing but itself.
  ``independent=False`` runs both as one query instead, where the slowest watermark
  decides for all windows.
* With a ``side_path``, messages that give no tick and ticks that come too late are
  written there, as they came, with the reason: ticks in windows, late ticks and
  rejects add up to the messages.
* The state of a batch is found through a manifest that names the version before
  it; a version that is gone is an error, never an empty history.
"""

from __future__ import annotations

import json
import logging
import os
import time
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import TimestampNTZType

from tickwise import schemas as S
from tickwise.functions.columns import interval_seconds
from tickwise.operators.anomalies import score_with_history, score_with_tail
from tickwise.operators.features import window_features
from tickwise.operators.ticks import CRYPTO, STOCK, Shape, align_columns, graded_messages, parse_messages, unify_ticks
from tickwise.session import checkpoint_dir, scratch
from tickwise.sinks.lake import write_lake


log = logging.getLogger("tickwise.streaming")


def watermarked(ticks: DataFrame, delay: str, time_col: str = "event_time") -> DataFrame:
    """One source's ticks with its own watermark, before the union with others."""
    if isinstance(ticks.schema[time_col].dataType, TimestampNTZType):
        ticks = ticks.withColumn(time_col, F.col(time_col).cast("timestamp"))
    return ticks.withWatermark(time_col, delay)


def stream_features(ticks: DataFrame, width: str = S.DEFAULT_WIDTH,
                    delay: str | None = "10 minutes", tie_breaker: str | None = None,
                    time_col: str = "event_time") -> DataFrame:
    """Final feature windows of a tick stream (append mode).

    ``delay`` is the watermark (None: the sources carry their own): ticks later than that behind the newest event
    time are dropped (``numRowsDroppedByWatermark`` counts what is left of them after
    the partial aggregation, one for each task, window and symbol; ``run_pipeline``
    with a ``side_path`` keeps every one); a window is emitted once the watermark
    passes its end. Spark filters late rows with
    the previous micro-batch's watermark and evicts with the current one, so a
    late row that arrives in the very batch that closes its window still
    counts. State = open windows x symbols.
    """
    marked = ticks if delay is None else watermarked(ticks, delay, time_col)
    return window_features(marked, width, tie_breaker, time_col)


class MissingHistory(RuntimeError):
    """The state that a batch has to continue from is not there."""


class VersionedTable:
    """A small per-symbol state table (moments, or the last windows), one
    version per (run, batch); a replayed batch rewrites its own version. The
    newest ``retain`` versions before the current one are kept, however far apart
    their batches are.

    Every finished write leaves a mark in the manifest. A batch continues from the
    version of the newest mark before it and fails if that version is not there or
    not whole. ``base`` is a table from which the first batch continues, if this one
    has no version yet (backfills before a stream)."""

    def __init__(self, spark: SparkSession, path: str, retain: int = 10, base: str | None = None):
        self.spark, self.path, self.retain = spark, path, retain
        self.base = VersionedTable(spark, base, retain) if base and base != path else None

    def _fs(self):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(self.path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), jvm

    def _listed(self, folder: str) -> list[tuple[int, int]]:
        fs, jvm = self._fs()
        p = jvm.org.apache.hadoop.fs.Path(folder)
        names = [st.getPath().getName() for st in fs.listStatus(p) if st.isDirectory()] if fs.exists(p) else []
        return sorted(tuple(map(int, n[2:].split("-"))) for n in names if n.startswith("v="))

    def versions(self) -> list[tuple[int, int]]:
        return self._listed(self.path)

    def marks(self) -> list[tuple[int, int]]:
        """(run, batch) of every finished write."""
        return self._listed(f"{self.path}/_manifest")

    @staticmethod
    def _name(version: tuple[int, int]) -> str:
        return f"v={version[0]}-{version[1]}"

    def _folder(self, version: tuple[int, int]) -> str:
        return f"{self.path}/{self._name(version)}"

    def read(self, batch_id: int, run_id: int = 0) -> DataFrame | None:
        """The version that the manifest names for the batch (None for the first one).

        It is chosen from folder names (a metadata listing of few entries), so no
        Spark job runs and only that one version's files are read.
        """
        marks = self.marks()
        older = [v for v in marks or self.versions() if v < (run_id, batch_id)]   # versions: a table without a manifest
        if not older:
            return self.base.read(batch_id, run_id) if self.base else None
        folder = self._folder(older[-1])
        fs, jvm = self._fs()
        if not fs.exists(jvm.org.apache.hadoop.fs.Path(f"{folder}/_SUCCESS")):
            raise MissingHistory(f"batch {batch_id} of run {run_id} continues from {folder}, which is not there or not "
                                 "whole; restore it, or backfill the history before it")
        return self.spark.read.parquet(folder)

    def write(self, table: DataFrame, batch_id: int, run_id: int = 0) -> None:
        current = (run_id, batch_id)
        table.write.mode("overwrite").parquet(self._folder(current))
        fs, jvm = self._fs()
        fs.mkdirs(jvm.org.apache.hadoop.fs.Path(f"{self.path}/_manifest/{self._name(current)}"))
        for v in [v for v in self.versions() if v < current][:-self.retain]:
            for path in (f"{self.path}/_manifest/{self._name(v)}", self._folder(v)):   # the mark goes first
                fs.delete(jvm.org.apache.hadoop.fs.Path(path), True)


def run_of(spark: SparkSession, checkpoint: str, state_path: str) -> int:
    """The run id of a checkpoint, chosen when it is first used: one more than any
    run that ``state_path`` knows of, and noted in both folders. Run 0 is for
    backfills, which come before all streams."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()

    def folder(path: str):
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(conf), p

    def numbers(path: str) -> list[int]:
        fs, p = folder(path)
        found = [st.getPath().getName() for st in fs.listStatus(p)] if fs.exists(p) else []
        return [int(n[4:]) for n in found if n.startswith("run=")]
    marks, known = f"{checkpoint}/_tickwise", f"{state_path}/_runs"
    if own := numbers(marks):
        return max(own)
    versions = [r for r, _ in VersionedTable(spark, state_path).versions()]
    run_id = 1 + max([0, *numbers(known), *versions])
    for path in (known, marks):
        fs, p = folder(f"{path}/run={run_id}")
        fs.mkdirs(p)
    return run_id


def write_batch_partition(df: DataFrame, path: str, batch_id: int, run_id: int = 0) -> None:
    """Idempotent append: the rows of one batch replace its own partition."""
    (df.withColumns({"run_id": F.lit(int(run_id)).cast("long"), "batch_id": F.lit(int(batch_id)).cast("long")})
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("run_id", "batch_id").parquet(path))


def _owning(spark: SparkSession, process: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """``process``, with the intermediate tables of each batch removed at its end."""
    def run(batch: DataFrame, batch_id: int) -> None:
        with scratch(spark):
            process(batch, batch_id)
    return run


def make_batch_scorer(spark: SparkSession, lake_path: str, anomalies_path: str,
                      state_path: str, threshold: float = S.Z_SCORE_THRESHOLD,
                      mode: str = "compat", extra_sinks: list[Callable] | None = None,
                      lookback: int | None = None,
                      width: str | None = None, run_id: int = 0,
                      base_state: str | None = None) -> Callable[[DataFrame, int], None]:
    """The ``foreachBatch`` body: lake write, scoring with history, sinks.

    State: per-symbol moments of all earlier windows (``lookback=None``) or
    the last ``lookback`` windows per symbol. A known window ``width`` fixes
    the scan's chunk length up front (no per-batch job to measure it).
    """
    store = VersionedTable(spark, state_path, base=base_state)
    sinks = _bound(extra_sinks, run_id, state_path)
    w_sec = interval_seconds(width) if width else None
    chunk_seconds = w_sec * 256 if w_sec else None

    def process(batch: DataFrame, batch_id: int) -> None:
        # persist first: the emptiness check then fills the cache instead of
        # running the micro-batch plan once more
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if batch.isEmpty():
                return
            # counts come from the writes themselves (observe), not extra actions
            seen = Observation(f"windows_{batch_id}")
            write_lake(batch.observe(seen, F.count(F.lit(1)).alias("windows")), lake_path,
                       batch_id, run_id)
            history = store.read(batch_id, run_id)
            if lookback is None:
                anomalies, new_history = score_with_history(batch, history, threshold, mode,
                                                            chunk_seconds=chunk_seconds)
            else:
                anomalies, new_history = score_with_tail(batch, history, lookback, threshold,
                                                         mode)
            anomalies = anomalies.persist(StorageLevel.MEMORY_AND_DISK)
            flagged = Observation(f"anomalies_{batch_id}")
            try:
                write_batch_partition(
                    anomalies.observe(flagged, F.count(F.lit(1)).alias("anomalies")),
                    anomalies_path, batch_id, run_id)
                log.info("batch %d: %s windows, %s anomalies", batch_id,
                         seen.get.get("windows"), flagged.get.get("anomalies"))
                for sink in sinks:
                    sink(batch, anomalies, batch_id)
                # state last: a failure above replays the batch from the old state
                store.write(new_history, batch_id, run_id)
            finally:
                anomalies.unpersist()
        finally:
            batch.unpersist()

    return _owning(spark, process)


class JdbcSink:
    """An ``extra_sinks`` entry that merges windows and anomalies into a relational
    store, both tables in one transaction and every (pipeline, run, batch) once, so
    a replayed batch changes nothing."""

    def __init__(self, url: str, properties: dict | None = None, clean_table: str = S.TOPIC_CLEAN,
                 anomalies_table: str = S.TOPIC_ANOMALIES, num_partitions: int | None = None,
                 run_id: int = 0, origin: str = ""):
        self.url, self.properties, self.num_partitions = url, properties, num_partitions
        self.tables, self.run_id, self.origin = (clean_table, anomalies_table), run_id, origin

    def for_run(self, run_id: int, origin: str) -> JdbcSink:
        """The same sink for the batches of one run of one pipeline."""
        return JdbcSink(self.url, self.properties, *self.tables, self.num_partitions, run_id, origin)

    def __call__(self, windows: DataFrame, anomalies: DataFrame, batch_id: int) -> None:
        from tickwise.sinks.jdbc import clean_rows, merge_batch
        clean_table, anomalies_table = self.tables
        merge_batch({clean_table: clean_rows(windows), anomalies_table: anomalies.select(*S.ANOMALY_COLUMNS)},
                    self.url, self.properties, self.run_id, batch_id, self.origin, num_partitions=self.num_partitions)


#: The sink's name among the functions of this module.
jdbc_sink = JdbcSink


def _bound(sinks: list[Callable] | None, run_id: int, origin: str) -> list[Callable]:
    """The sinks of a run: those that tell runs apart are given its number and the
    name of the pipeline (the path of its state)."""
    return [s.for_run(run_id, origin) if hasattr(s, "for_run") else s for s in sinks or []]


def kafka_sink(servers: str, clean_topic: str = S.TOPIC_CLEAN, anomalies_topic: str = S.TOPIC_ANOMALIES
               ) -> Callable[[DataFrame, DataFrame, int], None]:
    """An ``extra_sinks`` entry that publishes windows and anomalies to the two
    result topics (at least once: a replayed batch is published again)."""
    from tickwise.sinks.kafka import write_kafka

    def sink(windows: DataFrame, anomalies: DataFrame, batch_id: int) -> None:
        write_kafka(windows, clean_topic, servers)
        write_kafka(anomalies, anomalies_topic, servers)
    return sink


def make_per_batch_processor(spark: SparkSession, lake_path: str, anomalies_path: str,
                             width: str = S.DEFAULT_WIDTH, threshold: float = S.Z_SCORE_THRESHOLD,
                             mode: str = "compat", min_rows: int = 2,
                             extra_sinks: list[Callable] | None = None,
                             run_id: int = 0) -> Callable[[DataFrame, int], None]:
    """Reference-compatible ``foreachBatch`` body over raw ticks: each
    micro-batch is windowed and scored on its own (history = the batch's own
    windows, no anomalies below ``min_rows`` windows). A window spanning two
    batches yields two partial rows, as in the reference."""
    from tickwise.operators.anomalies import detect_anomalies
    sinks = _bound(extra_sinks, run_id, anomalies_path)

    def process(ticks: DataFrame, batch_id: int) -> None:
        ticks = ticks.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if ticks.isEmpty():
                return
            windows = window_features(ticks, width, "tie" if "tie" in ticks.columns else None).persist(StorageLevel.MEMORY_AND_DISK)
            try:
                write_lake(windows, lake_path, batch_id, run_id)
                anomalies = detect_anomalies(windows, threshold, mode=mode, min_rows=min_rows)
                write_batch_partition(anomalies, anomalies_path, batch_id, run_id)
                for sink in sinks:
                    sink(windows, anomalies, batch_id)
            finally:
                windows.unpersist()
        finally:
            ticks.unpersist()

    return _owning(spark, process)


def backfill(ticks: DataFrame, lake_path: str, anomalies_path: str, state_path: str,
             batch_id: int, width: str = S.DEFAULT_WIDTH, tie_breaker: str | None = None,
             threshold: float = S.Z_SCORE_THRESHOLD, mode: str = "compat",
             lookback: int | None = None) -> None:
    """Batch ingestion of a complete tick set (e.g. history) through the same
    scorer as the stream: windows -> lake, anomalies, per-symbol state.

    Batches must cover later time ranges in increasing ``batch_id`` order, as
    the stream guarantees; re-running a batch id replaces its output. Backfills
    are run 0, so streams started later on the same paths continue their history
    and replace nothing.
    """
    windows = window_features(ticks, width, tie_breaker)
    fn = make_batch_scorer(ticks.sparkSession, lake_path, anomalies_path, state_path,
                           threshold, mode, None, lookback, width)
    fn(windows, batch_id)


def late_before(spark: SparkSession, checkpoint: str, batch_id: int) -> int:
    """Milliseconds up to which windows were closed when the batch came: the watermark
    that the checkpoint holds for the batch before it (Spark drops late rows by that
    one). It is noted before a batch runs, so a replay sees the same."""
    if batch_id == 0:
        return 0
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/offsets/{batch_id - 1}")
    stream = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(p)
    try:
        lines = jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").splitlines()
    finally:
        stream.close()
    return int(json.loads(lines[1])["batchWatermarkMs"])


def _with_messages(features: DataFrame, graded: DataFrame) -> DataFrame:
    """Final windows and graded messages as rows of one stream, so that a micro-batch
    brings both (the source is one and the same in both branches)."""
    window = F.struct(*[F.col(c) for c in features.columns])
    message = F.struct(*[F.col(c) for c in graded.columns if c != "tick"], F.col("tick.event_time").alias("event_time"))
    left, right = features.select(window.alias("window")), graded.select(message.alias("message"))
    return left.withColumn("message", F.lit(None).cast(right.schema["message"].dataType)).unionByName(
        right.withColumn("window", F.lit(None).cast(left.schema["window"].dataType)))


def with_side_output(process: Callable[[DataFrame, int], None], side_path: str, checkpoint: str, width: str,
                     run_id: int) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` body over ``_with_messages``: messages without a tick and
    late ticks go to ``side_path`` (their reasons, ``late`` for these), by run and
    batch, and the windows to ``process``. The batch is kept while it is used, the
    messages among it; they are not aggregated a second time."""
    def both(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            messages = batch.filter("message IS NOT NULL").select("message.*")
            closed = F.timestamp_millis(F.lit(late_before(spark, checkpoint, batch_id)))
            late = (messages.filter("reason IS NULL").withColumn("_end", F.window("event_time", width)["end"])
                    .filter(F.col("_end") <= closed).drop("_end").withColumn("reason", F.lit("late")))
            write_batch_partition(messages.filter("reason IS NOT NULL").unionByName(late), side_path, batch_id, run_id)
            process(batch.filter("window IS NOT NULL").select("window.*"), batch_id)
        finally:
            batch.unpersist()
    return both


class StreamGroup:
    """The queries of one pipeline. A failure of one of them ends the group when it is
    waited for, so that a restart replays it as a whole."""

    def __init__(self, queries: dict[str, StreamingQuery]):
        self.queries = queries

    @property
    def isActive(self) -> bool:
        return any(q.isActive for q in self.queries.values())

    @property
    def recentProgress(self) -> list:
        return [p for q in self.queries.values() for p in q.recentProgress]

    def exception(self):
        return next((e for q in self.queries.values() if (e := q.exception()) is not None), None)

    def stop(self) -> None:
        for q in self.queries.values():
            q.stop()

    def awaitTermination(self, timeout: float | None = None) -> bool:
        """True when all queries have ended, False after ``timeout`` seconds; raises the
        error of a query that failed, after stopping the others."""
        end = None if timeout is None else time.monotonic() + timeout
        while self.isActive and self.exception() is None:
            if end is not None and time.monotonic() >= end:
                return False
            time.sleep(0.1)
        if self.exception() is not None:
            self.stop()
            raise self.exception()
        return True


def stream_anomalies(features: DataFrame, lake_path: str, anomalies_path: str,
                     state_path: str | None = None, checkpoint: str | None = None,
                     trigger: dict | None = None, threshold: float = S.Z_SCORE_THRESHOLD,
                     mode: str = "compat", extra_sinks: list[Callable] | None = None,
                     query_name: str | None = None, lookback: int | None = None,
                     width: str | None = None, registry: str | None = None,
                     messages: DataFrame | None = None, side_path: str | None = None) -> StreamingQuery:
    """Start the scoring query over a stream of final windows.

    ``trigger``: e.g. ``{"processingTime": "30 seconds"}`` (the reference's
    cadence) or ``{"availableNow": True}``. Paths default to folders below the
    shared ``spark.checkpoint.dir``. ``registry`` is the folder that numbers the runs
    of all queries on the same outputs (default: the state). ``messages``
    (``graded_messages`` of the same stream) with a ``side_path``: see
    ``with_side_output``.
    """
    spark = features.sparkSession
    state_path = state_path or os.path.join(checkpoint_dir(spark), "moments")
    checkpoint = checkpoint or os.path.join(checkpoint_dir(spark), "pipeline")
    run_id = run_of(spark, checkpoint, registry or state_path)
    fn = make_batch_scorer(spark, lake_path, anomalies_path, state_path, threshold, mode,
                           extra_sinks, lookback, width, run_id, registry)
    if side_path is not None:
        features = _with_messages(features, messages)
        fn = with_side_output(fn, side_path, checkpoint, width or S.DEFAULT_WIDTH, run_id)
    w = (features.writeStream.foreachBatch(fn).outputMode("append")
         .option("checkpointLocation", checkpoint))
    if query_name:
        w = w.queryName(query_name)
    w = w.trigger(**(trigger or {"processingTime": "30 seconds"}))
    return w.start()


def run_pipeline(stock_raw: DataFrame, crypto_raw: DataFrame, lake_path: str,
                 anomalies_path: str, state_path: str | None = None,
                 checkpoint: str | None = None, trigger: dict | None = None,
                 width: str = S.DEFAULT_WIDTH, delay: str = "10 minutes",
                 crypto_delay: str | None = None, threshold: float = S.Z_SCORE_THRESHOLD, mode: str = "compat",
                 source_tz: str = "UTC", extra_sinks: list[Callable] | None = None,
                 lookback: int | None = None, per_batch: bool = False,
                 rocksdb_state: bool = False, independent: bool = True,
                 side_path: str | None = None) -> StreamGroup | StreamingQuery:
    """Raw stock + crypto message streams -> parse -> final windows -> lake + anomalies.

    Each source is a query of its own (a ``StreamGroup`` of ``stock`` and ``crypto``),
    with checkpoint and state in folders of that name below the given ones; their
    runs have numbers of their own, so the outputs are shared without conflict. A
    (symbol, asset_type) is expected from one source only. ``independent=False`` is
    one query over both, for checkpoints of that kind: there the slower source
    holds the windows of both open.

    ``delay`` is the lateness that the stock stream, and the crypto stream unless
    ``crypto_delay`` says otherwise, allows within itself; how far one stream is
    behind the other does not matter. ``side_path``: rejects and late ticks go there.
    ``per_batch=True`` reproduces the reference's micro-batch semantics instead
    (see ``make_per_batch_processor``; one query, nothing is late);
    ``extra_sinks`` e.g. ``[jdbc_sink(url)]``.
    ``rocksdb_state=True`` keeps the window state in RocksDB instead of the JVM
    heap (for many symbols x open windows); it must be chosen before the first
    run of a checkpoint, as must ``spark.sql.shuffle.partitions``. The session is
    left as it was: a query keeps the settings it was started with.
    """
    spark, strict = stock_raw.sparkSession, mode == "strict"
    state_path = state_path or os.path.join(checkpoint_dir(spark), "moments")
    checkpoint = checkpoint or os.path.join(checkpoint_dir(spark), "pipeline")
    raws: dict[str, tuple[DataFrame, Shape, str]] = {
        "stock": (stock_raw, STOCK, delay), "crypto": (crypto_raw, CRYPTO, crypto_delay or delay)}

    def zone(name: str) -> str:
        return source_tz if name == "stock" else "UTC"

    def graded(name: str) -> DataFrame:
        raw, shape, _ = raws[name]
        return graded_messages(raw, shape, zone(name), strict)
    if per_batch:
        run_id = run_of(spark, checkpoint, state_path)
        fn = make_per_batch_processor(spark, lake_path, anomalies_path, width,
                                      threshold, mode, extra_sinks=extra_sinks, run_id=run_id)
        messages = graded("stock").unionByName(graded("crypto"), allowMissingColumns=True)
        w = (messages.writeStream.foreachBatch(_ticks_and_rejects(fn, side_path, run_id)).outputMode("append")
             .option("checkpointLocation", checkpoint))
        return w.trigger(**(trigger or {"processingTime": "30 seconds"})).start()

    def start(ticks: DataFrame, messages: DataFrame | None, folder: str) -> StreamingQuery:
        feats = stream_features(align_columns(ticks, [*S.TICK_COLUMNS, "tie"]), width, None, "tie")
        return stream_anomalies(feats, lake_path, anomalies_path, f"{state_path}{folder}", f"{checkpoint}{folder}", trigger,
                                threshold, mode, extra_sinks, lookback=lookback, width=width, registry=state_path,
                                messages=messages, side_path=side_path)

    def ticks(name: str) -> DataFrame:
        raw, shape, wait = raws[name]
        return watermarked(parse_messages(raw, shape, zone(name), strict), wait)
    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider)
    try:
        if rocksdb_state:
            spark.conf.set(provider, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
        if independent:
            return StreamGroup({name: start(ticks(name), graded(name), f"/{name}") for name in raws})
        if (policy := spark.conf.get("spark.sql.streaming.multipleWatermarkPolicy")) != "min":
            raise ValueError(f"spark.sql.streaming.multipleWatermarkPolicy is {policy}: ticks of the slower source would be lost")
        return start(unify_ticks(ticks("stock"), ticks("crypto"), [*S.TICK_COLUMNS, "tie"]),
                     graded("stock").unionByName(graded("crypto"), allowMissingColumns=True), "")
    finally:
        spark.conf.set(provider, before)


def _ticks_and_rejects(process: Callable[[DataFrame, int], None], side_path: str | None,
                       run_id: int) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` body over graded messages: rejects to ``side_path``, ticks to ``process``."""
    def both(messages: DataFrame, batch_id: int) -> None:
        if side_path is None:
            process(messages.filter("reason IS NULL").select("tick.*"), batch_id)
            return
        messages = messages.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            rejects = messages.filter("reason IS NOT NULL").withColumn("event_time", F.col("tick.event_time")).drop("tick")
            write_batch_partition(rejects, side_path, batch_id, run_id)
            process(messages.filter("reason IS NULL").select("tick.*"), batch_id)
        finally:
            messages.unpersist()
    return both
