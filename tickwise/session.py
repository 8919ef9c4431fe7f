"""Session construction and cluster-facing settings."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark import SparkConf
from pyspark.sql import DataFrame, SparkSession

# Settings every session of ours wants where the cluster's configuration (and an
# active session) leaves them unset.
_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_session(master: str | None = None, app: str = "tickwise",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Return a session; on a cluster ``master`` stays None (spark-submit decides)."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    given = SparkConf()
    for k, v in _DEFAULTS.items():
        if not given.contains(k) and SparkSession.getActiveSession() is None:
            b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder named by the cluster in ``spark.checkpoint.dir``.

    Only when the setting is absent on a local master (tests) do we pick a
    folder ourselves; the chosen folder is written back so that every later
    call agrees on it. On a cluster a missing setting is an error: a
    machine-local folder would not survive the loss of an executor.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext          # absent on Spark Connect sessions
    except Exception:
        sc = None
    if not d and sc is not None:
        sc_dir = sc._jsc.sc().getCheckpointDir()
        d = sc_dir.get() if sc_dir.isDefined() else None
    if not d:
        master = sc.master if sc is not None else spark.conf.get("spark.master", "")
        if not master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3/...)")
        d = tempfile.mkdtemp(prefix="tickwise-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if sc is not None and not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir(d)
    return d


#: The folder of the innermost ``scratch`` block, below the checkpoint folder.
_RUN: ContextVar[str] = ContextVar("tickwise_run", default="")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written intermediate tables;
    inside a ``scratch`` block, one that goes with it."""
    return os.path.join(checkpoint_dir(spark), _RUN.get(), name)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """Owns the intermediate tables that are written in its block: they lie in one folder
    of the shared checkpoint folder, which is removed at the end, after errors too. Results
    have to be written or collected inside, as they read these tables. Blocks may be nested,
    and each thread has its own. What has to outlive a run (checkpoints and state of
    streams, lakes) has paths of its own and is not touched."""
    run = os.path.join(_RUN.get(), f"run-{uuid.uuid4().hex}")
    folder = os.path.join(checkpoint_dir(spark), run)
    outer = _RUN.set(run)
    try:
        yield folder
    finally:
        _RUN.reset(outer)
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


# logical nodes that are cheap to evaluate twice (a stored or cached relation
# behind projections and filters)
_CHEAP_NODES = {"Project", "Filter", "Union", "LogicalRelation", "InMemoryRelation", "LocalRelation",
                "SubqueryAlias", "Range", "HiveTableRelation",
                "DataSourceV2Relation", "DataSourceV2ScanRelation", "StreamingDataSourceV2Relation"}


def _is_cheap(plan) -> bool:
    if plan.nodeName() not in _CHEAP_NODES:
        return False
    kids = plan.children()
    return all(_is_cheap(kids.apply(i)) for i in range(kids.size()))


def is_stored(df: DataFrame) -> bool:
    """True when ``df`` is a scan (or cache) with only projections/filters on top.
    (False when the plan cannot be inspected, e.g. on Spark Connect.)"""
    try:
        return _is_cheap(df._jdf.queryExecution().optimizedPlan())
    except Exception:
        return False


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` once as Parquet under the shared checkpoint folder and read it back.

    Used where a plan must read its input twice (e.g. the two-level prefix
    scan): without it Spark would recompute the whole upstream (scan + tick
    aggregation) for the second branch. The written table also cuts the
    lineage, so a lost executor does not replay the upstream. Inputs that are
    already stored or cached are returned unchanged.
    """
    if is_stored(df):
        return df
    spark = df.sparkSession
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.parquet(path)
