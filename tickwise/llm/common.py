"""Helpers shared by the text operators."""

from __future__ import annotations

import gc
import pickle
import time
import uuid
from collections.abc import Callable
from typing import Any

from pyspark import cloudpickle
from pyspark.core.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwise.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back.

    Cuts the lineage: a lost executor re-reads the table instead of repeating
    what led to it. The folder is the one that spark.checkpoint.dir names.
    """
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Lets Spark drop the shuffle files of finished steps whose results are
    written: it does so when the driver has collected its garbage, and a job of
    several steps would otherwise hold the files of all of them at once. No
    DataFrame that holds a shuffle of a finished step may still have a name."""
    for _ in range(2):  # Python tells the driver's JVM a moment later what it has dropped
        gc.collect()
        time.sleep(1)
        spark.sparkContext._jvm.System.gc()


#: Rows in an Arrow batch, where the session has Spark's default.
BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(spark: SparkSession, rows: int = 1_000) -> None:
    """Texts are long: batches of Spark's default 10,000 rows would hold tens of
    MB in every Python worker. A session that has another value keeps it."""
    if spark.conf.get(BATCH) == "10000":
        spark.conf.set(BATCH, str(rows))


def send(df: DataFrame, value: Any) -> Broadcast:
    """``value``, pickled and broadcast once; callers pass only what has a bounded
    size (a model, a block of a query set). Classes of this package travel with it."""
    return df.sparkSession.sparkContext.broadcast(cloudpickle.dumps(value))


def received(sent: Broadcast) -> Callable[[], Any]:
    """A function that gives in a task what was sent."""
    return lambda: pickle.loads(sent.value)


def shared(df: DataFrame, value: Any) -> Callable[[], Any]:
    """A function that gives ``value`` in a task, for as long as the session lasts."""
    return received(send(df, value))


def free_name(df: DataFrame, base: str) -> str:
    """``base``, lengthened until no column of ``df`` has that name in any case."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def as_bytes(col: Column | str) -> Column:
    """UTF-8 bytes of a text column; null counts as the empty text."""
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(c.cast("string"), F.lit("")).cast("binary")


def as_text(col: Column | str) -> Column:
    """The text column with null as the empty text."""
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(c.cast("string"), F.lit(""))


def held_out(id_col: str = "doc_id") -> Column:
    """True for the fifth of the rows that no model may learn from:
    crc32 of the id as text is divisible by 5 (a null id counts as '')."""
    return F.crc32(as_bytes(F.col(id_col))) % 5 == 0
