"""Publish rows as Kafka records: key = symbol, value = JSON of the row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def to_kafka_records(df: DataFrame, key_col: str = "symbol") -> DataFrame:
    """``(key, value)`` string columns, the shape the Kafka sink expects."""
    return df.select(F.col(key_col).cast("string").alias("key"),
                     F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias("value"))


def write_kafka(df: DataFrame, topic: str, servers: str, key_col: str = "symbol") -> None:
    """Batch write with acks=all (needs the Kafka connector on the classpath)."""
    (to_kafka_records(df, key_col).write.format("kafka")
     .option("kafka.bootstrap.servers", servers).option("topic", topic)
     .option("kafka.acks", "all").save())
