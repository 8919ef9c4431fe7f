"""Raw message sources with the contract ``msg_key, json_value, topic,
kafka_timestamp, partition, offset`` (the last two null where unknown)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickwise import schemas as S


def kafka_projection(df: DataFrame) -> DataFrame:
    """Kafka record -> message contract (key/value bytes decoded to text)."""
    return df.selectExpr("CAST(key AS STRING) AS msg_key",
                         "CAST(value AS STRING) AS json_value",
                         "topic", "timestamp AS kafka_timestamp", "partition", "offset")


def read_kafka_ticks(spark: SparkSession, topic: str, servers: str,
                     starting_offsets: str = "latest", fail_on_data_loss: bool = False,
                     max_offsets_per_trigger: int | None = None) -> DataFrame:
    """Subscribe to one topic as a stream (needs the Kafka connector on the classpath).

    ``maxOffsetsPerTrigger`` bounds a micro-batch after downtime so a backlog
    is drained in steps instead of one oversized batch.
    """
    r = (spark.readStream.format("kafka")
         .option("kafka.bootstrap.servers", servers)
         .option("subscribe", topic)
         .option("startingOffsets", starting_offsets)
         .option("failOnDataLoss", str(fail_on_data_loss).lower()))
    if max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    return kafka_projection(r.load())


def read_message_files(spark: SparkSession, path: str, fmt: str = "parquet",
                       stream: bool = True, max_files_per_trigger: int | None = None) -> DataFrame:
    """The same contract from JSON/Parquet files (batch or stream)."""
    if stream:
        r = spark.readStream.schema(S.RAW_MESSAGE).format(fmt)
        if max_files_per_trigger:
            r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
        return r.load(path)
    return spark.read.schema(S.RAW_MESSAGE).format(fmt).load(path)
