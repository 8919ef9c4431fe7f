"""Sinks: Parquet lake, JDBC tables, Kafka records."""

from tickwise.sinks.jdbc import (  # noqa: F401
    merge_batch, read_table_jdbc, write_anomalies_jdbc, write_clean_jdbc,
)
from tickwise.sinks.kafka import to_kafka_records, write_kafka  # noqa: F401
from tickwise.sinks.lake import compact_lake, read_lake, vacuum_lake, write_lake  # noqa: F401
