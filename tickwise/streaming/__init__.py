"""Structured Streaming pipeline."""

from tickwise.streaming.pipeline import (  # noqa: F401
    VersionedTable, backfill, jdbc_sink, make_batch_scorer, make_per_batch_processor, run_pipeline, stream_anomalies, stream_features,
)
