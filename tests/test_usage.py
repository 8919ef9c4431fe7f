"""The README's batch usage example, end to end on local paths."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from tickwise.operators import (
    detect_anomalies, parse_crypto, parse_stock, to_clean, unify_ticks, window_features,
    with_row_defaults,
)
from tickwise.plans import quality, reports
from tickwise.sinks import read_lake, write_lake
from tickwise.sources import tables as T


def test_readme_batch_example(spark, tmp):
    raw_stock, raw_crypto = T.raw_stock_messages(spark, SF_SMALL), T.raw_crypto_messages(spark, SF_SMALL)
    ticks = unify_ticks(parse_stock(raw_stock), parse_crypto(raw_crypto))
    windows = window_features(ticks, "5 minutes")
    anomalies = with_row_defaults(detect_anomalies(windows))
    write_lake(windows, f"{tmp}/lake", batch_id=0)
    clean = to_clean(read_lake(spark, f"{tmp}/lake", "2024-01-10", "2024-01-11"))
    assert reports.current_prices(clean).count() == 5
    checks = quality.run_quality_checks(clean.withColumn("created_at", F.col("window_end")),
                                        anomalies).collect()
    assert [r["check"] for r in checks] == ["nulls", "duplicates", "freshness", "load"]
