"""Tumbling OHLCV feature windows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwise import schemas as S
from tickwise.functions.columns import order_key, safe_ratio


def window_features(ticks: DataFrame, width: str = S.DEFAULT_WIDTH,
                    tie_breaker: str | None = None,
                    time_col: str = "event_time") -> DataFrame:
    """One row per (tumbling window, symbol, asset_type) with OHLCV + features.

    * open/close = price of the earliest/latest tick with a price, ordered by
      event time then ``tie_breaker`` (deterministic, unlike arrival order).
    * high/low/avg, sample stddev of price, sum/max/min volume, tick count.
    * price_return_pct = (close-open)/open*100, 0.0 when open is 0 or null;
      rolling_volatility = stddev or 0.0; volume_delta = max - min volume.

    Plan: partial HashAggregate before the shuffle on (window, symbol,
    asset_type), so a hot symbol is pre-reduced map-side and each reducer
    only sees one partial row per key and map task. Works on a stream after
    ``withWatermark`` (see ``tickwise.streaming``).
    """
    key = F.when(F.col("price").isNotNull(), order_key(ticks, time_col, tie_breaker))
    price, volume = F.col("price"), F.col("volume")
    values = {
        "open_price": F.min_by(price, key), "close_price": F.max_by(price, key),
        "high_price": F.max(price), "low_price": F.min(price), "avg_price": F.avg(price),
        "total_volume": F.sum(volume), "record_count": F.count(F.lit(1)),
        "rolling_volatility": F.coalesce(F.stddev(price), F.lit(0.0)),
        "volume_delta": F.max(volume) - F.min(volume)}
    bars = ticks.groupBy(F.window(time_col, width).alias("w"), "symbol", "asset_type").agg(
        *(v.alias(name) for name, v in values.items()))
    change = safe_ratio(F.col("close_price") - F.col("open_price"), F.col("open_price")) * 100
    return bars.withColumn("price_return_pct", F.when(F.col("open_price") != 0, change).otherwise(0.0)).select(
        *S.WINDOW_COLUMNS[:-2], F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"))


def to_clean(windows: DataFrame) -> DataFrame:
    """Window rows in the stored clean-table shape (``total_volume`` -> ``volume``)."""
    return windows.withColumnRenamed("total_volume", "volume").select(*S.CLEAN_COLUMNS)
