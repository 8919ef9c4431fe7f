"""Dashboard panels and views over the clean-window and anomaly tables.

``clean``: symbol, asset_type, window_start, window_end, open/close/high/low
price, volume, price_return_pct, rolling_volatility, volume_delta,
record_count (+ created_at). ``anomalies``: the detector's output (+ created_at).

Time ranges are explicit ``start``/``end`` arguments (None = open); "last N"
reports take ``as_of`` (default: the newest timestamp of the input, as an
uncorrelated scalar subquery). Every top-N has a unique sort key so the
result is deterministic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickwise.functions.columns import (
    epoch_micros, not_system, recent, round_half_away, time_filter,
)


def _as_of(df: DataFrame, col: str, as_of) -> Column:
    if as_of is None:
        return df.select(F.max(col)).scalar()
    return as_of if isinstance(as_of, Column) else F.lit(as_of)


def _hour(df: DataFrame, col: str) -> Column:
    """``date_trunc('hour', col)`` keeping the column's timestamp type (the
    function itself returns a session-time-zone TIMESTAMP even for NTZ input)."""
    return F.date_trunc("hour", col).cast(df.schema[col].dataType)


def _r(col: str, digits: int, alias: str | None = None) -> Column:
    return round_half_away(col, digits).alias(alias or col)


_FIXED_WIDTH = (T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType,
                T.FloatType, T.DoubleType, T.DateType, T.TimestampType, T.TimestampNTZType,
                T.DecimalType)


def _recency_key(clean: DataFrame) -> Column:
    """Newest first: window_start, then record_count, packed into one decimal."""
    return (epoch_micros(clean, "window_start").cast("decimal(38,0)")
            * F.expr("CAST(10000000000000000000 AS DECIMAL(38,0))")
            + F.coalesce(F.col("record_count"), F.lit(0)).cast("decimal(38,0)"))


def _latest_per_symbol(clean: DataFrame) -> DataFrame:
    """Newest row per symbol (``DISTINCT ON (symbol) ... ORDER BY window_start DESC``).

    Ties on window_start go to the larger record_count, then asset_type.
    Level 1 is a hash aggregation over the whole table per (symbol,
    asset_type): every fixed-width column is taken with ``max_by`` on one
    packed decimal key, so the partial aggregate reduces a hot symbol to one
    row per map task without sorting. Level 2 picks across asset types on
    that tiny result. A table with variable-width columns (``max_by`` of which would
    sort) goes through ``latest_rows``.
    """
    key = _recency_key(clean)
    names = [f.name for f in clean.schema.fields if f.name not in ("symbol", "asset_type")]
    cols = [f.name for f in clean.schema.fields
            if f.name in names and isinstance(f.dataType, _FIXED_WIDTH)]
    if cols != names:
        return latest_rows(clean)
    lvl1 = clean.groupBy("symbol", "asset_type").agg(
        F.max(key).alias("_k"), *[F.max_by(c, key).alias(c) for c in cols])
    rest = ["asset_type"] + cols
    return (lvl1.groupBy("symbol")
            .agg(F.max_by(F.struct(*rest), F.struct("_k", "asset_type")).alias("_r"))
            .select("symbol", *[F.col(f"_r.{c}").alias(c) for c in rest]))


def latest_rows(clean: DataFrame) -> DataFrame:
    """Whole rows of ``_latest_per_symbol``, columns of any type: the newest key of each
    symbol by a hash aggregation, then one join back that only the rows with that key
    pass. The keys' side has one row per symbol (Spark broadcasts it where that is
    small). Rows that tie in all of key and asset type are compared by a hash of
    their columns, so that the choice does not depend on their order.
    """
    key = _recency_key(clean)
    newest = (clean.groupBy("symbol", "asset_type").agg(F.max(key).alias("_k"))
              .groupBy("symbol").agg(F.max_by(F.struct("asset_type", "_k"), F.struct("_k", "asset_type")).alias("_n"))
              .select(F.col("symbol").alias("_symbol"), F.col("_n.asset_type").alias("_type"), F.col("_n._k").alias("_key")))
    same = (F.col("symbol").eqNullSafe(F.col("_symbol")) & F.col("asset_type").eqNullSafe(F.col("_type"))
            & (key == F.col("_key")))
    rows = clean.join(newest, same).select(*clean.columns)
    tie = F.xxhash64(*[F.col(c) for c in clean.columns])
    return (rows.groupBy("symbol").agg(F.max_by(F.struct(*clean.columns), tie).alias("_r"))
            .select(*[F.col(f"_r.{c}").alias(c) for c in clean.columns]))


# ---------------------------------------------------------------------------
# stat panels
# ---------------------------------------------------------------------------

def tracked_symbols(clean: DataFrame) -> DataFrame:
    return clean.agg(F.count_distinct("symbol").alias("symbols"))


def total_windows(clean: DataFrame) -> DataFrame:
    return clean.agg(F.count(F.lit(1)).alias("total"))


def total_ticks(clean: DataFrame) -> DataFrame:
    return clean.agg(F.sum("record_count").alias("total_ticks"))


def latest_update(clean: DataFrame) -> DataFrame:
    return clean.agg(F.max("window_start").alias("latest"))


def anomaly_count(anomalies: DataFrame) -> DataFrame:
    return anomalies.filter(not_system()).agg(F.count(F.lit(1)).alias("anomalies"))


def high_severity_count(anomalies: DataFrame) -> DataFrame:
    return (anomalies.filter((F.col("severity") == "high") & not_system())
            .agg(F.count(F.lit(1)).alias("high_severity")))


def latest_price(clean: DataFrame, symbol: str) -> DataFrame:
    """Close price of the symbol's newest window (one row, or none)."""
    return _latest_per_symbol(clean.filter(F.col("symbol") == symbol)).select("close_price")


# ---------------------------------------------------------------------------
# views
# ---------------------------------------------------------------------------

def anomaly_summary(anomalies: DataFrame) -> DataFrame:
    """Per hour x symbol x asset_type x anomaly_type: count, avg/max abs(z)."""
    return (anomalies.groupBy(_hour(anomalies, "detected_at").alias("hour"),
                              "symbol", "asset_type", "anomaly_type")
            .agg(F.count(F.lit(1)).alias("anomaly_count"),
                 F.avg(F.abs("z_score")).alias("avg_abs_z_score"),
                 F.max(F.abs("z_score")).alias("max_abs_z_score"))
            .orderBy(F.col("hour").desc()))


def volatility_trends(clean: DataFrame) -> DataFrame:
    return (clean.select("window_start", "symbol", "asset_type", "rolling_volatility",
                         "price_return_pct", "volume", "volume_delta")
            .orderBy(F.col("window_start").desc()))


# ---------------------------------------------------------------------------
# time-series panels: (time, symbol, value) ordered by time
# ---------------------------------------------------------------------------

def _series(clean, value_col, alias, start, end):
    return (clean.filter(time_filter("window_start", start, end))
            .select(F.col("window_start").alias("time"), "symbol",
                    F.col(value_col).alias(alias))
            .orderBy("time"))


def price_series(clean, start=None, end=None):
    return _series(clean, "close_price", "price", start, end)


def volume_series(clean, start=None, end=None):
    return _series(clean, "volume", "volume", start, end)


def return_series(clean, start=None, end=None):
    return _series(clean, "price_return_pct", "price_return_pct", start, end)


def volatility_series(clean, start=None, end=None):
    return _series(clean, "rolling_volatility", "rolling_volatility", start, end)


def volume_delta_series(clean, start=None, end=None):
    return _series(clean, "volume_delta", "volume_delta", start, end)


def wide_series(clean, symbols: list[str], value_col="close_price", start=None, end=None):
    """Wide time-series format: one column per listed symbol (pivot).

    The pivot values are an explicit argument: the panel shows a handful of
    symbols, and listing them keeps Spark from collecting every distinct
    symbol to the driver. (time, symbol) is unique, so ``first`` is exact.
    """
    base = clean.filter(time_filter("window_start", start, end)
                        & F.col("symbol").isin(*symbols))
    return (base.groupBy(F.col("window_start").alias("time"))
            .pivot("symbol", list(symbols)).agg(F.first(value_col)).orderBy("time"))


# ---------------------------------------------------------------------------
# latest-per-symbol tables
# ---------------------------------------------------------------------------

def current_prices(clean: DataFrame) -> DataFrame:
    return (_latest_per_symbol(clean)
            .select("symbol", "asset_type", _r("close_price", 2), _r("high_price", 2, "high"),
                    _r("low_price", 2, "low"), _r("volume", 0),
                    _r("price_return_pct", 4, "return_pct"),
                    _r("rolling_volatility", 6, "volatility"),
                    F.col("window_start").alias("updated_at"))
            .orderBy("symbol"))


def current_prices_short(clean: DataFrame) -> DataFrame:
    """The short form of the table: price, volume and return."""
    return (_latest_per_symbol(clean)
            .select("symbol", _r("close_price", 2, "price"), _r("volume", 0), _r("price_return_pct", 4, "return_pct"),
                    F.col("window_start").alias("updated_at"))
            .orderBy("symbol"))


def ohlc_latest_per_symbol(clean: DataFrame) -> DataFrame:
    return (_latest_per_symbol(clean)
            .select("symbol", "asset_type", _r("open_price", 2, "open"),
                    _r("high_price", 2, "high"), _r("low_price", 2, "low"),
                    _r("close_price", 2, "close"), _r("volume", 0),
                    _r("rolling_volatility", 6, "volatility"),
                    _r("price_return_pct", 4, "return_pct"), "window_start")
            .orderBy("symbol"))


def volatility_latest(clean: DataFrame) -> DataFrame:
    return _latest_per_symbol(clean).select("symbol", "rolling_volatility").orderBy("symbol")


def ohlc_latest_window(clean: DataFrame) -> DataFrame:
    """All symbols of the globally newest window (uncorrelated scalar subquery)."""
    latest = clean.select(F.max("window_start")).scalar()
    return (clean.filter(F.col("window_start") == latest)
            .select("symbol", _r("open_price", 2, "open"), _r("high_price", 2, "high"),
                    _r("low_price", 2, "low"), _r("close_price", 2, "close"),
                    F.col("record_count").alias("ticks"), "window_start", "window_end")
            .orderBy("symbol"))


# ---------------------------------------------------------------------------
# top-N tables
# ---------------------------------------------------------------------------

def recent_activity(clean, start=None, end=None, limit: int = 50):
    return (clean.filter(time_filter("window_start", start, end))
            .orderBy(F.col("window_start").desc(), "symbol", "asset_type")
            .limit(limit)
            .select("symbol", "asset_type", _r("close_price", 2), _r("volume", 0),
                    _r("price_return_pct", 4, "return_pct"),
                    _r("rolling_volatility", 6, "volatility"), "window_start", "window_end"))


def active_alerts(anomalies, start=None, end=None, limit: int = 100):
    return (anomalies.filter(time_filter("detected_at", start, end) & not_system())
            .orderBy(F.col("detected_at").desc(), "symbol", "asset_type", "anomaly_type",
                     F.col("window_start").desc())
            .limit(limit)
            .select("detected_at", "symbol", "asset_type", "anomaly_type", "severity",
                    _r("z_score", 2), _r("current_value", 4), _r("mean_value", 4),
                    _r("price", 2), _r("volume", 0)))


def recent_anomalies(anomalies, as_of=None, interval: str = "10 minutes", limit: int = 20):
    """Newest anomalies inserted in the last ``interval`` before ``as_of``."""
    a = _as_of(anomalies, "created_at", as_of)
    return (anomalies.filter(not_system() & recent("created_at", a, interval))
            .orderBy(F.col("detected_at").desc(), "symbol", "anomaly_type",
                     F.col("window_start").desc())
            .limit(limit)
            .select("symbol", "anomaly_type", "severity", _r("z_score", 2), _r("price", 2),
                    "detected_at"))


def volatility_scatter(clean, start=None, end=None, limit: int = 500):
    """Up to ``limit`` (volatility, return) points; ordered by time, symbol."""
    return (clean.filter(time_filter("window_start", start, end)
                         & F.col("rolling_volatility").isNotNull()
                         & F.col("price_return_pct").isNotNull())
            .orderBy("window_start", "symbol", "asset_type")
            .limit(limit)
            .select("rolling_volatility", "price_return_pct", "symbol"))


# ---------------------------------------------------------------------------
# anomaly breakdowns
# ---------------------------------------------------------------------------

def anomalies_per_hour(anomalies, start=None, end=None):
    return (anomalies.filter(time_filter("detected_at", start, end) & not_system())
            .groupBy(_hour(anomalies, "detected_at").alias("time"), "severity")
            .agg(F.count(F.lit(1)).alias("count"))
            .orderBy("time", "severity"))


def anomalies_by_type(anomalies):
    return (anomalies.filter(not_system()).groupBy("anomaly_type")
            .agg(F.count(F.lit(1)).alias("count")).orderBy(F.col("count").desc(), "anomaly_type"))


def anomalies_by_symbol(anomalies):
    return (anomalies.filter(not_system()).groupBy("symbol")
            .agg(F.count(F.lit(1)).alias("count")).orderBy(F.col("count").desc(), "symbol"))


def severity_by_asset_type(anomalies):
    return (anomalies.filter(not_system()).groupBy("asset_type", "severity")
            .agg(F.count(F.lit(1)).alias("count")).orderBy("asset_type", "severity"))


def z_score_histogram(anomalies, start=None, end=None, bucket_width: float = 0.5):
    """Counts of z-scores per bucket ``[k*w, (k+1)*w)``, computed server-side."""
    b = F.floor(F.col("z_score") / F.lit(bucket_width))
    return (anomalies.filter(time_filter("detected_at", start, end) & not_system())
            .groupBy((b * F.lit(bucket_width)).alias("bucket"))
            .agg(F.count(F.lit(1)).alias("count")).orderBy("bucket"))


def z_scores_in_range(anomalies, start=None, end=None):
    """Raw form of the histogram panel: the z-scores of the range."""
    return (anomalies.filter(time_filter("detected_at", start, end) & not_system())
            .select("z_score"))


def anomaly_statistics(anomalies, as_of=None, interval: str = "1 hour"):
    a = _as_of(anomalies, "detected_at", as_of)
    return (anomalies.filter(not_system() & recent("detected_at", a, interval))
            .groupBy("anomaly_type", "severity")
            .agg(F.count(F.lit(1)).alias("count"),
                 round_half_away(F.avg(F.abs("z_score")), 2).alias("avg_abs_zscore"),
                 round_half_away(F.max(F.abs("z_score")), 2).alias("max_abs_zscore"))
            .orderBy(F.col("count").desc(), "anomaly_type", "severity"))


def anomaly_breakdown_1h(anomalies, as_of=None, interval: str = "1 hour"):
    a = _as_of(anomalies, "detected_at", as_of)
    return (anomalies.filter(not_system() & recent("detected_at", a, interval))
            .groupBy("anomaly_type", "severity").agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.col("count").desc(), "anomaly_type", "severity"))


def data_volume_trend(clean, as_of=None, interval: str = "1 hour", limit: int = 12):
    a = _as_of(clean, "window_start", as_of)
    return (clean.filter(recent("window_start", a, interval))
            .groupBy("window_start")
            .agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("symbol").alias("symbols"))
            .orderBy(F.col("window_start").desc()).limit(limit))

