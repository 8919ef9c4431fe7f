"""Registered queries: name -> (Spark builder, DuckDB oracle SQL or None).

Every builder reads the driver's tables from ``sf_dir`` (through
``tickwise.sources.tables``) and returns a DataFrame; nothing is sampled or
capped. Fixture choices: 1-hour windows over ``events`` (about three ticks
per window), ``detected_at`` = ``created_at`` = window_end, ``as_of`` = the
newest timestamp of the table. Computed doubles are rounded to 6 places on
both sides because the engines sum in different orders.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwise.functions.columns import round_cols, round_sql
from tickwise.operators.anomalies import detect_anomalies, z_scores
from tickwise.operators.features import window_features
from tickwise.operators.rolling import FEATURES, rolling_stats
from tickwise.plans import oracle as O
from tickwise.plans import quality as Q
from tickwise.plans import reports as R
from tickwise.sources import tables as T

Builder = Callable[[SparkSession, str], DataFrame]
_REG: dict[str, tuple[Builder, str | None]] = {}


def snap_rounds(sql: str) -> str:
    """Rewrite every ``round(expr, n)`` in oracle SQL to ``round_sql(expr, n)``,
    the rounding rule of the Spark side (snap to 9 places, then round)."""
    out, i, low = [], 0, sql.lower()
    while True:
        j = low.find("round(", i)
        if j < 0 or (j > 0 and (low[j - 1].isalnum() or low[j - 1] == "_")):
            if j < 0:
                out.append(sql[i:])
                return "".join(out)
            out.append(sql[i:j + 6])
            i = j + 6
            continue
        depth, k, comma = 0, j + 6, None
        while True:
            c = sql[k]
            if c == "(":
                depth += 1
            elif c == ")":
                if depth == 0:
                    break
                depth -= 1
            elif c == "," and depth == 0:
                comma = k
            k += 1
        inner, digits = sql[j + 6:comma], sql[comma + 1:k].strip()
        out.append(sql[i:j] + round_sql(snap_rounds(inner), int(digits)))
        i = k + 1


def register(name: str, sql: str | None):
    def deco(fn: Builder) -> Builder:
        _REG[name] = (fn, None if sql is None else snap_rounds(sql))
        return fn
    return deco


def _in_utc(fn: Builder) -> Builder:
    """The pipeline's timestamps are UTC (the reference runs every service with
    TZ=UTC); pin the session zone so text timestamps and NTZ casts agree."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        if spark.conf.get("spark.sql.session.timeZone") != "UTC":
            spark.conf.set("spark.sql.session.timeZone", "UTC")
        return fn(spark, sf_dir)
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


def queries() -> dict[str, Builder]:
    _load_extra()
    return {k: _in_utc(v[0]) for k, v in _REG.items()}


def oracle_sql() -> dict[str, str]:
    _load_extra()
    return {k: v[1] for k, v in _REG.items() if v[1] is not None}


def _load_extra():
    # modules that register more queries on import
    from tickwise.plans import catalog_io  # noqa: F401


def _clean(spark, sf):
    return T.clean_from_events(spark, sf)


def _anoms(spark, sf):
    return T.anomalies_from_events(spark, sf)


ANOM_COLS = ("symbol, asset_type, anomaly_type, detected_at, window_start, window_end, "
             "round(current_value, 6) AS current_value, round(mean_value, 6) AS mean_value, "
             "round(std_value, 6) AS std_value, round(z_score, 6) AS z_score, price, volume, "
             "severity")
ANOM_ROUND = ("current_value", "mean_value", "std_value", "z_score")
FEAT_COLS = ("symbol, asset_type, open_price, close_price, high_price, low_price, "
             "round(avg_price, 6) AS avg_price, total_volume, record_count, "
             "round(price_return_pct, 6) AS price_return_pct, "
             "round(rolling_volatility, 6) AS rolling_volatility, volume_delta, "
             "window_start, window_end")
FEAT_ROUND = ("avg_price", "price_return_pct", "rolling_volatility")

# ---------------------------------------------------------------------------
# features, rolling statistics, anomalies
# ---------------------------------------------------------------------------


@register("window_features", O.with_clean(f"SELECT {FEAT_COLS} FROM feat"))
def q_window_features(spark, sf):
    return round_cols(T.windows_from_events(spark, sf), FEAT_ROUND)


@register("window_features_5min",
          f"WITH {O.TICKS},\n{O.windows_cte('5 minutes')}\nSELECT {FEAT_COLS} FROM feat")
def q_window_features_5min(spark, sf):
    return round_cols(T.windows_from_events(spark, sf, "5 minutes"), FEAT_ROUND)


_STAT_SQL = ("SELECT symbol, asset_type, window_start, "
             "round(r_mean, 6) AS price_return_pct_mean, round(r_std, 6) AS price_return_pct_std, "
             "round(v_mean, 6) AS total_volume_mean, round(v_std, 6) AS total_volume_std, "
             "round(s_mean, 6) AS rolling_volatility_mean, "
             "round(s_std, 6) AS rolling_volatility_std FROM st")
_STAT_COLS = [f"{f}_{s}" for f in FEATURES for s in ("mean", "std")]


def _stats(spark, sf, lookback):
    st = rolling_stats(T.windows_from_events(spark, sf), lookback=lookback)
    return round_cols(st.select("symbol", "asset_type", "window_start", *_STAT_COLS), _STAT_COLS)


@register("rolling_stats", O.with_anomalies(_STAT_SQL))
def q_rolling_stats(spark, sf):
    return _stats(spark, sf, None)


@register("rolling_stats_lookback20", O.with_anomalies(_STAT_SQL, lookback=20))
def q_rolling_stats_20(spark, sf):
    return _stats(spark, sf, 20)


@register("rolling_stats_two_levels", O.with_anomalies(_STAT_SQL))
def q_rolling_stats_two_levels(spark, sf):
    """Chunks of 4 windows, scanned in groups and then over the groups."""
    st = rolling_stats(T.windows_from_events(spark, sf), levels=2, chunk_rows=4)
    return round_cols(st.select("symbol", "asset_type", "window_start", *_STAT_COLS), _STAT_COLS)


@register("z_scores", O.with_anomalies(
    "SELECT symbol, asset_type, window_start, round(r_z, 6) AS price_return_pct_z, "
    "round(v_z, 6) AS total_volume_z, round(s_z, 6) AS rolling_volatility_z FROM zs"))
def q_z_scores(spark, sf):
    z = z_scores(rolling_stats(T.windows_from_events(spark, sf)))
    zc = [f"{f}_z" for f in FEATURES]
    return round_cols(z.select("symbol", "asset_type", "window_start", *zc), zc)


@register("pct_fallback", O.with_anomalies(
    "SELECT symbol, asset_type, window_start, fb AS pct_anomaly FROM zs"))
def q_pct_fallback(spark, sf):
    from tickwise.functions.columns import pct_fallback
    w = T.windows_from_events(spark, sf)
    return w.select("symbol", "asset_type", "window_start", pct_fallback().alias("pct_anomaly"))


@register("detect_anomalies", O.with_anomalies(f"SELECT {ANOM_COLS} FROM anomalies"))
def q_detect_anomalies(spark, sf):
    return round_cols(T.anomalies_from_events(spark, sf).drop("created_at"), ANOM_ROUND)


@register("detect_anomalies_null_type", O.with_anomalies(f"SELECT {ANOM_COLS} FROM anomalies").replace(
    "THEN 'stock' ELSE 'crypto' END", "THEN 'stock' WHEN event_type <> 'click' THEN 'crypto' END"))
def q_detect_anomalies_null_type(spark, sf):
    """Symbols without an asset type are scored like any others."""
    t = T.ticks_from_events(spark, sf)
    t = t.withColumn("asset_type", F.when(F.col("symbol") != "click", F.col("asset_type")))
    w = window_features(t, T.FIXTURE_WIDTH, tie_breaker="event_id")
    return round_cols(detect_anomalies(w, detected_at="window_end"), ANOM_ROUND)


@register("detect_anomalies_lookback20",
          O.with_anomalies(f"SELECT {ANOM_COLS} FROM anomalies", lookback=20))
def q_detect_anomalies_20(spark, sf):
    return round_cols(T.anomalies_from_events(spark, sf, lookback=20).drop("created_at"),
                      ANOM_ROUND)


@register("detect_anomalies_5min", (
    f"WITH {O.TICKS},\n{O.windows_cte('5 minutes')},\n{O.anomalies_cte()}\n"
    f"SELECT {ANOM_COLS} FROM anomalies"))
def q_detect_anomalies_5min(spark, sf):
    w = T.windows_from_events(spark, sf, "5 minutes")
    return round_cols(detect_anomalies(w, detected_at="window_end"), ANOM_ROUND)


_STRICT_SQL = f"""SELECT {ANOM_COLS} FROM (
  SELECT symbol, asset_type, anomaly_type, window_end AS detected_at, window_start, window_end,
         current_value, mean_value, std_value, z_score, price, volume,
         CASE WHEN abs(z_score) > 5 THEN 'high' WHEN abs(z_score) > 4 THEN 'medium'
              ELSE 'low' END AS severity
  FROM (
    SELECT c.*, CASE c.anomaly_type
        WHEN 'price_spike' THEN abs(z.price_return_pct) > 3.0
        WHEN 'volatility_burst' THEN z.rolling_volatility > z.avg_price * 0.02
        ELSE false END AS own_rule,
      CASE c.anomaly_type WHEN 'price_spike' THEN z.r_std
        WHEN 'volume_surge' THEN z.v_std ELSE z.s_std END AS raw_std
    FROM cand c JOIN zs z USING (symbol, asset_type, window_start)) x
  WHERE (isfinite(z_score) AND abs(z_score) > 3.0) OR (raw_std IS NULL AND coalesce(own_rule, false)))"""


@register("detect_anomalies_strict", O.with_anomalies(_STRICT_SQL))
def q_detect_anomalies_strict(spark, sf):
    w = T.windows_from_events(spark, sf)
    return round_cols(detect_anomalies(w, detected_at="window_end", mode="strict"), ANOM_ROUND)


@register("severity", O.with_anomalies(
    "SELECT severity, count(*) AS count FROM anomalies GROUP BY severity"))
def q_severity(spark, sf):
    return _anoms(spark, sf).groupBy("severity").agg(F.count(F.lit(1)).alias("count"))


# ---------------------------------------------------------------------------
# stat panels and views
# ---------------------------------------------------------------------------

@register("tracked_symbols", O.with_clean(
    "SELECT count(DISTINCT symbol) AS symbols FROM clean"))
def q_tracked_symbols(spark, sf):
    return R.tracked_symbols(_clean(spark, sf))


@register("total_windows", O.with_clean("SELECT count(*) AS total FROM clean"))
def q_total_windows(spark, sf):
    return R.total_windows(_clean(spark, sf))


@register("total_ticks", O.with_clean("SELECT sum(record_count) AS total_ticks FROM clean"))
def q_total_ticks(spark, sf):
    return R.total_ticks(_clean(spark, sf))


@register("latest_update", O.with_clean("SELECT max(window_start) AS latest FROM clean"))
def q_latest_update(spark, sf):
    return R.latest_update(_clean(spark, sf))


@register("anomaly_count", O.with_anomalies(
    "SELECT count(*) AS anomalies FROM anomalies WHERE symbol <> 'SYSTEM'"))
def q_anomaly_count(spark, sf):
    return R.anomaly_count(_anoms(spark, sf))


@register("high_severity_count", O.with_anomalies(
    "SELECT count(*) AS high_severity FROM anomalies "
    "WHERE severity = 'high' AND symbol <> 'SYSTEM'"))
def q_high_severity_count(spark, sf):
    return R.high_severity_count(_anoms(spark, sf))


@register("latest_price", O.with_clean(
    "SELECT close_price FROM clean WHERE symbol = 'purchase' "
    "ORDER BY window_start DESC, record_count DESC, asset_type DESC LIMIT 1"))
def q_latest_price(spark, sf):
    return R.latest_price(_clean(spark, sf), "purchase")


@register("anomaly_summary", O.with_anomalies(
    "SELECT date_trunc('hour', detected_at) AS hour, symbol, asset_type, anomaly_type, "
    "count(*) AS anomaly_count, round(avg(abs(z_score)), 6) AS avg_abs_z_score, "
    "round(max(abs(z_score)), 6) AS max_abs_z_score FROM anomalies GROUP BY 1, 2, 3, 4"))
def q_anomaly_summary(spark, sf):
    return round_cols(R.anomaly_summary(_anoms(spark, sf)),
                      ("avg_abs_z_score", "max_abs_z_score"))


@register("volatility_trends", O.with_clean(
    "SELECT window_start, symbol, asset_type, round(rolling_volatility, 6) AS rolling_volatility, "
    "round(price_return_pct, 6) AS price_return_pct, volume, volume_delta FROM clean"))
def q_volatility_trends(spark, sf):
    return round_cols(R.volatility_trends(_clean(spark, sf)),
                      ("rolling_volatility", "price_return_pct"))


def _series_sql(col, alias):
    return O.with_clean(f"SELECT window_start AS time, symbol, round({col}, 6) AS {alias} "
                        "FROM clean")


@register("price_series", _series_sql("close_price", "price"))
def q_price_series(spark, sf):
    return round_cols(R.price_series(_clean(spark, sf)), ["price"])


@register("volume_series", _series_sql("volume", "volume"))
def q_volume_series(spark, sf):
    return round_cols(R.volume_series(_clean(spark, sf)), ["volume"])


@register("return_series", _series_sql("price_return_pct", "price_return_pct"))
def q_return_series(spark, sf):
    return round_cols(R.return_series(_clean(spark, sf)), ["price_return_pct"])


@register("volatility_series", _series_sql("rolling_volatility", "rolling_volatility"))
def q_volatility_series(spark, sf):
    return round_cols(R.volatility_series(_clean(spark, sf)), ["rolling_volatility"])


@register("volume_delta_series", _series_sql("volume_delta", "volume_delta"))
def q_volume_delta_series(spark, sf):
    return round_cols(R.volume_delta_series(_clean(spark, sf)), ["volume_delta"])


@register("time_filter", O.with_clean(
    "SELECT window_start AS time, symbol, close_price AS price FROM clean "
    "WHERE window_start BETWEEN (SELECT max(window_start) FROM clean) - INTERVAL 7 DAY "
    "AND (SELECT max(window_start) FROM clean)"))
def q_time_filter(spark, sf):
    c = _clean(spark, sf)
    end = c.select(F.max("window_start")).scalar()
    return R.price_series(c, end - F.expr("INTERVAL 7 DAYS"), end)


_EVENT_SYMBOLS = ["click", "error", "purchase", "signup", "view"]


@register("wide_series", O.with_clean(
    "PIVOT (SELECT window_start AS time, symbol, close_price FROM clean) ON symbol "
    "IN ('click', 'error', 'purchase', 'signup', 'view') USING first(close_price) GROUP BY time"))
def q_wide_series(spark, sf):
    """One column for each of the five listed event types. Rows of any other symbol
    have no column here nor in the SQL, and are not counted; a new type has to be
    added to both lists."""
    return R.wide_series(_clean(spark, sf), _EVENT_SYMBOLS)


_LATEST = ("(SELECT DISTINCT ON (symbol) * FROM clean "
           "ORDER BY symbol, window_start DESC, record_count DESC, asset_type DESC) l")


# a symbol's rows by recency: place 1 is its newest one
_PLACED = """, placed AS (SELECT *, row_number() OVER (PARTITION BY symbol
    ORDER BY window_start DESC, record_count DESC, asset_type DESC) AS place FROM clean)
"""


def _rounded(**digits: int) -> str:
    return ", ".join(f"round({c}, {n}) AS {c}" for c, n in digits.items())


@register("current_prices", O.with_clean(
    _PLACED + "SELECT symbol, asset_type, updated_at, "
    + _rounded(high=2, low=2, return_pct=4, volatility=6, close_price=2, volume=0) + """ FROM (
  SELECT symbol, asset_type, window_start AS updated_at, high_price AS high, low_price AS low, price_return_pct AS return_pct,
         rolling_volatility AS volatility, close_price, volume FROM placed WHERE place = 1) newest"""))
def q_current_prices(spark, sf):
    return R.current_prices(_clean(spark, sf))


@register("current_prices_short", O.with_clean(
    _PLACED + "SELECT symbol, updated_at, " + _rounded(price=2, volume=0, return_pct=4) + " FROM (SELECT symbol, "
    "window_start AS updated_at, close_price AS price, volume, price_return_pct AS return_pct FROM placed WHERE place = 1) newest"))
def q_current_prices_short(spark, sf):
    return R.current_prices_short(_clean(spark, sf))


@register("latest_rows", O.with_clean(
    _PLACED + "SELECT symbol, asset_type, window_start, round(close_price, 6) AS close_price, record_count, "
    "strftime(window_start, '%Y-%m-%d') || ' ' || symbol AS note, [symbol, asset_type] AS tags FROM placed WHERE place = 1"))
def q_latest_rows(spark, sf):
    """Newest rows of a table that has text and array columns."""
    c = _clean(spark, sf)
    c = c.withColumns({"note": F.concat_ws(" ", F.date_format("window_start", "yyyy-MM-dd"), "symbol"),
                       "tags": F.array("symbol", "asset_type")})
    return round_cols(R.latest_rows(c).select("symbol", "asset_type", "window_start", "close_price", "record_count",
                                              "note", "tags"), ["close_price"])


@register("ohlc_latest_per_symbol", O.with_clean(
    "SELECT symbol, asset_type, round(open_price, 2) AS open, round(high_price, 2) AS high, "
    "round(low_price, 2) AS low, round(close_price, 2) AS close, round(volume, 0) AS volume, "
    "round(rolling_volatility, 6) AS volatility, round(price_return_pct, 4) AS return_pct, "
    f"window_start FROM {_LATEST}"))
def q_ohlc_latest_per_symbol(spark, sf):
    return R.ohlc_latest_per_symbol(_clean(spark, sf))


@register("volatility_latest", O.with_clean(
    f"SELECT symbol, round(rolling_volatility, 6) AS rolling_volatility FROM {_LATEST}"))
def q_volatility_latest(spark, sf):
    return round_cols(R.volatility_latest(_clean(spark, sf)), ["rolling_volatility"])


@register("ohlc_latest_window", O.with_clean(
    "SELECT symbol, round(open_price, 2) AS open, round(high_price, 2) AS high, "
    "round(low_price, 2) AS low, round(close_price, 2) AS close, record_count AS ticks, "
    "window_start, window_end FROM clean "
    "WHERE window_start = (SELECT max(window_start) FROM clean)"))
def q_ohlc_latest_window(spark, sf):
    return R.ohlc_latest_window(_clean(spark, sf))


@register("recent_activity", O.with_clean(
    "SELECT symbol, asset_type, round(close_price, 2) AS close_price, round(volume, 0) AS volume, "
    "round(price_return_pct, 4) AS return_pct, round(rolling_volatility, 6) AS volatility, "
    "window_start, window_end FROM clean "
    "ORDER BY window_start DESC, symbol, asset_type LIMIT 50"))
def q_recent_activity(spark, sf):
    return R.recent_activity(_clean(spark, sf))


# alerts in display order: time first, then the columns that name the row
_ALERTS = """, shown AS (SELECT *, row_number() OVER (
    ORDER BY detected_at DESC, symbol, asset_type, anomaly_type, window_start DESC) AS place
  FROM anomalies WHERE symbol <> 'SYSTEM')
"""


@register("active_alerts", O.with_anomalies(
    _ALERTS + "SELECT detected_at, symbol, asset_type, anomaly_type, severity, "
    + _rounded(z_score=2, current_value=4, mean_value=4, price=2, volume=0) + " FROM shown WHERE place <= 100"))
def q_active_alerts(spark, sf):
    return R.active_alerts(_anoms(spark, sf))


@register("recent_anomalies", O.with_anomalies(
    "SELECT symbol, anomaly_type, severity, round(z_score, 2) AS z_score, round(price, 2) AS price, "
    "detected_at FROM anomalies WHERE symbol <> 'SYSTEM' "
    "AND created_at > (SELECT max(created_at) FROM anomalies) - INTERVAL 10 MINUTE "
    "ORDER BY detected_at DESC, symbol, anomaly_type, window_start DESC LIMIT 20"))
def q_recent_anomalies(spark, sf):
    return R.recent_anomalies(_anoms(spark, sf))


@register("volatility_scatter", O.with_clean(
    "SELECT round(rolling_volatility, 6) AS rolling_volatility, "
    "round(price_return_pct, 6) AS price_return_pct, symbol FROM clean "
    "WHERE rolling_volatility IS NOT NULL AND price_return_pct IS NOT NULL "
    "ORDER BY window_start, symbol, asset_type LIMIT 500"))
def q_volatility_scatter(spark, sf):
    return round_cols(R.volatility_scatter(_clean(spark, sf)),
                      ("rolling_volatility", "price_return_pct"))


@register("anomalies_per_hour", O.with_anomalies(
    "SELECT date_trunc('hour', detected_at) AS time, severity, count(*) AS count "
    "FROM anomalies WHERE symbol <> 'SYSTEM' GROUP BY 1, 2"))
def q_anomalies_per_hour(spark, sf):
    return R.anomalies_per_hour(_anoms(spark, sf))


@register("anomalies_by_type", O.with_anomalies(
    "SELECT anomaly_type, count(*) AS count FROM anomalies WHERE symbol <> 'SYSTEM' GROUP BY 1"))
def q_anomalies_by_type(spark, sf):
    return R.anomalies_by_type(_anoms(spark, sf))


@register("anomalies_by_symbol", O.with_anomalies(
    "SELECT symbol, count(*) AS count FROM anomalies WHERE symbol <> 'SYSTEM' GROUP BY 1"))
def q_anomalies_by_symbol(spark, sf):
    return R.anomalies_by_symbol(_anoms(spark, sf))


@register("severity_by_asset_type", O.with_anomalies(
    "SELECT asset_type, severity, count(*) AS count FROM anomalies "
    "WHERE symbol <> 'SYSTEM' GROUP BY 1, 2"))
def q_severity_by_asset_type(spark, sf):
    return R.severity_by_asset_type(_anoms(spark, sf))


@register("z_score_histogram", O.with_anomalies(
    "SELECT floor(z_score / 0.5) * 0.5 AS bucket, count(*) AS count FROM anomalies "
    "WHERE symbol <> 'SYSTEM' GROUP BY 1"))
def q_z_score_histogram(spark, sf):
    return R.z_score_histogram(_anoms(spark, sf))


@register("z_scores_in_range", O.with_anomalies(
    "SELECT round(z_score, 6) AS z_score FROM anomalies WHERE symbol <> 'SYSTEM'"))
def q_z_scores_in_range(spark, sf):
    return round_cols(R.z_scores_in_range(_anoms(spark, sf)), ["z_score"])


_LAST_HOUR = """, since AS (SELECT max(detected_at) - INTERVAL 1 HOUR AS bound FROM anomalies),
strength AS (SELECT anomaly_type, severity, abs(z_score) AS z FROM anomalies, since
  WHERE symbol <> 'SYSTEM' AND detected_at > bound)
"""


@register("anomaly_statistics", O.with_anomalies(
    _LAST_HOUR + "SELECT anomaly_type, severity, n AS count, round(mid, 2) AS avg_abs_zscore, round(top, 2) AS max_abs_zscore "
    "FROM (SELECT anomaly_type, severity, count(*) AS n, avg(z) AS mid, max(z) AS top FROM strength GROUP BY ALL) s"))
def q_anomaly_statistics(spark, sf):
    return R.anomaly_statistics(_anoms(spark, sf))


@register("anomaly_breakdown_1h", O.with_anomalies(
    "SELECT anomaly_type, severity, count(*) AS count FROM anomalies WHERE symbol <> 'SYSTEM' "
    "AND detected_at > (SELECT max(detected_at) FROM anomalies) - INTERVAL 1 HOUR GROUP BY 1, 2"))
def q_anomaly_breakdown_1h(spark, sf):
    return R.anomaly_breakdown_1h(_anoms(spark, sf))


@register("data_volume_trend", O.with_clean(
    "SELECT window_start, count(*) AS rows, count(DISTINCT symbol) AS symbols FROM clean "
    "WHERE window_start > (SELECT max(window_start) FROM clean) - INTERVAL 1 HOUR "
    "GROUP BY 1 ORDER BY 1 DESC LIMIT 12"))
def q_data_volume_trend(spark, sf):
    return R.data_volume_trend(_clean(spark, sf))


# ---------------------------------------------------------------------------
# quality and health
# ---------------------------------------------------------------------------

@register("dq_nulls", O.with_clean(
    "SELECT count(*) FILTER (WHERE symbol IS NULL OR close_price IS NULL OR volume IS NULL "
    "OR window_start IS NULL) AS null_rows, CASE WHEN count(*) FILTER (WHERE symbol IS NULL "
    "OR close_price IS NULL OR volume IS NULL OR window_start IS NULL) = 0 THEN 'PASS' "
    "ELSE 'WARNING' END AS status FROM clean"))
def q_dq_nulls(spark, sf):
    return Q.dq_nulls(_clean(spark, sf))


@register("dq_duplicates", O.with_clean(
    "SELECT count(*) AS duplicate_groups, CASE WHEN count(*) <= 5 THEN 'PASS' ELSE 'WARNING' END "
    "AS status FROM (SELECT symbol, window_start, count(*) AS cnt FROM clean "
    "GROUP BY symbol, window_start HAVING count(*) > 1) d"))
def q_dq_duplicates(spark, sf):
    return Q.dq_duplicates(_clean(spark, sf))


@register("dq_duplicates_by_hour", (
    f"WITH {O.TICKS} SELECT count(*) AS duplicate_groups, CASE WHEN count(*) <= 5 THEN 'PASS' "
    "ELSE 'WARNING' END AS status FROM (SELECT event_type, date_trunc('hour', ts) AS h "
    "FROM events GROUP BY 1, 2 HAVING count(*) > 1) d"))
def q_dq_duplicates_by_hour(spark, sf):
    ev = T.read_table(spark, sf, "events")
    return Q.dq_duplicates(ev.select(F.col("event_type"),
                                     F.date_trunc("hour", "ts").alias("h")),
                           keys=("event_type", "h"))


def _price_sanity_sql(interval: str) -> str:
    """Status of each symbol from the extent of its closes since ``interval`` before the newest window."""
    return O.with_clean(f""", since AS (SELECT max(window_start) - INTERVAL {interval} AS bound FROM clean),
extent AS (SELECT symbol, min(close_price) AS lo, max(close_price) AS hi, avg(close_price) AS mid
  FROM clean, since WHERE window_start > bound GROUP BY ALL)
SELECT symbol, lo AS min_price, hi AS max_price, round(mid, 2) AS avg_price,
  CASE WHEN lo <= 0 THEN '{Q.NEGATIVE_PRICES}' WHEN hi > 100 * lo THEN '{Q.EXTREME_RANGE}' ELSE 'PASS' END AS status
FROM extent""")


@register("dq_price_sanity", _price_sanity_sql("1 HOUR"))
def q_dq_price_sanity(spark, sf):
    return Q.dq_price_sanity(_clean(spark, sf))


@register("dq_price_sanity_all", _price_sanity_sql("30 DAY"))
def q_dq_price_sanity_all(spark, sf):
    return Q.dq_price_sanity(_clean(spark, sf), interval="30 days")


@register("data_freshness", O.with_clean(
    "SELECT max(window_start) AS latest_window, CASE WHEN max(window_start) > "
    "(SELECT max(created_at) FROM clean) - INTERVAL 15 MINUTE THEN 'FRESH' ELSE 'STALE' END "
    "AS status FROM clean"))
def q_data_freshness(spark, sf):
    return Q.data_freshness(_clean(spark, sf))


@register("load_verification", O.with_clean(
    "SELECT symbol, count(*) AS new_rows, round(min(close_price), 2) AS min_price, "
    "round(max(close_price), 2) AS max_price, round(sum(volume), 0) AS total_volume, "
    "min(window_start) AS earliest_window, max(window_start) AS latest_window FROM clean "
    "WHERE created_at > (SELECT max(created_at) FROM clean) - INTERVAL 10 MINUTE GROUP BY 1"))
def q_load_verification(spark, sf):
    return Q.load_verification(_clean(spark, sf))


@register("load_status", O.with_both(
    "SELECT n.new_rows, a.new_anomalies, CASE WHEN n.new_rows > 0 THEN 'SUCCESS' "
    "ELSE 'WARNING' END AS status FROM "
    "(SELECT count(*) AS new_rows FROM clean WHERE created_at > "
    "(SELECT max(created_at) FROM clean) - INTERVAL 10 MINUTE) n, "
    "(SELECT count(*) AS new_anomalies FROM anomalies WHERE symbol <> 'SYSTEM' AND created_at > "
    "(SELECT max(created_at) FROM clean) - INTERVAL 10 MINUTE) a"))
def q_load_status(spark, sf):
    return Q.load_status(*T.clean_and_anomalies(spark, sf))


@register("pipeline_health", O.with_clean(
    "SELECT symbol, count(*) AS total_rows, (SELECT count(*) FROM clean c2 "
    "WHERE c2.symbol = c1.symbol AND c2.created_at > "
    "(SELECT max(created_at) FROM clean) - INTERVAL 10 MINUTE) AS new_rows_10m, "
    "max(window_start) AS latest_window, max(created_at) AS last_insert "
    "FROM clean c1 GROUP BY symbol"))
def q_pipeline_health(spark, sf):
    return Q.pipeline_health(_clean(spark, sf))


@register("quality_summary", O.with_both(
    "SELECT (SELECT count(*) FROM clean) AS total_market_rows, "
    "(SELECT count(*) FROM anomalies WHERE symbol <> 'SYSTEM') AS total_anomalies, "
    "(SELECT count(DISTINCT symbol) FROM clean) AS tracked_symbols, "
    "(SELECT max(window_start) FROM clean) AS latest_data, "
    "(SELECT round(avg(record_count), 1) FROM clean WHERE window_start > "
    "(SELECT max(window_start) FROM clean) - INTERVAL 1 HOUR) AS avg_ticks_per_window"))
def q_quality_summary(spark, sf):
    return Q.quality_summary(*T.clean_and_anomalies(spark, sf))


@register("row_counts", O.with_both(
    "SELECT 'clean_market_data' AS table_name, count(*) AS row_count FROM clean UNION ALL "
    "SELECT 'market_anomalies', count(*) FROM anomalies WHERE symbol <> 'SYSTEM'"))
def q_row_counts(spark, sf):
    return Q.row_counts(*T.clean_and_anomalies(spark, sf))


@register("run_quality_checks", O.with_both(
    "SELECT 'nulls' AS \"check\", CAST(count(*) FILTER (WHERE symbol IS NULL OR close_price IS NULL "
    "OR volume IS NULL OR window_start IS NULL) AS VARCHAR) AS value, CASE WHEN count(*) FILTER "
    "(WHERE symbol IS NULL OR close_price IS NULL OR volume IS NULL OR window_start IS NULL) = 0 "
    "THEN 'PASS' ELSE 'WARNING' END AS status FROM clean "
    "UNION ALL SELECT 'duplicates', CAST(count(*) AS VARCHAR), CASE WHEN count(*) <= 5 THEN 'PASS' "
    "ELSE 'WARNING' END FROM (SELECT symbol, window_start FROM clean GROUP BY 1, 2 "
    "HAVING count(*) > 1) d "
    "UNION ALL SELECT 'freshness', CAST(max(window_start) AS VARCHAR), CASE WHEN max(window_start) > "
    "(SELECT max(created_at) FROM clean) - INTERVAL 15 MINUTE THEN 'FRESH' ELSE 'STALE' END FROM clean "
    "UNION ALL SELECT 'load', CAST(count(*) AS VARCHAR), CASE WHEN count(*) > 0 THEN 'SUCCESS' "
    "ELSE 'WARNING' END FROM clean WHERE created_at > "
    "(SELECT max(created_at) FROM clean) - INTERVAL 10 MINUTE"))
def q_run_quality_checks(spark, sf):
    return Q.run_quality_checks(_clean(spark, sf))


# ---------------------------------------------------------------------------
# bench-scale feature pipeline over lineitem (one symbol per supplier)
# ---------------------------------------------------------------------------

@register("lineitem_features", (
    f"WITH {O.LINEITEM_TICKS},\n{O.windows_cte('7 days', epoch_origin=True)}\nSELECT {FEAT_COLS} FROM feat"))
def q_lineitem_features(spark, sf):
    w = window_features(T.ticks_from_lineitem(spark, sf), "7 days", tie_breaker="event_id")
    return round_cols(w, FEAT_ROUND)


@register("lineitem_anomalies", (
    f"WITH {O.LINEITEM_TICKS},\n{O.windows_cte('7 days', epoch_origin=True)},\n"
    f"{O.anomalies_cte()}\nSELECT {ANOM_COLS} FROM anomalies"))
def q_lineitem_anomalies(spark, sf):
    """One symbol per supplier."""
    w = window_features(T.ticks_from_lineitem(spark, sf), "7 days", tie_breaker="event_id")
    return round_cols(detect_anomalies(w, detected_at="window_end"), ANOM_ROUND)
