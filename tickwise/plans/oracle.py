"""DuckDB SQL twins of the registered queries (the correctness oracle).

The CTEs below re-derive ticks, clean windows and anomalies from the
``events`` view with plain SQL (window functions over the full frame, no
chunking), so they check our distributed formulation independently.
"""

from __future__ import annotations

TICKS = """ticks AS (
  SELECT event_type AS symbol,
         CASE WHEN event_type IN ('purchase', 'signup') THEN 'stock' ELSE 'crypto' END AS asset_type,
         ts AS event_time, event_id, value AS price,
         TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS volume
  FROM events)"""


LINEITEM_TICKS = """ticks AS (
  SELECT CAST(l_suppkey AS VARCHAR) AS symbol,
         CASE WHEN l_linestatus = 'F' THEN 'stock' ELSE 'crypto' END AS asset_type,
         l_shipdate AS event_time, (l_orderkey * 8 + l_linenumber) * 1073741824
           + CAST(l_extendedprice * 100 AS BIGINT) * 64 + CAST(l_quantity AS BIGINT) AS event_id,
         l_extendedprice / l_quantity AS price, l_quantity AS volume
  FROM lineitem)"""


def windows_cte(width: str = "1 hour", epoch_origin: bool = False) -> str:
    # widths that divide a day align the same from any midnight; longer ones
    # need Spark's origin, the epoch
    bucket = (f"time_bucket(INTERVAL '{width}', event_time, TIMESTAMP '1970-01-01')"
              if epoch_origin else f"time_bucket(INTERVAL '{width}', event_time)")
    return f"""win AS (
  SELECT symbol, asset_type, {bucket} AS window_start,
         arg_min(price, (event_time, event_id)) FILTER (WHERE price IS NOT NULL) AS open_price,
         arg_max(price, (event_time, event_id)) FILTER (WHERE price IS NOT NULL) AS close_price,
         max(price) AS high_price, min(price) AS low_price, avg(price) AS avg_price,
         stddev_samp(price) AS price_std, sum(volume) AS total_volume,
         max(volume) AS max_volume, min(volume) AS min_volume, count(*) AS record_count
  FROM ticks GROUP BY 1, 2, 3),
feat AS (
  SELECT symbol, asset_type, open_price, close_price, high_price, low_price, avg_price,
         total_volume, record_count,
         CASE WHEN open_price <> 0 THEN (close_price - open_price) / open_price * 100 ELSE 0.0 END
           AS price_return_pct,
         coalesce(price_std, 0.0) AS rolling_volatility,
         max_volume - min_volume AS volume_delta,
         window_start, window_start + INTERVAL '{width}' AS window_end
  FROM win)"""


def anomalies_cte(lookback: int | None = None, threshold: float = 3.0) -> str:
    start = "UNBOUNDED PRECEDING" if lookback is None else f"{lookback} PRECEDING"
    return f"""st AS (
  SELECT *,
    avg(price_return_pct) OVER w AS r_mean, stddev_samp(price_return_pct) OVER w AS r_std,
    avg(total_volume) OVER w AS v_mean, stddev_samp(total_volume) OVER w AS v_std,
    avg(rolling_volatility) OVER w AS s_mean, stddev_samp(rolling_volatility) OVER w AS s_std
  FROM feat
  WINDOW w AS (PARTITION BY symbol, asset_type ORDER BY window_start
               ROWS BETWEEN {start} AND 1 PRECEDING)),
zs AS (
  SELECT *,
    CASE WHEN r_std IS NOT NULL AND r_std > 0 THEN (price_return_pct - r_mean) / r_std ELSE 0.0 END AS r_z,
    CASE WHEN v_std IS NOT NULL AND v_std > 0 THEN (total_volume - v_mean) / v_std ELSE 0.0 END AS v_z,
    CASE WHEN s_std IS NOT NULL AND s_std > 0 THEN (rolling_volatility - s_mean) / s_std ELSE 0.0 END AS s_z,
    (abs(price_return_pct) > 3.0 OR rolling_volatility > avg_price * 0.02) AS fb
  FROM st),
cand AS (
  SELECT symbol, asset_type, 'price_spike' AS anomaly_type, window_start, window_end,
         price_return_pct AS current_value, coalesce(r_mean, 0.0) AS mean_value,
         coalesce(r_std, 1.0) AS std_value, r_z AS z_score, close_price AS price,
         total_volume AS volume, fb FROM zs
  UNION ALL
  SELECT symbol, asset_type, 'volume_surge', window_start, window_end, total_volume,
         coalesce(v_mean, 0.0), coalesce(v_std, 1.0), v_z, close_price, total_volume, fb FROM zs
  UNION ALL
  SELECT symbol, asset_type, 'volatility_burst', window_start, window_end, rolling_volatility,
         coalesce(s_mean, 0.0), coalesce(s_std, 1.0), s_z, close_price, total_volume, fb FROM zs),
anomalies AS (
  SELECT symbol, asset_type, anomaly_type, window_end AS detected_at, window_start, window_end,
         current_value, mean_value, std_value, z_score, price, volume,
         CASE WHEN abs(z_score) > 5 THEN 'high' WHEN abs(z_score) > 4 THEN 'medium'
              ELSE 'low' END AS severity,
         window_end AS created_at
  FROM cand WHERE abs(z_score) > {threshold} OR (z_score = 0.0 AND fb))"""


CLEAN = """clean AS (
  SELECT symbol, asset_type, window_start, window_end, open_price, close_price, high_price,
         low_price, total_volume AS volume, price_return_pct, rolling_volatility, volume_delta,
         record_count, window_end AS created_at
  FROM feat)"""


def _after(ctes: str, body: str) -> str:
    """A query after its CTEs; a body that begins with a comma goes on with more of them."""
    return f"WITH {ctes}{body}" if body.startswith(",") else f"WITH {ctes}\n{body}"


def with_clean(body: str, width: str = "1 hour") -> str:
    return _after(f"{TICKS},\n{windows_cte(width)},\n{CLEAN}", body)


def with_anomalies(body: str, width: str = "1 hour", lookback: int | None = None) -> str:
    return _after(f"{TICKS},\n{windows_cte(width)},\n{anomalies_cte(lookback)}", body)


def with_both(body: str, width: str = "1 hour") -> str:
    return _after(f"{TICKS},\n{windows_cte(width)},\n{CLEAN},\n{anomalies_cte()}", body)
