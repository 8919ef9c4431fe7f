"""Seed anomaly rows for dashboards (a fixture, not computed data)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from tickwise import schemas as S

# ---------------------------------------------------------------------------
# The reference's seed anomalies, in its order.
# (symbol, asset_type, anomaly_type, detected_at, window_start, window_end,
#  current_value, mean_value, std_value, z_score, price, volume, severity, metadata)
# ---------------------------------------------------------------------------
SEED_ROWS = [
    ("bitcoin", "crypto", "price_spike", "2026-02-10 09:35:00", "2026-02-10 09:30:00", "2026-02-10 09:35:00", 69450.00, 69050.00, 120.00, 3.33, 69450.00, 50500000000, "high", '{"trigger":"sudden_price_increase","pct_change":0.58}'),
    ("bitcoin", "crypto", "price_spike", "2026-02-10 10:05:00", "2026-02-10 10:00:00", "2026-02-10 10:05:00", 69200.00, 68980.00, 85.00, 2.59, 69200.00, 50800000000, "medium", '{"trigger":"price_surge","pct_change":0.32}'),
    ("bitcoin", "crypto", "volume_anomaly", "2026-02-10 10:20:00", "2026-02-10 10:15:00", "2026-02-10 10:20:00", 51200000000, 50300000000, 250000000, 3.60, 69100.00, 51200000000, "high", '{"trigger":"volume_surge","pct_change":1.79}'),
    ("bitcoin", "crypto", "price_drop", "2026-02-10 10:40:00", "2026-02-10 10:35:00", "2026-02-10 10:40:00", 68750.00, 69020.00, 95.00, -2.84, 68750.00, 50600000000, "medium", '{"trigger":"sudden_price_drop","pct_change":-0.39}'),
    ("ethereum", "crypto", "price_spike", "2026-02-10 09:40:00", "2026-02-10 09:35:00", "2026-02-10 09:40:00", 2025.50, 2012.00, 4.50, 3.00, 2025.50, 28500000000, "high", '{"trigger":"price_surge","pct_change":0.67}'),
    ("ethereum", "crypto", "volume_anomaly", "2026-02-10 10:10:00", "2026-02-10 10:05:00", "2026-02-10 10:10:00", 29100000000, 28200000000, 300000000, 3.00, 2018.00, 29100000000, "medium", '{"trigger":"volume_spike","pct_change":3.19}'),
    ("ethereum", "crypto", "price_drop", "2026-02-10 10:30:00", "2026-02-10 10:25:00", "2026-02-10 10:30:00", 2005.20, 2015.00, 3.80, -2.58, 2005.20, 28000000000, "medium", '{"trigger":"price_decline","pct_change":-0.49}'),
    ("ethereum", "crypto", "volatility_spike", "2026-02-10 10:45:00", "2026-02-10 10:40:00", "2026-02-10 10:45:00", 0.0085, 0.0042, 0.0012, 3.58, 2013.00, 28200000000, "high", '{"trigger":"volatility_surge","rolling_vol":0.0085}'),
    ("solana", "crypto", "price_spike", "2026-02-10 09:50:00", "2026-02-10 09:45:00", "2026-02-10 09:50:00", 86.20, 84.50, 0.55, 3.09, 86.20, 4100000000, "high", '{"trigger":"price_breakout","pct_change":2.01}'),
    ("solana", "crypto", "volume_anomaly", "2026-02-10 10:15:00", "2026-02-10 10:10:00", "2026-02-10 10:15:00", 4500000000, 3950000000, 150000000, 3.67, 85.10, 4500000000, "high", '{"trigger":"volume_explosion","pct_change":13.92}'),
    ("solana", "crypto", "price_drop", "2026-02-10 10:35:00", "2026-02-10 10:30:00", "2026-02-10 10:35:00", 83.50, 84.60, 0.40, -2.75, 83.50, 3900000000, "medium", '{"trigger":"price_decline","pct_change":-1.30}'),
    ("cardano", "crypto", "volume_anomaly", "2026-02-10 09:55:00", "2026-02-10 09:50:00", "2026-02-10 09:55:00", 520000000, 420000000, 30000000, 3.33, 0.265, 520000000, "high", '{"trigger":"volume_spike","pct_change":23.81}'),
    ("cardano", "crypto", "price_spike", "2026-02-10 10:25:00", "2026-02-10 10:20:00", "2026-02-10 10:25:00", 0.272, 0.262, 0.003, 3.33, 0.272, 440000000, "medium", '{"trigger":"price_increase","pct_change":3.82}'),
    ("ripple", "crypto", "price_spike", "2026-02-10 10:00:00", "2026-02-10 09:55:00", "2026-02-10 10:00:00", 1.455, 1.420, 0.010, 3.50, 1.455, 3100000000, "high", '{"trigger":"price_surge","pct_change":2.46}'),
    ("ripple", "crypto", "volume_anomaly", "2026-02-10 10:20:00", "2026-02-10 10:15:00", "2026-02-10 10:20:00", 3400000000, 2960000000, 120000000, 3.67, 1.430, 3400000000, "high", '{"trigger":"volume_spike","pct_change":14.86}'),
    ("ripple", "crypto", "price_drop", "2026-02-10 10:40:00", "2026-02-10 10:35:00", "2026-02-10 10:40:00", 1.405, 1.425, 0.008, -2.50, 1.405, 2900000000, "low", '{"trigger":"minor_decline","pct_change":-1.40}'),
]
# startup marker row of the store (excluded from every anomaly report)
SYSTEM_ROW = ("SYSTEM", "system", "db_init", 0.0, 0.0, 1.0, 0.0, "low",
              '{"message": "Database initialized successfully"}')


def _ts(s: str) -> dt.datetime:
    return dt.datetime.strptime(s, "%Y-%m-%d %H:%M:%S")


def load_seed_anomalies(spark: SparkSession, with_system_row: bool = True,
                        init_time: str = "2026-02-10 09:00:00") -> DataFrame:
    """The seed rows as an anomaly DataFrame (``metadata`` as JSON text)."""
    rows = [(r[0], r[1], r[2], _ts(r[3]), _ts(r[4]), _ts(r[5]), float(r[6]), float(r[7]),
             float(r[8]), float(r[9]), float(r[10]), float(r[11]), r[12], r[13])
            for r in SEED_ROWS]
    if with_system_row:
        sy, at, kind, cur, mean, std, z, sev, meta = SYSTEM_ROW
        t = _ts(init_time)
        rows.insert(0, (sy, at, kind, t, t, t, cur, mean, std, z, None, None, sev, meta))
    return spark.createDataFrame(rows, S.SEED_ANOMALY)
