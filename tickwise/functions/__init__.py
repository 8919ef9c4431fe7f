"""Column-level building blocks (pure Spark expressions, no UDFs)."""

from tickwise.functions.columns import (  # noqa: F401
    epoch_micros, order_key, severity, pct_fallback, z_score, safe_ratio,
    threshold_band, severity_label, time_filter, recent, not_system,
    symbol_list, round_cols,
)
