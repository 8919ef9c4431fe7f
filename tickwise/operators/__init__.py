"""DataFrame operators: parsing, feature windows, rolling statistics, anomalies."""

from tickwise.operators.anomalies import (  # noqa: F401
    detect_anomalies, last_rows, score_with_history, score_with_tail, with_row_defaults,
    z_scores,
)
from tickwise.operators.features import to_clean, window_features  # noqa: F401
from tickwise.operators.rolling import merge_moments, moments, rolling_stats  # noqa: F401
from tickwise.operators.ticks import (  # noqa: F401
    align_columns, parse_crypto, parse_rejects, parse_stock, select_symbols, unify_ticks,
)
