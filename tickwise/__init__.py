"""tickwise: market-tick analytics on Spark.

Raw price messages -> unified ticks -> tumbling OHLCV feature windows ->
rolling z-score anomalies -> reports, data-quality and health queries.
Every operator takes and returns DataFrames (batch or streaming where the
semantics allow), built from built-in Spark expressions only.
"""

from tickwise.session import checkpoint_dir, get_session, scratch

__all__ = ["checkpoint_dir", "get_session", "scratch"]
