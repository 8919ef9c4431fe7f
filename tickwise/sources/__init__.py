"""Sources: message streams, vendor payloads, seed rows, test-table fixtures."""

from tickwise.sources.messages import (  # noqa: F401
    kafka_projection, read_kafka_ticks, read_message_files,
)
from tickwise.sources.payloads import (  # noqa: F401
    classify_payload, flatten_intraday, flatten_ohlc, flatten_spot_prices,
    latest_tick_per_symbol, to_messages,
)
from tickwise.sources.seeds import load_seed_anomalies  # noqa: F401
