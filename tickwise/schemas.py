"""Declared schemas and fixed values of the tick pipeline."""

from pyspark.sql.types import (
    DoubleType, IntegerType, LongType, StringType, StructField, StructType, TimestampType,
)

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's for identical results)
# ---------------------------------------------------------------------------
ASSET_TYPES = ("stock", "crypto")
SYSTEM_SYMBOL = "SYSTEM"
# (feature column, anomaly label), in this order
FEATURE_LABELS = (
    ("price_return_pct", "price_spike"),
    ("total_volume", "volume_surge"),
    ("rolling_volatility", "volatility_burst"),
)
Z_SCORE_THRESHOLD = 3.0
SEVERITY_HIGH_Z = 5.0      # abs(z) > 5  -> high
SEVERITY_MEDIUM_Z = 4.0    # abs(z) > 4  -> medium, else low
FALLBACK_RETURN_PCT = 3.0  # abs(return %) > 3
FALLBACK_VOL_RATIO = 0.02  # volatility > 2 % of the average price
DEFAULT_WIDTH = "5 minutes"
STOCK_TS_REGEX = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"   # yyyy-MM-dd HH:mm:ss
DEFAULT_STOCK_SYMBOLS = "AAPL,MSFT,GOOGL,AMZN,TSLA"
DEFAULT_CRYPTO_IDS = "bitcoin,ethereum,solana,cardano,ripple"
TOPIC_RAW_STOCK = "raw_stock_ticks"
TOPIC_RAW_CRYPTO = "raw_crypto_ticks"
TOPIC_CLEAN = "clean_market_data"
TOPIC_ANOMALIES = "market_anomalies"
FRESHNESS_LIMIT = "15 minutes"
RECENT_LOAD = "10 minutes"
DUPLICATE_TOLERANCE = 5
PRICE_RANGE_RATIO = 100.0
NEWEST_FILES, NEWEST_PARTITIONS = 20, 10
# dashboard colour steps: (lower bound of the 2nd band, lower bound of the 3rd)
ANOMALY_COUNT_BANDS = (1.0, 10.0)       # green / orange / red (provisioned panel)
ANOMALY_COUNT_BANDS_ALT = (5.0, 20.0)   # green / yellow / red (generated panel)
RETURN_PCT_BANDS = (2.0, 5.0)           # green / yellow / red
# intraday payload keys
INTRADAY_SERIES_KEY = "Time Series (5min)"
INTRADAY_FIELDS = (("open", "1. open"), ("high", "2. high"), ("low", "3. low"),
                   ("close", "4. close"), ("volume", "5. volume"))
PAYLOAD_RATE_LIMIT_KEY = "Note"
PAYLOAD_ERROR_KEY = "Error Message"
# spot-price payload keys
SPOT_FIELDS = (("price", "usd"), ("market_cap", "usd_market_cap"),
               ("volume_24h", "usd_24h_vol"), ("change_24h_pct", "usd_24h_change"))
SPOT_TIME_KEY = "last_updated_at"

# ---------------------------------------------------------------------------
# Schemas
# ---------------------------------------------------------------------------


def _s(*fields):
    return StructType([StructField(n, t, True) for n, t in fields])


RAW_MESSAGE = _s(("msg_key", StringType()), ("json_value", StringType()),
                 ("topic", StringType()), ("kafka_timestamp", TimestampType()),
                 ("partition", IntegerType()), ("offset", LongType()))

RAW_STOCK = _s(("symbol", StringType()), ("asset_type", StringType()),
               ("timestamp", StringType()), ("open", DoubleType()),
               ("high", DoubleType()), ("low", DoubleType()),
               ("close", DoubleType()), ("volume", DoubleType()),
               ("ingested_at", StringType()))

RAW_CRYPTO = _s(("symbol", StringType()), ("asset_type", StringType()),
                ("timestamp", StringType()), ("price", DoubleType()),
                ("open", DoubleType()), ("high", DoubleType()),
                ("low", DoubleType()), ("close", DoubleType()),
                ("volume", DoubleType()), ("market_cap", DoubleType()),
                ("volume_24h", DoubleType()), ("change_24h_pct", DoubleType()),
                ("ingested_at", StringType()))

TICK_COLUMNS = ["symbol", "asset_type", "event_time", "price", "open", "high",
                "low", "close", "volume", "kafka_timestamp"]

WINDOW_COLUMNS = ["symbol", "asset_type", "open_price", "close_price",
                  "high_price", "low_price", "avg_price", "total_volume",
                  "record_count", "price_return_pct", "rolling_volatility",
                  "volume_delta", "window_start", "window_end"]

CLEAN_COLUMNS = ["symbol", "asset_type", "window_start", "window_end",
                 "open_price", "close_price", "high_price", "low_price",
                 "volume", "price_return_pct", "rolling_volatility",
                 "volume_delta", "record_count"]

ANOMALY_COLUMNS = ["symbol", "asset_type", "anomaly_type", "detected_at",
                   "window_start", "window_end", "current_value", "mean_value",
                   "std_value", "z_score", "price", "volume", "severity"]

SEED_ANOMALY = _s(("symbol", StringType()), ("asset_type", StringType()),
                  ("anomaly_type", StringType()), ("detected_at", TimestampType()),
                  ("window_start", TimestampType()), ("window_end", TimestampType()),
                  ("current_value", DoubleType()), ("mean_value", DoubleType()),
                  ("std_value", DoubleType()), ("z_score", DoubleType()),
                  ("price", DoubleType()), ("volume", DoubleType()),
                  ("severity", StringType()), ("metadata", StringType()))

PAYLOAD = _s(("symbol", StringType()), ("payload", StringType()),
             ("fetched_at", TimestampType()))

EVENT_ID = LongType()
