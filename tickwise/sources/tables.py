"""Ticks, clean windows and anomalies derived from the driver's test tables.

``events`` maps to a small tick stream (5 symbols), ``lineitem`` to a wide
one (one symbol per supplier) used by the benchmark. ``created_at`` and
``detected_at`` are pinned to ``window_end`` so results are deterministic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwise.operators.anomalies import detect_anomalies
from tickwise.operators.features import to_clean, window_features
from tickwise.session import materialize

STOCK_EVENT_TYPES = ("purchase", "signup")
FIXTURE_WIDTH = "1 hour"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table. Tests and the benchmark, whose tables are single small files,
    name a number of partitions in the session; nothing else reshuffles a scan."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    n = spark.conf.get("tickwise.tables.partitions", None)
    return df.repartition(int(n)) if n else df


def ticks_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """symbol = event_type, price = value, volume = props.k, tie = event_id."""
    ev = read_table(spark, sf_dir, "events")
    return ev.select(
        F.col("event_type").alias("symbol"),
        F.when(F.col("event_type").isin(*STOCK_EVENT_TYPES), F.lit("stock"))
        .otherwise(F.lit("crypto")).alias("asset_type"),
        F.col("ts").alias("event_time"),
        F.col("event_id"),
        F.col("value").alias("price"),
        F.get_json_object("props", "$.k").try_cast("double").alias("volume"))


def ticks_from_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """symbol = supplier, asset_type by line status, day-resolution times.

    The tie-breaker packs (orderkey, linenumber, price in cents, quantity) into
    one BIGINT, as the first two are not unique in the test data: rows that still
    tie have equal prices.
    """
    li = read_table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_suppkey").cast("string").alias("symbol"),
        F.when(F.col("l_linestatus") == "F", F.lit("stock")).otherwise(F.lit("crypto"))
        .alias("asset_type"),
        F.col("l_shipdate").alias("event_time"),
        ((F.col("l_orderkey") * 8 + F.col("l_linenumber")) * (1 << 30)
         + F.round(F.col("l_extendedprice") * 100).cast("bigint") * 64 + F.col("l_quantity").cast("bigint"))
        .alias("event_id"),
        F.try_divide(F.col("l_extendedprice"), F.col("l_quantity")).alias("price"),
        F.col("l_quantity").alias("volume"))


def windows_from_events(spark, sf_dir, width: str = FIXTURE_WIDTH) -> DataFrame:
    return window_features(ticks_from_events(spark, sf_dir), width, tie_breaker="event_id")


def clean_from_events(spark, sf_dir, width: str = FIXTURE_WIDTH) -> DataFrame:
    """Clean-table rows plus ``created_at`` = window_end."""
    c = to_clean(windows_from_events(spark, sf_dir, width))
    return c.withColumn("created_at", F.col("window_end"))


def anomalies_from_events(spark, sf_dir, width: str = FIXTURE_WIDTH,
                          lookback: int | None = None) -> DataFrame:
    """Anomaly rows with ``detected_at`` = ``created_at`` = window_end."""
    a = detect_anomalies(windows_from_events(spark, sf_dir, width),
                         detected_at="window_end", lookback=lookback)
    return a.withColumn("created_at", F.col("window_end"))


def clean_and_anomalies(spark, sf_dir, width: str = FIXTURE_WIDTH) -> tuple[DataFrame, DataFrame]:
    """Both tables over one stored copy of the windows, so the ticks are read once."""
    windows = materialize(windows_from_events(spark, sf_dir, width), "windows")
    clean = to_clean(windows).withColumn("created_at", F.col("window_end"))
    return clean, detect_anomalies(windows, detected_at="window_end").withColumn("created_at", F.col("window_end"))


# ---------------------------------------------------------------------------
# raw JSON messages derived from events (for the parse operators)
# ---------------------------------------------------------------------------
# A data-driven defect exercises the fallback on every scale factor:
#   price <  2    -> unparsable timestamp text   -> broker timestamp used
# (messages that give no tick: ``with_bad_messages``)
BAD_TS_MAX_PRICE = 2.0
CANDLE_SYMBOL = "view"


def _message(t: DataFrame, js) -> DataFrame:
    return t.select(F.col("symbol").alias("msg_key"), js.alias("json_value"), F.col("topic"),
                    F.col("event_time").cast("timestamp").alias("kafka_timestamp"),
                    F.lit(0).alias("partition"), F.col("event_id").alias("offset"))


def raw_stock_messages(spark, sf_dir) -> DataFrame:
    t = ticks_from_events(spark, sf_dir).filter(F.col("asset_type") == "stock")
    t = t.withColumn("topic", F.lit("raw_stock_ticks"))
    bad_ts = F.coalesce(F.col("price") < BAD_TS_MAX_PRICE, F.lit(False))
    ts = F.when(bad_ts, F.lit("not a time")).otherwise(
        F.date_format("event_time", "yyyy-MM-dd HH:mm:ss"))
    p = F.col("price")
    return _message(t, F.to_json(F.struct(
        F.col("symbol"), F.col("asset_type"), ts.alias("timestamp"), p.alias("open"),
        p.alias("high"), p.alias("low"), p.alias("close"), F.col("volume"),
        F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss").alias("ingested_at"))))


def raw_crypto_messages(spark, sf_dir) -> DataFrame:
    """Spot-shaped messages, and candle-shaped ones for the ``view`` symbol."""
    t = ticks_from_events(spark, sf_dir).filter(F.col("asset_type") == "crypto")
    t = t.withColumn("topic", F.lit("raw_crypto_ticks"))
    bad_ts = F.coalesce(F.col("price") < BAD_TS_MAX_PRICE, F.lit(False))
    iso = F.date_format(F.col("event_time").cast("timestamp"),
                        "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")
    ts = F.when(bad_ts, F.lit("garbage")).otherwise(iso).alias("timestamp")
    p = F.col("price")
    candle = F.struct(F.col("symbol"), F.col("asset_type"), ts, p.alias("open"),
                      p.alias("high"), p.alias("low"), p.alias("close"),
                      F.lit(0.0).alias("volume"))
    spot = F.struct(F.col("symbol"), F.col("asset_type"), ts, p.alias("price"),
                    (p * 1000).alias("market_cap"), F.col("volume").alias("volume_24h"),
                    F.lit(0.5).alias("change_24h_pct"))
    return _message(t, F.when(F.col("symbol") == CANDLE_SYMBOL, F.to_json(candle))
                    .otherwise(F.to_json(spot)))


#: Kinds of messages that give no tick, by the volume of the event they stand for
#: (0 to 99), so that every scale factor has all of them.
BAD_MESSAGES = ("none", "blank", "cut off", "array", "number", "no symbol", "null symbol", "no time")


def with_bad_messages(messages: DataFrame) -> DataFrame:
    """``messages`` in which those of events with ``k`` < 8 are bad, each ``k`` in its own way
    (candles carry no ``k``, and all of them are good)."""
    js = F.col("json_value")
    told = F.when(F.col("topic") == "raw_stock_ticks", F.get_json_object(js, "$.volume")).otherwise(F.get_json_object(js, "$.volume_24h"))
    k = told.try_cast("double").cast("int")
    forms = (F.lit(None).cast("string"), F.lit(" "), F.substring(js, F.lit(1), F.length(js) - 3), F.concat(F.lit("["), js, F.lit("]")),
             F.lit("17"), F.regexp_replace(js, '"symbol":"[a-z]+",', ""), F.regexp_replace(js, '"symbol":"[a-z]+"', '"symbol":null'),
             F.regexp_replace(js, '"timestamp":"[^"]+"', '"timestamp":"never"'))
    bad = js
    for i, form in enumerate(forms):
        bad = F.when(k == i, form).otherwise(bad)
    return messages.withColumns({"json_value": bad, "kafka_timestamp": F.when(~F.coalesce(k == 7, F.lit(False)), F.col("kafka_timestamp"))})


# ---------------------------------------------------------------------------
# vendor payloads derived from events (for the payload flatteners)
# ---------------------------------------------------------------------------
# One response = the events of ``event_id div GROUP`` (at most GROUP ticks,
# whatever the data size). Defects, data-driven:
#   intraday: price < 5 -> "5. volume" missing (defaults to 0);
#             with defects also 5 <= price < 6 -> "5. volume" unreadable (null)
#   spot:     price < 2 -> last_updated_at = 0 (falls back to the fetch time)
#   candles:  price < 2 -> a 3-element entry (dropped)
PAYLOAD_GROUP = 4
UNREADABLE = "n/a"


def _grp(n):
    return F.expr(f"event_id div {n}")


def intraday_payloads(spark, sf_dir, with_defects: bool = False) -> DataFrame:
    """Intraday responses per (symbol, id group ``grp``). ``with_defects`` swaps in the
    other response kinds by group rule: min price < 1 -> rate-limit note,
    max price > 470 -> error message, a single tick -> empty series.

    Every tick is an entry of its own, also where ticks of a response have the same
    time (a map could not hold them); the entry of a tick without time is named ""."""
    from tickwise.schemas import INTRADAY_SERIES_KEY
    t = ticks_from_events(spark, sf_dir).filter(F.col("asset_type") == "stock")
    v, k = F.col("price").cast("string"), F.col("volume").cast("string")
    if with_defects:
        k = F.when(F.col("price").between(5, 5.999999), F.lit(UNREADABLE)).otherwise(k)
    fields = F.map_filter(
        F.create_map(F.lit("1. open"), v, F.lit("2. high"), v, F.lit("3. low"), v,
                     F.lit("4. close"), v, F.lit("5. volume"),
                     F.when(F.col("price") >= 5, k)),
        lambda _k, x: x.isNotNull())
    time = F.coalesce(F.date_format("event_time", "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lit(""))
    entry = F.concat(F.lit('"'), time, F.lit('":'), F.to_json(fields))
    g = t.groupBy("symbol", _grp(PAYLOAD_GROUP).alias("grp")).agg(
        F.array_join(F.collect_list(entry), ",").alias("series"),
        F.max("event_time").cast("timestamp").alias("fetched_at"),
        F.min("price").alias("lo"), F.max("price").alias("hi"), F.count(F.lit(1)).alias("n"))
    ok = F.concat(F.lit('{"%s":{' % INTRADAY_SERIES_KEY), F.col("series"), F.lit("}}"))
    if with_defects:
        ok = (F.when(F.col("lo") < 1, F.lit('{"Note": "API call frequency exceeded"}'))
              .when(F.col("hi") > 470, F.lit('{"Error Message": "Invalid API call"}'))
              .when(F.col("n") == 1, F.lit('{"%s": {}}' % INTRADAY_SERIES_KEY))
              .otherwise(ok))
    return g.select("symbol", "grp", ok.alias("payload"), "fetched_at")


def spot_payloads(spark, sf_dir) -> DataFrame:
    """One response for each event that is no candle, as a poll of one coin gives it."""
    t = ticks_from_events(spark, sf_dir).filter(
        (F.col("asset_type") == "crypto") & (F.col("symbol") != CANDLE_SYMBOL))
    upd = F.when(F.col("price") < 2, F.lit(0)).otherwise(F.unix_seconds(F.col("event_time").cast("timestamp")))
    info = F.struct(F.col("price").alias("usd"), (F.col("price") * 1000).alias("usd_market_cap"),
                    F.col("volume").alias("usd_24h_vol"), F.lit(0.5).alias("usd_24h_change"),
                    upd.alias("last_updated_at"))
    return t.select(F.lit("simple_price").alias("symbol"),
                    F.to_json(F.create_map("symbol", info)).alias("payload"),
                    F.col("event_time").cast("timestamp").alias("fetched_at"))


def ohlc_payloads(spark, sf_dir) -> DataFrame:
    t = ticks_from_events(spark, sf_dir).filter(F.col("symbol") == CANDLE_SYMBOL)
    ms = F.unix_millis(F.col("event_time").cast("timestamp")).cast("double")
    p = F.col("price")
    arr = F.when(p < 2, F.array(ms, p, p)).otherwise(F.array(ms, p, p, p, p))
    g = t.groupBy("symbol", _grp(PAYLOAD_GROUP).alias("grp")).agg(
        F.array_sort(F.collect_list(F.struct("event_id", arr.alias("c")))).alias("cs"),
        F.max("event_time").cast("timestamp").alias("fetched_at"))
    return g.select("symbol", F.to_json(F.transform("cs", lambda x: x["c"])).alias("payload"),
                    "fetched_at")
