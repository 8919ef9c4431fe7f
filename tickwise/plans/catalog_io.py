"""Registered queries for parsing, payloads, filters and connectors.

Raw messages and payloads are derived from ``events`` by Spark itself (see
``tickwise.sources.tables``); the DuckDB twins compute the expected parse
result straight from ``events``, so each check is a JSON round trip.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tickwise import schemas as S
from tickwise.functions.columns import recent, round_cols, threshold_band
from tickwise.operators.ticks import (
    CRYPTO, STOCK, align_columns, parse_crypto, parse_messages, parse_rejects, parse_stock, select_symbols, unify_ticks,
)
from tickwise.plans import oracle as O
from tickwise.plans.catalog import FEAT_COLS, FEAT_ROUND, _clean, register
from tickwise.session import materialize, scratch_path
from tickwise.sinks.lake import compact_lake, read_lake, vacuum_lake, write_lake
from tickwise.sources import payloads as P
from tickwise.sources import tables as T


def _ntz(df, *cols):
    return df.select(*[F.col(c).cast("timestamp_ntz").alias(c) if c in cols else F.col(c)
                       for c in df.columns])


def _iso(x: str) -> str:
    return (f"(CASE WHEN microsecond({x}) % 1000000 = 0 THEN strftime({x}, '%Y-%m-%dT%H:%M:%S') "
            f"ELSE strftime({x}, '%Y-%m-%dT%H:%M:%S.%f') END || '+00:00')")


# ---------------------------------------------------------------------------
# parse / unify
# ---------------------------------------------------------------------------

_STOCK_SQL = """SELECT symbol, asset_type,
  CASE WHEN coalesce(price < 2, false) THEN event_time ELSE date_trunc('second', event_time) END
    AS event_time,
  price, price AS open, price AS high, price AS low, price AS close, volume,
  event_time AS kafka_timestamp
FROM ticks WHERE asset_type = 'stock'"""

_CRYPTO_SQL = """SELECT symbol, asset_type, event_time, price,
  CASE WHEN symbol = 'view' THEN price END AS open, CASE WHEN symbol = 'view' THEN price END AS high,
  CASE WHEN symbol = 'view' THEN price END AS low, CASE WHEN symbol = 'view' THEN price END AS close,
  CASE WHEN symbol = 'view' THEN 0.0 ELSE coalesce(volume, 0.0) END AS volume,
  event_time AS kafka_timestamp
FROM ticks WHERE asset_type = 'crypto'"""

_TS = ("event_time", "kafka_timestamp")


@register("parse_stock", f"WITH {O.TICKS}\n{_STOCK_SQL}")
def q_parse_stock(spark, sf):
    return _ntz(align_columns(parse_stock(T.raw_stock_messages(spark, sf))), *_TS)


@register("parse_crypto", f"WITH {O.TICKS}\n{_CRYPTO_SQL}")
def q_parse_crypto(spark, sf):
    return _ntz(align_columns(parse_crypto(T.raw_crypto_messages(spark, sf))), *_TS)


@register("unify_ticks", f"WITH {O.TICKS}\n{_STOCK_SQL}\nUNION ALL\n{_CRYPTO_SQL}")
def q_unify_ticks(spark, sf):
    u = unify_ticks(parse_stock(T.raw_stock_messages(spark, sf)),
                    parse_crypto(T.raw_crypto_messages(spark, sf)))
    return _ntz(u, *_TS)


_BAD = f"""WITH {O.TICKS}, messages AS (
  SELECT *, CASE WHEN symbol <> 'view' THEN volume END AS told,
    CASE asset_type WHEN 'stock' THEN 'raw_stock_ticks' ELSE 'raw_crypto_ticks' END AS topic FROM ticks),
graded AS (SELECT *, CASE CAST(told AS INT) WHEN 0 THEN 'empty' WHEN 1 THEN 'empty' WHEN 2 THEN 'malformed'
    WHEN 3 THEN 'malformed' WHEN 4 THEN 'malformed' WHEN 5 THEN 'no_symbol' WHEN 6 THEN 'no_symbol' WHEN 7 THEN 'no_time' END AS reason
  FROM messages)
"""


def _bad_messages(spark, sf):
    return {STOCK: T.with_bad_messages(T.raw_stock_messages(spark, sf)),
            CRYPTO: T.with_bad_messages(T.raw_crypto_messages(spark, sf))}


@register("parse_rejects", _BAD + """SELECT topic, symbol AS msg_key, event_id AS "offset", reason,
  CASE WHEN reason <> 'no_time' THEN event_time END AS kafka_timestamp FROM graded WHERE reason IS NOT NULL""")
def q_parse_rejects(spark, sf):
    """Messages of all kinds that give no tick, with the reason."""
    stock, crypto = (parse_rejects(raw, shape) for shape, raw in _bad_messages(spark, sf).items())
    return _ntz(stock.unionByName(crypto).select("topic", "msg_key", "offset", "reason", "kafka_timestamp"), "kafka_timestamp")


@register("parse_accounting", _BAD + """SELECT topic, count(*) AS messages, count(*) FILTER (reason IS NULL) AS ticks,
  count(*) FILTER (reason IS NOT NULL) AS rejects, true AS complete FROM graded GROUP BY topic""")
def q_parse_accounting(spark, sf):
    """Per topic: messages, ticks and rejects, each counted on its own."""
    parts = []
    for (shape, raw), topic in zip(_bad_messages(spark, sf).items(), (S.TOPIC_RAW_STOCK, S.TOPIC_RAW_CRYPTO)):
        count = F.count(F.lit(1))
        # one row each: the cross join is a broadcast of a single row
        parts.append(raw.agg(count.alias("messages")).crossJoin(parse_messages(raw, shape).agg(count.alias("ticks")))
                     .crossJoin(parse_rejects(raw, shape).agg(count.alias("rejects")))
                     .select(F.lit(topic).alias("topic"), "messages", "ticks", "rejects",
                             (F.col("messages") == F.col("ticks") + F.col("rejects")).alias("complete")))
    return parts[0].unionByName(parts[1])


@register("parse_crypto_candles_only", f"""WITH {O.TICKS}
SELECT symbol, event_time, price, 0.0 AS volume FROM ticks WHERE asset_type = 'crypto'""")
def q_parse_crypto_candles_only(spark, sf):
    """Volumes of candles alone (they have none here): spot messages count as no volume."""
    t = parse_crypto(T.raw_crypto_messages(spark, sf), volume_source="volume")
    return _ntz(t.select("symbol", "event_time", "price", "volume"), "event_time")


@register("parse_crypto_spot_only", f"""WITH {O.TICKS}
SELECT symbol, event_time, price, CASE WHEN symbol = 'view' THEN 0.0 ELSE coalesce(volume, 0.0) END AS volume
FROM ticks WHERE asset_type = 'crypto'""")
def q_parse_crypto_spot_only(spark, sf):
    t = parse_crypto(T.raw_crypto_messages(spark, sf), volume_source="volume_24h")
    return _ntz(t.select("symbol", "event_time", "price", "volume"), "event_time")


def _with_tie(sql: str) -> str:
    return sql.replace("event_time AS kafka_timestamp", "event_id").replace(
        "price AS open, price AS high, price AS low, price AS close, volume", "volume").replace(
        """CASE WHEN symbol = 'view' THEN price END AS open, CASE WHEN symbol = 'view' THEN price END AS high,
  CASE WHEN symbol = 'view' THEN price END AS low, CASE WHEN symbol = 'view' THEN price END AS close,
  """, "")


@register("parsed_window_features", (
    f"WITH {O.TICKS.replace('ticks AS', 'events_as_ticks AS')}, ticks AS ("
    + f"{_with_tie(_STOCK_SQL)} UNION ALL {_with_tie(_CRYPTO_SQL)}),\n".replace("FROM ticks", "FROM events_as_ticks")
    + f"{O.windows_cte('1 hour')}\nSELECT {FEAT_COLS} FROM feat"))
def q_parsed_window_features(spark, sf):
    """Parse -> unify -> window: the streaming job's batch body, end to end."""
    from tickwise.operators.features import window_features
    u = unify_ticks(parse_stock(T.raw_stock_messages(spark, sf)),
                    parse_crypto(T.raw_crypto_messages(spark, sf)), [*S.TICK_COLUMNS, "tie"])
    u = u.withColumn("event_time", F.col("event_time").cast("timestamp_ntz"))
    return round_cols(window_features(u, "1 hour", "tie"), FEAT_ROUND)


@register("select_symbols", (
    f"WITH {O.TICKS} SELECT * FROM ticks WHERE symbol IN ('purchase', 'view', 'click')"))
def q_select_symbols(spark, sf):
    return select_symbols(T.ticks_from_events(spark, sf), " purchase, view ,, click")


# ---------------------------------------------------------------------------
# payloads
# ---------------------------------------------------------------------------

@register("flatten_intraday", f"""WITH {O.TICKS},
p AS (SELECT *, max(event_time) OVER (PARTITION BY symbol, event_id // 4) AS fetched
      FROM ticks WHERE asset_type = 'stock')
SELECT symbol, 'stock' AS asset_type, strftime(event_time, '%Y-%m-%d %H:%M:%S.%f') AS timestamp,
  coalesce(price, 0.0) AS open, coalesce(price, 0.0) AS high, coalesce(price, 0.0) AS low,
  coalesce(price, 0.0) AS close,
  CASE WHEN price >= 5 THEN coalesce(volume, 0.0) ELSE 0.0 END AS volume,
  {_iso('fetched')} AS ingested_at
FROM p""")
def q_flatten_intraday(spark, sf):
    return P.flatten_intraday(T.intraday_payloads(spark, sf))


@register("latest_tick_per_symbol", f"""WITH {O.TICKS},
p AS (SELECT *, max(event_time) OVER (PARTITION BY symbol, event_id // 4) AS fetched
      FROM ticks WHERE asset_type = 'stock')
SELECT symbol, fetched AS fetched_at, 'stock' AS asset_type,
  strftime(event_time, '%Y-%m-%d %H:%M:%S.%f') AS timestamp,
  price AS open, price AS high, price AS low, price AS close,
  CASE WHEN price >= 5 THEN volume ELSE 0.0 END AS volume, {_iso('fetched')} AS ingested_at
FROM p QUALIFY row_number() OVER (PARTITION BY symbol, event_id // 4 ORDER BY event_time DESC) = 1""")
def q_latest_tick_per_symbol(spark, sf):
    flat = P.flatten_intraday(T.intraday_payloads(spark, sf), keep_fetch=True, response=("grp",))
    last = P.latest_tick_per_symbol(flat, keys=("symbol", "fetched_at", "grp"))
    return _ntz(last.drop("grp"), "fetched_at")


@register("classify_payload", f"""WITH {O.TICKS}
SELECT symbol, max(event_time) AS fetched_at,
  CASE WHEN min(price) < 1 THEN 'rate_limited' WHEN max(price) > 470 THEN 'error'
       WHEN count(*) = 1 THEN 'empty' ELSE 'ok' END AS status
FROM ticks WHERE asset_type = 'stock' GROUP BY symbol, event_id // 4""")
def q_classify_payload(spark, sf):
    return _ntz(P.classify_payload(T.intraday_payloads(spark, sf, with_defects=True))
                .select("symbol", "fetched_at", "status"), "fetched_at")


_DEFECTS = f"""WITH {O.TICKS},
p AS (SELECT *, max(event_time) OVER g AS fetched, CASE WHEN min(price) OVER g < 1 THEN 'rate_limited'
        WHEN max(price) OVER g > 470 THEN 'error' WHEN count(*) OVER g = 1 THEN 'empty' ELSE 'ok' END AS status
      FROM ticks WHERE asset_type = 'stock' WINDOW g AS (PARTITION BY symbol, event_id // 4))
"""


@register("flatten_intraday_defects", _DEFECTS + f"""SELECT symbol, 'stock' AS asset_type,
  strftime(event_time, '%Y-%m-%d %H:%M:%S.%f') AS timestamp, price AS open, price AS high, price AS low, price AS close,
  CASE WHEN price < 5 THEN 0.0 WHEN price < 6 THEN NULL ELSE coalesce(volume, 0.0) END AS volume,
  {_iso('fetched')} AS ingested_at FROM p WHERE status = 'ok'""")
def q_flatten_intraday_defects(spark, sf):
    """A missing field is 0, an unreadable one null."""
    return P.flatten_intraday(T.intraday_payloads(spark, sf, with_defects=True))


@register("payload_rejects", _DEFECTS + """SELECT DISTINCT symbol, fetched AS fetched_at, status,
  NULL::VARCHAR AS timestamp, NULL::VARCHAR AS field, NULL::VARCHAR AS value FROM p WHERE status <> 'ok'
UNION ALL SELECT symbol, fetched, 'unreadable', strftime(event_time, '%Y-%m-%d %H:%M:%S.%f'), '5. volume', 'n/a'
FROM p WHERE status = 'ok' AND price >= 5 AND price < 6""")
def q_payload_rejects(spark, sf):
    return _ntz(P.payload_rejects(T.intraday_payloads(spark, sf, with_defects=True)), "fetched_at")


@register("flatten_spot_prices", f"""WITH {O.TICKS}
SELECT symbol, 'crypto' AS asset_type,
  CASE WHEN price < 2 THEN {_iso('event_time')}
       ELSE strftime(date_trunc('second', event_time), '%Y-%m-%dT%H:%M:%S') || '+00:00' END AS timestamp,
  coalesce(price, 0.0) AS price, coalesce(price * 1000, 0.0) AS market_cap,
  coalesce(volume, 0.0) AS volume_24h, 0.5 AS change_24h_pct, {_iso('event_time')} AS ingested_at
FROM ticks WHERE asset_type = 'crypto' AND symbol <> 'view'""")
def q_flatten_spot_prices(spark, sf):
    return P.flatten_spot_prices(T.spot_payloads(spark, sf))


@register("flatten_ohlc", f"""WITH {O.TICKS},
p AS (SELECT *, max(event_time) OVER (PARTITION BY event_id // 4) AS fetched,
        row_number() OVER (PARTITION BY event_id // 4 ORDER BY event_id) - 1 AS pos
      FROM ticks WHERE symbol = 'view')
SELECT symbol, 'crypto' AS asset_type, {_iso("date_trunc('millisecond', event_time)")} AS timestamp,
  price AS open, price AS high, price AS low, price AS close, 0.0 AS volume,
  {_iso('fetched')} AS ingested_at, pos::INTEGER AS pos, fetched AS fetched_at
FROM p WHERE NOT coalesce(price < 2, false)""")
def q_flatten_ohlc(spark, sf):
    return _ntz(P.flatten_ohlc(T.ohlc_payloads(spark, sf)), "fetched_at")


@register("latest_candle", f"""WITH {O.TICKS},
p AS (SELECT *, max(event_time) OVER (PARTITION BY event_id // 4) AS fetched,
        row_number() OVER (PARTITION BY event_id // 4 ORDER BY event_id) - 1 AS pos
      FROM ticks WHERE symbol = 'view')
SELECT symbol, fetched AS fetched_at, {_iso("date_trunc('millisecond', event_time)")} AS timestamp,
  price AS close, pos::INTEGER AS pos
FROM p WHERE NOT coalesce(price < 2, false)
QUALIFY row_number() OVER (PARTITION BY event_id // 4 ORDER BY pos DESC) = 1""")
def q_latest_candle(spark, sf):
    c = P.flatten_ohlc(T.ohlc_payloads(spark, sf))
    last = P.latest_tick_per_symbol(c, order="pos")
    return _ntz(last.select("symbol", "fetched_at", "timestamp", "close", "pos"), "fetched_at")


# ---------------------------------------------------------------------------
# filters and bands
# ---------------------------------------------------------------------------

@register("recent", O.with_clean(
    "SELECT symbol, window_start, close_price FROM clean "
    "WHERE window_start > (SELECT max(window_start) FROM clean) - INTERVAL 1 DAY"))
def q_recent(spark, sf):
    c = _clean(spark, sf)
    a = c.select(F.max("window_start")).scalar()
    return c.filter(recent("window_start", a, "1 day")).select("symbol", "window_start",
                                                                 "close_price")


@register("anomaly_count_band", O.with_anomalies(
    "SELECT count(*) AS anomalies, CASE WHEN count(*) >= 10 THEN 'red' WHEN count(*) >= 1 "
    "THEN 'orange' ELSE 'green' END AS band, CASE WHEN count(*) >= 20 THEN 'red' "
    "WHEN count(*) >= 5 THEN 'yellow' ELSE 'green' END AS band_alt "
    "FROM anomalies WHERE symbol <> 'SYSTEM'"))
def q_anomaly_count_band(spark, sf):
    from tickwise import schemas as S
    from tickwise.plans.reports import anomaly_count
    c = anomaly_count(T.anomalies_from_events(spark, sf))
    return c.select("anomalies",
                    threshold_band("anomalies", S.ANOMALY_COUNT_BANDS,
                                   ("green", "orange", "red")).alias("band"),
                    threshold_band("anomalies", S.ANOMALY_COUNT_BANDS_ALT).alias("band_alt"))


@register("severity_label", O.with_anomalies(
    "SELECT severity, upper(severity) AS label, count(*) AS count FROM anomalies "
    "WHERE symbol <> 'SYSTEM' GROUP BY 1"))
def q_severity_label(spark, sf):
    from tickwise.functions.columns import not_system, severity_label
    a = T.anomalies_from_events(spark, sf).filter(not_system())
    return a.groupBy("severity").agg(F.count(F.lit(1)).alias("count")).select(
        "severity", severity_label("severity").alias("label"), "count")


@register("threshold_band", O.with_clean(
    "SELECT symbol, window_start, CASE WHEN price_return_pct IS NULL THEN NULL "
    "WHEN price_return_pct >= 5 THEN 'red' WHEN price_return_pct >= 2 THEN 'yellow' "
    "ELSE 'green' END AS return_band FROM clean"))
def q_threshold_band(spark, sf):
    c = _clean(spark, sf)
    from tickwise import schemas as S
    return c.select("symbol", "window_start",
                    threshold_band("price_return_pct", S.RETURN_PCT_BANDS).alias("return_band"))


# ---------------------------------------------------------------------------
# lake connector: write partitioned, read back with partition pruning
# ---------------------------------------------------------------------------

@register("read_lake", O.with_clean(
    "SELECT symbol, asset_type, window_start, close_price, volume FROM clean "
    "WHERE asset_type = 'stock' AND window_start BETWEEN TIMESTAMP '2024-01-10 00:00:00' "
    "AND TIMESTAMP '2024-01-20 00:00:00'"))
def q_read_lake(spark, sf):
    path = scratch_path(spark, f"lake-{uuid.uuid4().hex}")
    write_lake(T.windows_from_events(spark, sf), path, batch_id=0)
    lake = read_lake(spark, path, "2024-01-10 00:00:00", "2024-01-20 00:00:00",
                     asset_type="stock")
    return _ntz(lake.select("symbol", "asset_type", "window_start", "close_price",
                            F.col("total_volume").alias("volume")), "window_start")


def _lake_in_batches(spark, sf):
    """A lake as a stream leaves it: windows of five days a batch, one file for each day and type."""
    path = scratch_path(spark, f"lake-{uuid.uuid4().hex}")
    windows = materialize(T.windows_from_events(spark, sf), "lake-windows")
    for k in range(6):
        lo, hi = (F.expr(f"TIMESTAMP_NTZ'2024-01-01 00:00:00' + INTERVAL {5 * d} DAYS") for d in (k, k + 1))
        part = windows.filter(((F.col("window_start") >= lo) | F.lit(k == 0)) & ((F.col("window_start") < hi) | F.lit(k == 5)))
        write_lake(part, path, batch_id=k, by_symbol=False)
    return path


@register("read_lake_compacted", O.with_clean(
    "SELECT symbol, asset_type, window_start, close_price, volume, CAST(window_start AS DATE) AS date FROM clean"))
def q_read_lake_compacted(spark, sf):
    """A lake whose days before the 20th are compacted, the covered folders removed and the
    first batch written once more: the same rows as the windows."""
    path = _lake_in_batches(spark, sf)
    compact_lake(spark, path, "2024-01-20")
    vacuum_lake(spark, path)
    first = T.windows_from_events(spark, sf).filter("window_start < TIMESTAMP_NTZ'2024-01-06 00:00:00'")
    write_lake(first, path, batch_id=0, by_symbol=False)
    return _ntz(read_lake(spark, path).select("symbol", "asset_type", "window_start", "close_price",
                                              F.col("total_volume").alias("volume"), "date"), "window_start")


@register("lake_inventory_counts", O.with_clean(
    "SELECT count(DISTINCT (CAST(window_start AS DATE), asset_type)) AS files, "
    "count(DISTINCT (CAST(window_start AS DATE), asset_type)) AS partitions, 'SUCCESS' AS status FROM clean"))
def q_lake_inventory_counts(spark, sf):
    """Files and partition folders of a lake with one writer for each day and type."""
    from tickwise.plans.quality import lake_inventory
    return lake_inventory(spark, _lake_in_batches(spark, sf)).select("files", "partitions", "status")


_NEWEST = O.with_clean(
    "SELECT strftime(CAST(window_start AS DATE), '%Y-%m-%d') AS day, asset_type, 1::BIGINT AS files FROM clean "
    "WHERE window_start >= TIMESTAMP '2024-01-26 00:00:00' GROUP BY 1, 2")


def _day_and_type(col):
    return (F.regexp_extract(col, "date=([0-9-]+)", 1).alias("day"), F.regexp_extract(col, "asset_type=([a-z]+)", 1).alias("asset_type"))


@register("newest_partitions", _NEWEST)
def q_newest_partitions(spark, sf):
    """The partition folders of the last batch, which are the newest ones; as many as it wrote."""
    from tickwise.plans.quality import lake_files, newest_partitions
    path = _lake_in_batches(spark, sf)
    last = lake_files(spark, path).filter(F.col("path").contains("/batch_id=5/")).count()
    return newest_partitions(spark, path, last).select(*_day_and_type("partition"), "files")


@register("newest_files", _NEWEST.replace("1::BIGINT AS files", "count(*) > 0 AS has_rows"))
def q_newest_files(spark, sf):
    """The files of the last batch, which are the newest ones."""
    from tickwise.plans.quality import lake_files, newest_files
    path = _lake_in_batches(spark, sf)
    last = lake_files(spark, path).filter(F.col("path").contains("/batch_id=5/")).count()
    return newest_files(spark, path, last).select(*_day_and_type("path"), (F.col("length") > 0).alias("has_rows"))


@register("lake_partitions", O.with_clean(
    "SELECT CAST(window_start AS DATE) AS date, asset_type, count(*) AS row_count FROM clean GROUP BY 1, 2"))
def q_lake_partitions(spark, sf):
    from tickwise.plans.quality import lake_partitions
    path = scratch_path(spark, f"lake-{uuid.uuid4().hex}")
    write_lake(T.windows_from_events(spark, sf), path, batch_id=0)
    return lake_partitions(read_lake(spark, path))


@register("lake_inventory", None)
def q_lake_inventory(spark, sf):
    """Write the feature windows as a lake, then inventory its files (rows-only:
    sizes and modification times depend on the write)."""
    from tickwise.plans.quality import lake_inventory
    path = scratch_path(spark, f"lake-{uuid.uuid4().hex}")
    write_lake(T.windows_from_events(spark, sf), path, batch_id=0)
    return lake_inventory(spark, path)


@register("to_kafka_records", O.with_anomalies(
    "SELECT symbol AS key, json_object('symbol', symbol, 'asset_type', asset_type, "
    "'anomaly_type', anomaly_type, 'severity', severity)::VARCHAR AS value FROM anomalies"))
def q_to_kafka_records(spark, sf):
    """Kafka record projection (key = symbol, value = JSON); text-typed fields so the
    JSON text is engine-neutral."""
    from tickwise.sinks.kafka import to_kafka_records
    a = T.anomalies_from_events(spark, sf)
    return to_kafka_records(a.select("symbol", "asset_type", "anomaly_type", "severity"))
