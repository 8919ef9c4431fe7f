"""Stream = batch: replay events as message files through the streaming job."""

import os
import time

import pytest

from pyspark.sql import functions as F

from conftest import SF_SMALL
from tickwise.operators.anomalies import detect_anomalies
from tickwise.operators.features import window_features
from tickwise.operators.ticks import parse_crypto, parse_stock, unify_ticks
from tickwise.sources import tables as T
from tickwise.sources.messages import read_message_files
from tickwise.streaming.pipeline import run_pipeline

WIDTH = "1 hour"


def _land(spark, df, path, n_files, start="2024-01-01", days=30):
    # one file per time slice, written one after another so that the file
    # source (oldest modification time first) replays them in time order
    step = days / n_files
    for k in range(n_files):
        lo = F.lit(start).cast("timestamp") + F.expr(f"INTERVAL {int(k * step * 24)} HOURS")
        hi = F.lit(start).cast("timestamp") + F.expr(f"INTERVAL {int((k + 1) * step * 24)} HOURS")
        cond = (F.col("kafka_timestamp") >= lo) & (
            (F.col("kafka_timestamp") < hi) if k < n_files - 1 else F.lit(True))
        df.filter(cond).coalesce(1).write.mode("append").parquet(path)
        time.sleep(1.1)


def _key(rows, cols):
    return sorted(tuple(round(r[c], 6) if isinstance(r[c], float) else r[c] for c in cols)
                  for r in rows)


@pytest.mark.parametrize("lookback, independent", [(None, True), (20, True), (20, False)])
def test_stream_equals_batch(spark, tmp, lookback, independent):
    stock, crypto = T.raw_stock_messages(spark, SF_SMALL), T.raw_crypto_messages(spark, SF_SMALL)
    _land(spark, stock, f"{tmp}/in/stock", 6)
    _land(spark, crypto, f"{tmp}/in/crypto", 6)
    s_raw = read_message_files(spark, f"{tmp}/in/stock", max_files_per_trigger=1)
    c_raw = read_message_files(spark, f"{tmp}/in/crypto", max_files_per_trigger=1)
    q = run_pipeline(s_raw, c_raw, f"{tmp}/lake", f"{tmp}/anoms", f"{tmp}/state",
                     f"{tmp}/ckpt", trigger={"availableNow": True}, width=WIDTH,
                     delay="2 days", lookback=lookback, independent=independent)
    q.awaitTermination(300)
    assert q.exception() is None
    lake = spark.read.parquet(f"{tmp}/lake")
    got_w = lake.collect()

    ticks = unify_ticks(parse_stock(stock), parse_crypto(crypto))
    batch_w = window_features(ticks, WIDTH)
    emitted = lake.select("symbol", "asset_type", "window_start")
    exp_w = batch_w.join(emitted, ["symbol", "asset_type", "window_start"], "left_semi")
    cols = ["symbol", "asset_type", "window_start", "open_price", "close_price", "high_price",
            "low_price", "total_volume", "record_count", "rolling_volatility"]
    assert len(got_w) > 0
    assert lake.count() == lake.select("symbol", "asset_type", "window_start").distinct().count()
    assert _key(got_w, cols) == _key(exp_w.collect(), cols)
    # windows within the watermark delay of the newest tick stay open; all
    # others are emitted once, final
    # (each source for itself; in one query the source that is behind decides)
    newest = ticks.groupBy("asset_type").agg(F.max("event_time").alias("newest"))
    if not independent:
        newest = newest.withColumn("newest", F.lit(min(r["newest"] for r in newest.collect())))
    open_w = batch_w.join(newest, "asset_type").filter(F.col("window_end") > F.col("newest") - F.expr("INTERVAL 2 DAYS"))
    assert batch_w.count() - len(got_w) == open_w.count()

    got_a = spark.read.parquet(f"{tmp}/anoms").collect()
    exp_a = detect_anomalies(batch_w, lookback=lookback).join(emitted, ["symbol", "asset_type", "window_start"],
                                           "left_semi").collect()
    acols = ["symbol", "asset_type", "anomaly_type", "window_start", "current_value",
             "mean_value", "std_value", "z_score", "severity"]
    assert len(exp_a) > 0
    assert _key(got_a, acols) == _key(exp_a, acols)
    # more than one micro-batch ran, so history was carried between batches
    assert len({r["batch_id"] for r in got_a}) > 1
    for folder in ("stock", "crypto") if independent else (".",):
        assert any(d.startswith("v=") for d in os.listdir(f"{tmp}/state/{folder}"))


def test_replayed_batch_is_idempotent(spark, tmp):
    from tickwise.streaming.pipeline import make_batch_scorer
    w = window_features(T.ticks_from_events(spark, SF_SMALL), WIDTH, "event_id")
    w = w.withColumn("window_start", F.col("window_start").cast("timestamp")) \
         .withColumn("window_end", F.col("window_end").cast("timestamp"))
    fn = make_batch_scorer(spark, f"{tmp}/lake", f"{tmp}/anoms", f"{tmp}/state")
    fn(w, 0)
    n1 = spark.read.parquet(f"{tmp}/lake").count()
    a1 = spark.read.parquet(f"{tmp}/anoms").count()
    fn(w, 0)  # replay of the same batch id
    assert spark.read.parquet(f"{tmp}/lake").count() == n1 == w.count()
    assert spark.read.parquet(f"{tmp}/anoms").count() == a1


def test_late_rows_dropped_by_watermark(spark, tmp):
    """Late rows are filtered with the previous batch's watermark (Spark >= 3.4),
    so the late row arrives one batch after its window was evicted."""
    from tickwise.streaming.pipeline import stream_features
    schema = "symbol string, asset_type string, event_time timestamp, price double, volume double"
    rows = [("A", "stock", "2024-01-01 10:00:00", 1.0, 1.0),
            ("A", "stock", "2024-01-01 12:00:00", 2.0, 1.0),   # watermark -> 11:30
            ("A", "stock", "2024-01-01 12:05:00", 2.5, 1.0),   # 10:00 window evicted here
            ("A", "stock", "2024-01-01 10:30:00", 9.0, 1.0),   # late: dropped
            ("A", "stock", "2024-01-01 14:00:00", 3.0, 1.0)]
    for i, r in enumerate(rows):
        spark.createDataFrame([r], "symbol string, asset_type string, event_time string, "
                              "price double, volume double") \
            .withColumn("event_time", F.to_timestamp("event_time")).coalesce(1) \
            .write.mode("append").parquet(f"{tmp}/in/p{i}")
        time.sleep(1.1)   # the file source replays by modification time
    src = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp}/in/*")
    q = (stream_features(src, "1 hour", "30 minutes").writeStream.format("memory")
         .queryName("late_test").outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination(120)
    dropped = sum(op.get("numRowsDroppedByWatermark", 0)
                  for p in q.recentProgress for op in p.get("stateOperators", []))
    out = {str(r["window_start"]): r for r in spark.sql("SELECT * FROM late_test").collect()}
    assert dropped == 1
    # 14:00 is still open; the others are final and emitted once
    assert sorted(out) == ["2024-01-01 10:00:00", "2024-01-01 12:00:00"]
    assert out["2024-01-01 10:00:00"]["record_count"] == 1
    assert out["2024-01-01 10:00:00"]["high_price"] == 1.0
    assert out["2024-01-01 12:00:00"]["record_count"] == 2


def test_backfill_in_two_batches_equals_one_run(spark, tmp):
    """Two time-ordered backfill batches carry history like one batch run."""
    from tickwise.streaming.pipeline import backfill
    t = T.ticks_from_events(spark, SF_SMALL).withColumn(
        "event_time", F.col("event_time").cast("timestamp"))
    cut = F.lit("2024-01-15 00:00:00").cast("timestamp")
    backfill(t.filter(F.col("event_time") < cut), f"{tmp}/lake", f"{tmp}/anoms",
             f"{tmp}/state", 0, WIDTH, "event_id")
    backfill(t.filter(F.col("event_time") >= cut), f"{tmp}/lake", f"{tmp}/anoms",
             f"{tmp}/state", 1, WIDTH, "event_id")
    got = spark.read.parquet(f"{tmp}/anoms").collect()
    exp = detect_anomalies(window_features(t, WIDTH, "event_id")).collect()
    cols = ["symbol", "anomaly_type", "window_start", "z_score", "mean_value", "std_value"]
    assert _key(got, cols) == _key(exp, cols)
    assert spark.read.parquet(f"{tmp}/lake").count() == window_features(t, WIDTH).count()


def test_restart_from_checkpoint_equals_batch(spark, tmp):
    """Stop after the first half of the files, land the rest, restart from the
    same checkpoint and state: the output equals one batch run."""
    stock, crypto = T.raw_stock_messages(spark, SF_SMALL), T.raw_crypto_messages(spark, SF_SMALL)
    halves = [(F.col("kafka_timestamp") < F.lit("2024-01-15").cast("timestamp")),
              (F.col("kafka_timestamp") >= F.lit("2024-01-15").cast("timestamp"))]
    for i, cond in enumerate(halves):
        _land(spark, stock.filter(cond), f"{tmp}/in/stock", 2, "2024-01-01" if i == 0 else
              "2024-01-15", 14 if i == 0 else 16)
        _land(spark, crypto.filter(cond), f"{tmp}/in/crypto", 2, "2024-01-01" if i == 0 else
              "2024-01-15", 14 if i == 0 else 16)
        q = run_pipeline(read_message_files(spark, f"{tmp}/in/stock", max_files_per_trigger=1),
                         read_message_files(spark, f"{tmp}/in/crypto", max_files_per_trigger=1),
                         f"{tmp}/lake", f"{tmp}/anoms", f"{tmp}/state", f"{tmp}/ckpt",
                         trigger={"availableNow": True}, width=WIDTH, delay="2 days")
        q.awaitTermination(300)
        assert q.exception() is None
    lake = spark.read.parquet(f"{tmp}/lake")
    emitted = lake.select("symbol", "asset_type", "window_start")
    assert lake.count() == emitted.distinct().count()          # each window once
    ticks = unify_ticks(parse_stock(stock), parse_crypto(crypto))
    batch_w = window_features(ticks, WIDTH)
    exp_a = detect_anomalies(batch_w).join(emitted, ["symbol", "asset_type", "window_start"],
                                           "left_semi").collect()
    got_a = spark.read.parquet(f"{tmp}/anoms").collect()
    acols = ["symbol", "asset_type", "anomaly_type", "window_start", "z_score", "severity"]
    assert len(got_a) > 0 and _key(got_a, acols) == _key(exp_a, acols)
    # windows of both halves were emitted, so the restart continued the state
    assert lake.filter(F.col("window_start") < F.lit("2024-01-10").cast("timestamp")).count() > 0
    assert lake.filter(F.col("window_start") > F.lit("2024-01-20").cast("timestamp")).count() > 0


def test_failed_batch_is_replayed_without_duplicates(spark, tmp):
    """A sink error fails the query (not swallowed); the restart replays the
    batch, and its lake, anomaly and state outputs are replaced, not doubled."""
    stock, crypto = T.raw_stock_messages(spark, SF_SMALL), T.raw_crypto_messages(spark, SF_SMALL)
    _land(spark, stock, f"{tmp}/in/stock", 3)
    _land(spark, crypto, f"{tmp}/in/crypto", 3)
    flag = f"{tmp}/failed_once"

    def flaky(batch, anomalies, batch_id):
        if batch_id == 1 and not os.path.exists(flag):
            open(flag, "w").close()
            raise RuntimeError("sink down")

    def run(sinks):
        q = run_pipeline(read_message_files(spark, f"{tmp}/in/stock", max_files_per_trigger=1),
                         read_message_files(spark, f"{tmp}/in/crypto", max_files_per_trigger=1),
                         f"{tmp}/lake", f"{tmp}/anoms", f"{tmp}/state", f"{tmp}/ckpt",
                         trigger={"availableNow": True}, width=WIDTH, delay="2 days",
                         extra_sinks=sinks)
        try:
            q.awaitTermination(300)
        except Exception:
            pass
        return q

    first = run([flaky])
    assert first.exception() is not None and os.path.exists(flag)
    second = run([flaky])
    assert second.exception() is None
    lake = spark.read.parquet(f"{tmp}/lake")
    emitted = lake.select("symbol", "asset_type", "window_start")
    assert lake.count() == emitted.distinct().count()
    got = spark.read.parquet(f"{tmp}/anoms")
    assert got.count() == got.select("symbol", "anomaly_type", "window_start").distinct().count()
    ticks = unify_ticks(parse_stock(stock), parse_crypto(crypto))
    exp = detect_anomalies(window_features(ticks, WIDTH)).join(
        emitted, ["symbol", "asset_type", "window_start"], "left_semi").collect()
    cols = ["symbol", "anomaly_type", "window_start", "z_score"]
    assert _key(got.collect(), cols) == _key(exp, cols)


def test_per_batch_mode_matches_reference_semantics(spark, tmp):
    """per_batch=True: every micro-batch windowed and scored on its own, and
    the JDBC sink receives the same rows (in-process Derby, no port)."""
    from tickwise.streaming.pipeline import jdbc_sink
    stock, crypto = T.raw_stock_messages(spark, SF_SMALL), T.raw_crypto_messages(spark, SF_SMALL)
    _land(spark, stock, f"{tmp}/in/stock", 2)
    _land(spark, crypto, f"{tmp}/in/crypto", 2)
    url = "jdbc:derby:memory:tickwise_stream;create=true"
    props = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    q = run_pipeline(read_message_files(spark, f"{tmp}/in/stock", max_files_per_trigger=1),
                     read_message_files(spark, f"{tmp}/in/crypto", max_files_per_trigger=1),
                     f"{tmp}/lake", f"{tmp}/anoms", checkpoint=f"{tmp}/ckpt",
                     trigger={"availableNow": True}, width=WIDTH, per_batch=True,
                     extra_sinks=[jdbc_sink(url, props, "CLEAN", "ANOMS")])
    q.awaitTermination(300)
    assert q.exception() is None
    lake = spark.read.parquet(f"{tmp}/lake")
    got = spark.read.parquet(f"{tmp}/anoms")
    exp = []
    for b in sorted(r[0] for r in lake.select("batch_id").distinct().collect()):
        w = lake.filter(F.col("batch_id") == b).drop("date", "run_id", "batch_id")
        exp += detect_anomalies(w, min_rows=2).collect()
    cols = ["symbol", "anomaly_type", "window_start", "z_score"]
    assert len(exp) > 0 and _key(got.collect(), cols) == _key(exp, cols)
    from tickwise.sinks.jdbc import read_table_jdbc
    assert read_table_jdbc(spark, url, "CLEAN", props).count() == lake.count()
    assert read_table_jdbc(spark, url, "ANOMS", props).count() == got.count()


def _ticks(spark, rows):
    return spark.createDataFrame(rows, "symbol string, asset_type string, event_time string, price double, "
                                 "volume double").withColumn("event_time", F.to_timestamp("event_time"))


def test_versions_are_pruned_by_count_not_by_distance(spark, tmp):
    """Non-empty batches far apart, and a replay of the last: the version that
    the replay needs is still there, and the result equals one batch run."""
    from tickwise.streaming.pipeline import VersionedTable, backfill
    table = VersionedTable(spark, f"{tmp}/v", retain=2)
    for b in (0, 12, 40, 41):
        table.write(spark.range(b + 1), b)
    assert table.versions() == [(0, 12), (0, 40), (0, 41)]
    assert table.read(41).count() == 41 and table.read(12) is None
    t = T.ticks_from_events(spark, SF_SMALL).withColumn("event_time", F.col("event_time").cast("timestamp"))
    cuts = ["2024-01-01", "2024-01-10", "2024-01-20", "2024-02-01"]
    for b, lo, hi in [(0, *cuts[:2]), (12, *cuts[1:3]), (24, *cuts[2:]), (24, *cuts[2:])]:
        part = t.filter((F.col("event_time") >= F.lit(lo).cast("timestamp"))
                        & (F.col("event_time") < F.lit(hi).cast("timestamp")))
        backfill(part, f"{tmp}/lake", f"{tmp}/anoms", f"{tmp}/state", b, WIDTH, "event_id")
    cols = ["symbol", "anomaly_type", "window_start", "z_score", "mean_value", "std_value"]
    exp = detect_anomalies(window_features(t, WIDTH, "event_id")).collect()
    assert _key(spark.read.parquet(f"{tmp}/anoms").collect(), cols) == _key(exp, cols)


def test_new_checkpoint_keeps_earlier_output_and_history(spark, tmp):
    """Backfill, then two streams with checkpoints of their own on the same paths."""
    from tickwise.streaming.pipeline import backfill, stream_anomalies, stream_features
    schema = "symbol string, asset_type string, event_time timestamp, price double, volume double"

    def hours(day):
        return _ticks(spark, [("A", "stock", f"2024-01-{day:02d} {h:02d}:00:00", 10.0 + h % 3 + day, 1.0 + h)
                              for h in range(12)])
    backfill(hours(1), f"{tmp}/lake", f"{tmp}/anoms", f"{tmp}/state", 0, WIDTH)
    for day in (2, 3):
        hours(day).coalesce(1).write.parquet(f"{tmp}/in{day}")
        src = spark.readStream.schema(schema).parquet(f"{tmp}/in{day}")
        q = stream_anomalies(stream_features(src, WIDTH, "1 second"), f"{tmp}/lake", f"{tmp}/anoms", f"{tmp}/state",
                             f"{tmp}/ckpt{day}", {"availableNow": True}, width=WIDTH)
        q.awaitTermination(120)
        assert q.exception() is None
    lake = spark.read.parquet(f"{tmp}/lake")
    assert lake.count() == 12 + 10 + 10     # the last two windows of each stream stay open
    assert sorted(r[0] for r in lake.select("run_id").distinct().collect()) == [0, 1, 2]
    from tickwise.streaming.pipeline import VersionedTable
    last = VersionedTable(spark, f"{tmp}/state").read(10**6, 2)
    assert last.first()["total_volume_n"] == lake.count()


@pytest.mark.parametrize("independent", [False, True])
def test_lagging_source_loses_nothing(spark, tmp, independent):
    """Stock five hours behind crypto, both within the default delay of themselves."""
    import datetime as dt
    import json
    start = dt.datetime(2024, 1, 1, 12)
    for k in range(5):
        times = [start + dt.timedelta(minutes=30 * k + m) for m in range(30)]
        stock = [("A", json.dumps({"symbol": "A", "asset_type": "stock", "close": 1.0 + m, "volume": 1.0, "timestamp":
                                   (t - dt.timedelta(hours=5)).strftime("%Y-%m-%d %H:%M:%S")}), "raw_stock_ticks",
                  t - dt.timedelta(hours=5)) for m, t in enumerate(times)]
        crypto = [("B", json.dumps({"symbol": "B", "asset_type": "crypto", "price": 1.0 + m, "volume_24h": 1.0,
                                    "timestamp": t.isoformat() + "+00:00"}), "raw_crypto_ticks", t)
                  for m, t in enumerate(times)]
        for name, rows in (("stock", stock), ("crypto", crypto)):
            spark.createDataFrame(rows, "msg_key string, json_value string, topic string, kafka_timestamp timestamp") \
                .coalesce(1).write.mode("append").parquet(f"{tmp}/in/{name}")
        time.sleep(1.1)
    q = run_pipeline(read_message_files(spark, f"{tmp}/in/stock", max_files_per_trigger=1),
                     read_message_files(spark, f"{tmp}/in/crypto", max_files_per_trigger=1),
                     f"{tmp}/lake", f"{tmp}/anoms", f"{tmp}/state", f"{tmp}/ckpt", trigger={"availableNow": True},
                     independent=independent)
    q.awaitTermination(300)
    assert q.exception() is None
    lake = spark.read.parquet(f"{tmp}/lake")
    counts = {r["asset_type"]: r["n"] for r in lake.groupBy("asset_type").agg(F.sum("record_count").alias("n")).collect()}
    # the slowest source's time decides: its last 10 minutes and open window stay
    # open, and everything that is emitted is complete
    newest_stock = start + dt.timedelta(minutes=149) - dt.timedelta(hours=5)
    assert counts["stock"] == 5 * 30 - 15
    if independent:      # crypto does not wait for stock
        assert counts["crypto"] == 5 * 30 - 15
        newest = {r[0]: r[1] for r in lake.groupBy("asset_type").agg(F.max("window_end")).collect()}
        assert newest["crypto"] - newest["stock"] == dt.timedelta(hours=5)
    else:
        assert lake.filter("asset_type = 'crypto'").count() == 0
        assert lake.agg(F.max("window_end")).first()[0] <= newest_stock - dt.timedelta(minutes=10)
    dropped = sum(op.get("numRowsDroppedByWatermark", 0) for p in q.recentProgress for op in p.get("stateOperators", []))
    assert dropped == 0


def _stock_message(symbol, when, close, broker=None):
    import json
    return (symbol, json.dumps({"symbol": symbol, "asset_type": "stock", "close": close, "volume": 1.0,
                                "timestamp": when.strftime("%Y-%m-%d %H:%M:%S")}), "raw_stock_ticks", broker or when)


def _crypto_message(symbol, when, price, volume=1.0):
    import json
    return (symbol, json.dumps({"symbol": symbol, "asset_type": "crypto", "price": price, "volume_24h": volume,
                                "timestamp": when.isoformat() + "+00:00"}), "raw_crypto_ticks", when)


def _land_rows(spark, rows, path, first_offset=0):
    schema = "msg_key string, json_value string, topic string, kafka_timestamp timestamp, partition int, offset bigint"
    rows = [(*r, 0, first_offset + i) for i, r in enumerate(rows)]
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
    time.sleep(1.1)     # the file source replays by modification time


def test_silent_source_holds_up_only_itself(spark, tmp):
    """The stock exchange is closed and one bar is polled again and again, while crypto
    goes on for a day: crypto windows are final and scored."""
    import datetime as dt
    start = dt.datetime(2024, 1, 6)
    for k in range(3):
        times = [start + dt.timedelta(minutes=10 * (48 * k + m)) for m in range(48)]
        _land_rows(spark, [_stock_message("A", start, 10.0, t) for t in times], f"{tmp}/in/stock", 48 * k)
        _land_rows(spark, [_crypto_message("B", t, 100.0, 1000.0 if (k, m) == (1, 20) else 1.0 + m % 3)
                           for m, t in enumerate(times)], f"{tmp}/in/crypto", 48 * k)
    for _ in range(2):      # the second run finds nothing new
        q = run_pipeline(read_message_files(spark, f"{tmp}/in/stock", max_files_per_trigger=1),
                         read_message_files(spark, f"{tmp}/in/crypto", max_files_per_trigger=1),
                         f"{tmp}/lake", f"{tmp}/anoms", f"{tmp}/state", f"{tmp}/ckpt", trigger={"availableNow": True})
        q.awaitTermination(300)
        assert q.exception() is None
    lake = spark.read.parquet(f"{tmp}/lake")
    assert [r["asset_type"] for r in lake.select("asset_type").distinct().collect()] == ["crypto"]
    assert lake.agg(F.sum("record_count")).first()[0] == 144 - 2      # the last 10 minutes stay open
    assert lake.groupBy("symbol", "window_start").count().filter("count > 1").count() == 0
    flagged = spark.read.parquet(f"{tmp}/anoms").collect()
    assert [(r["symbol"], r["anomaly_type"], r["current_value"]) for r in flagged] == [("B", "volume_surge", 1000.0)]


@pytest.mark.parametrize("independent", [True, False])
def test_late_ticks_and_rejects_are_kept(spark, tmp, independent):
    """Windows, late ticks and rejects add up to the messages; open and close of tied
    times follow the offsets."""
    import datetime as dt
    day = dt.datetime(2024, 1, 1, 10)

    def at(minutes):
        return day + dt.timedelta(minutes=minutes)
    steps = [
        [_stock_message("A", at(0), 1.0), _stock_message("A", at(0), 2.0), _stock_message("A", at(0), 3.0)],
        [_stock_message("A", at(120), 5.0), ("A", "{broken", "raw_stock_ticks", at(1)), ("A", None, "raw_stock_ticks", at(1))],
        [_stock_message("A", at(125), 6.0)],
        [_stock_message("A", at(5), 9.0), _stock_message("A", at(6), 9.0), _stock_message("C", at(7), 9.0),
         _stock_message("A", at(126), 7.0), ("A", '{"close": 1.0}', "raw_stock_ticks", at(1))],
        [_stock_message("A", at(600), 8.0)],
        [_stock_message("A", at(601), 8.0), _stock_message("A", at(130), 8.0)]]
    n = 0
    for k, rows in enumerate(steps):
        _land_rows(spark, rows, f"{tmp}/in/stock", n)
        _land_rows(spark, [_crypto_message("B", at(0) if k == 0 else at(5000), 1.0)], f"{tmp}/in/crypto", k)
        n += len(rows)

    def run():
        q = run_pipeline(read_message_files(spark, f"{tmp}/in/stock", max_files_per_trigger=1),
                         read_message_files(spark, f"{tmp}/in/crypto", max_files_per_trigger=1),
                         f"{tmp}/lake", f"{tmp}/anoms", f"{tmp}/state", f"{tmp}/ckpt", trigger={"availableNow": True},
                         width=WIDTH, delay="30 minutes", independent=independent, side_path=f"{tmp}/side")
        q.awaitTermination(300)
        assert q.exception() is None
    run()
    side = spark.read.parquet(f"{tmp}/side").filter("topic = 'raw_stock_ticks'")
    counts = {r["reason"]: r["n"] for r in side.groupBy("reason").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert counts == {"late": 3, "malformed": 1, "empty": 1, "no_symbol": 1}
    lake = spark.read.parquet(f"{tmp}/lake").filter("asset_type = 'stock'")
    still_open = 2
    assert lake.agg(F.sum("record_count")).first()[0] + side.count() + still_open == n
    first = lake.filter(F.hour("window_start") == 10).first()
    assert (first["open_price"], first["close_price"], first["record_count"]) == (1.0, 3.0, 3)
    second = lake.filter(F.hour("window_start") == 12).first()
    # the tick of 12:10 comes with the batch that closes its window, and still counts
    assert (second["open_price"], second["close_price"], second["record_count"]) == (5.0, 8.0, 4)
    assert side.filter("reason = 'late'").filter(F.col("json_value").contains("9.0")).count() == 3


def test_rejects_of_the_per_batch_mode(spark, tmp):
    import datetime as dt
    t = dt.datetime(2024, 1, 1, 10)
    _land_rows(spark, [_stock_message("A", t, 1.0), ("A", "{", "raw_stock_ticks", t)], f"{tmp}/in/stock")
    _land_rows(spark, [_crypto_message("B", t, 1.0), ("B", "{}", "raw_crypto_ticks", t)], f"{tmp}/in/crypto")
    q = run_pipeline(read_message_files(spark, f"{tmp}/in/stock"), read_message_files(spark, f"{tmp}/in/crypto"),
                     f"{tmp}/lake", f"{tmp}/anoms", f"{tmp}/state", f"{tmp}/ckpt", trigger={"availableNow": True},
                     width=WIDTH, per_batch=True, side_path=f"{tmp}/side")
    q.awaitTermination(300)
    assert q.exception() is None
    assert sorted((r["topic"], r["reason"]) for r in spark.read.parquet(f"{tmp}/side").collect()) == [
        ("raw_crypto_ticks", "no_symbol"), ("raw_stock_ticks", "malformed")]
    assert spark.read.parquet(f"{tmp}/lake").agg(F.sum("record_count")).first()[0] == 2


def test_missing_history_fails_the_batch(spark, tmp):
    """A version that the manifest names and that is gone, or not whole, is an error."""
    import shutil
    from tickwise.streaming.pipeline import MissingHistory, VersionedTable, backfill, make_batch_scorer
    t = T.ticks_from_events(spark, SF_SMALL).withColumn("event_time", F.col("event_time").cast("timestamp"))
    day = F.lit("2024-01-15").cast("timestamp")
    backfill(t.filter(F.col("event_time") < day), f"{tmp}/lake", f"{tmp}/anoms", f"{tmp}/state", 0, WIDTH, "event_id")
    table = VersionedTable(spark, f"{tmp}/state")
    assert table.marks() == table.versions() == [(0, 0)]
    shutil.move(f"{tmp}/state/v=0-0", f"{tmp}/away")
    later = window_features(t.filter(F.col("event_time") >= day), WIDTH, "event_id")
    fn = make_batch_scorer(spark, f"{tmp}/lake", f"{tmp}/anoms", f"{tmp}/state")
    with pytest.raises(MissingHistory):
        fn(later, 1)
    assert table.versions() == []            # nothing was written over the gap
    shutil.move(f"{tmp}/away", f"{tmp}/state/v=0-0")
    os.rename(f"{tmp}/state/v=0-0/_SUCCESS", f"{tmp}/state/v=0-0/_gone")
    with pytest.raises(MissingHistory):
        fn(later, 1)
    os.rename(f"{tmp}/state/v=0-0/_gone", f"{tmp}/state/v=0-0/_SUCCESS")
    fn(later, 1)
    cols = ["symbol", "anomaly_type", "window_start", "z_score", "mean_value", "std_value"]
    exp = detect_anomalies(window_features(t, WIDTH, "event_id")).collect()
    assert _key(spark.read.parquet(f"{tmp}/anoms").collect(), cols) == _key(exp, cols)


def test_failed_history_fails_the_query(spark, tmp):
    """The same in a running stream: the query ends with the error and writes no state."""
    import shutil
    from tickwise.streaming.pipeline import stream_anomalies, stream_features
    schema = "symbol string, asset_type string, event_time timestamp, price double, volume double"

    def day(d):
        return _ticks(spark, [("A", "stock", f"2024-01-{d:02d} {h:02d}:00:00", 10.0 + h % 3, 1.0 + h) for h in range(12)])

    def run():
        src = spark.readStream.schema(schema).parquet(f"{tmp}/in")
        q = stream_anomalies(stream_features(src, WIDTH, "1 second"), f"{tmp}/lake", f"{tmp}/anoms", f"{tmp}/state",
                             f"{tmp}/ckpt", {"availableNow": True}, width=WIDTH)
        try:
            q.awaitTermination(120)
        except Exception:
            pass
        return q
    day(1).coalesce(1).write.parquet(f"{tmp}/in")
    assert run().exception() is None
    for name in [d for d in os.listdir(f"{tmp}/state") if d.startswith("v=")]:
        shutil.rmtree(f"{tmp}/state/{name}")
    day(2).coalesce(1).write.mode("append").parquet(f"{tmp}/in")
    assert "MissingHistory" in str(run().exception())
    assert not [d for d in os.listdir(f"{tmp}/state") if d.startswith("v=")]
