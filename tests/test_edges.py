"""Hand-made edge rows (FIXTURES.md section 4), compat semantics unless noted."""

import datetime as dt
import math

import pytest

from tickwise.operators.anomalies import detect_anomalies
from tickwise.operators.features import window_features
from tickwise.operators.rolling import rolling_stats
from tickwise.operators.ticks import align_columns, parse_crypto, parse_stock, unify_ticks
from tickwise.plans import quality as Q
from tickwise.plans import reports as R

T0 = dt.datetime(2024, 1, 1, 10, 0, 0)
MSG = "msg_key string, json_value string, topic string, kafka_timestamp timestamp"
TICK = "symbol string, asset_type string, event_time timestamp, event_id long, price double, volume double"


def _ticks(spark, rows):
    return spark.createDataFrame(rows, TICK)


def _windows(spark, values, feature="total_volume", symbol="S"):
    """One window row per value, one hour apart, other features neutral."""
    rows = []
    for i, v in enumerate(values):
        rows.append((symbol, "stock", 1.0, 1.0, 1.0, 1.0, 1.0,
                     v if feature == "total_volume" else 1.0, 1,
                     v if feature == "price_return_pct" else 0.0,
                     v if feature == "rolling_volatility" else 0.0, 0.0,
                     T0 + dt.timedelta(hours=i), T0 + dt.timedelta(hours=i + 1)))
    return spark.createDataFrame(rows, (
        "symbol string, asset_type string, open_price double, close_price double, "
        "high_price double, low_price double, avg_price double, total_volume double, "
        "record_count long, price_return_pct double, rolling_volatility double, "
        "volume_delta double, window_start timestamp, window_end timestamp"))


def test_parse_stock_edges(spark):
    kt = dt.datetime(2024, 1, 1, 12, 0, 0)
    rows = [("a", '{"symbol":"AAPL","asset_type":"stock","timestamp":"2024-01-01 09:30:00",'
                  '"close":1.5,"volume":10}', "t", kt),
            ("b", '{"symbol":"MSFT","asset_type":"stock","timestamp":"bad","close":2.0}', "t", kt),
            ("c", '{"symbol":"GOOG","asset_type":"stock","timestamp":"2024-01-01 09:30:00",'
                  '"close":"abc"}', "t", kt),
            ("d", '{"symbol": "TSLA", "asse', "t", kt),          # malformed JSON
            ("e", '{"asset_type":"stock","timestamp":"2024-01-01 09:30:00"}', "t", kt)]
    out = {r["symbol"]: r for r in parse_stock(spark.createDataFrame(rows, MSG)).collect()}
    assert set(out) == {"AAPL", "MSFT", "GOOG"}
    assert out["AAPL"]["event_time"] == dt.datetime(2024, 1, 1, 9, 30) and out["AAPL"]["price"] == 1.5
    assert out["MSFT"]["event_time"] == kt                       # fallback to broker time
    assert out["GOOG"]["price"] is None                          # tick kept, price null


def test_parse_stock_source_timezone(spark):
    rows = [("a", '{"symbol":"X","asset_type":"stock","timestamp":"2024-01-01 09:30:00",'
                  '"close":1.0}', "t", T0)]
    r = parse_stock(spark.createDataFrame(rows, MSG), source_tz="America/New_York").first()
    assert r["event_time"] == dt.datetime(2024, 1, 1, 14, 30)


def test_parse_crypto_shapes_and_strict(spark):
    kt = dt.datetime(2024, 1, 1, 12, 0, 0)
    rows = [("a", '{"symbol":"bitcoin","asset_type":"crypto","timestamp":"2024-01-01T09:30:00+00:00",'
                  '"price":100.0,"volume_24h":5e10}', "t", kt),
            ("b", '{"symbol":"solana","asset_type":"crypto","timestamp":"2024-01-01T10:30:00+01:00",'
                  '"open":1,"high":2,"low":0.5,"close":1.5,"volume":0.0}', "t", kt),
            ("c", '{"symbol":"ripple","asset_type":"crypto","timestamp":"2024-01-01T09:30:00Z",'
                  '"price":NaN}', "t", kt)]
    df = spark.createDataFrame(rows, MSG)
    out = {r["symbol"]: r for r in parse_crypto(df).collect()}
    assert out["bitcoin"]["volume"] == 5e10 and out["bitcoin"]["price"] == 100.0
    assert out["solana"]["price"] == 1.5 and out["solana"]["volume"] == 0.0
    assert out["solana"]["event_time"] == dt.datetime(2024, 1, 1, 9, 30)
    assert math.isnan(out["ripple"]["price"]) and out["ripple"]["volume"] == 0.0
    strict = {r["symbol"]: r for r in parse_crypto(df, strict=True).collect()}
    assert strict["ripple"]["price"] is None


def test_align_and_unify(spark):
    s = spark.createDataFrame([("A", "stock", T0, 1.0)],
                              "symbol string, asset_type string, event_time timestamp, close double")
    a = align_columns(s)
    assert a.columns[:3] == ["symbol", "asset_type", "event_time"]
    assert dict(a.dtypes)["volume"] == "double" and dict(a.dtypes)["kafka_timestamp"] == "timestamp"
    assert unify_ticks(s, s).count() == 2


def test_window_features_edges(spark):
    rows = [("A", "stock", T0, 1, 0.0, 1.0),                       # open = 0 -> return 0
            ("A", "stock", T0 + dt.timedelta(minutes=1), 2, 5.0, 3.0),
            ("B", "stock", T0, 3, 10.0, 1.0),                      # single tick
            ("C", "stock", T0, 9, 1.0, 1.0),                       # tied times: tie-breaker
            ("C", "stock", T0, 4, 2.0, None),                      # null volume ignored
            ("D", "stock", T0, 5, None, 1.0),                      # null price skipped
            ("D", "stock", T0 + dt.timedelta(minutes=2), 6, 4.0, 1.0)]
    w = {r["symbol"]: r for r in window_features(_ticks(spark, rows), "5 minutes", "event_id")
         .collect()}
    assert w["A"]["price_return_pct"] == 0.0 and w["A"]["volume_delta"] == 2.0
    assert w["B"]["rolling_volatility"] == 0.0 and w["B"]["record_count"] == 1
    assert (w["C"]["open_price"], w["C"]["close_price"]) == (2.0, 1.0)
    assert w["C"]["total_volume"] == 1.0 and w["C"]["record_count"] == 2
    assert w["D"]["open_price"] == 4.0 and w["D"]["price_return_pct"] == 0.0
    assert w["A"]["window_end"] - w["A"]["window_start"] == dt.timedelta(minutes=5)


@pytest.mark.parametrize("strategy", ["direct", "chunked"])
def test_first_windows_and_constant_series(spark, strategy):
    w = _windows(spark, [5.0, 5.0, 5.0, 5.0, 9.0])
    st = {r["window_start"]: r for r in rolling_stats(w, strategy=strategy).collect()}
    first = st[T0]
    assert first["total_volume_mean"] is None and first["total_volume_std"] is None
    assert st[T0 + dt.timedelta(hours=1)]["total_volume_std"] is None   # one earlier row
    assert st[T0 + dt.timedelta(hours=4)]["total_volume_std"] == 0.0    # constant history
    a = detect_anomalies(w, strategy=strategy).collect()
    assert a == []          # std 0 -> z 0, and no fallback (return 0, volatility 0)


def test_mean_std_defaults_and_threshold(spark):
    # history [0, 2] -> mean 1, std sqrt(2); x = 1 + 3*sqrt(2) is exactly z = 3 -> not flagged
    s2 = math.sqrt(2.0)
    w = _windows(spark, [0.0, 2.0, 1 + 3 * s2 + 1e-9, 100.0])
    a = detect_anomalies(w, detected_at="window_end").collect()
    z = {(r["window_start"], r["anomaly_type"]): r for r in a}
    assert (T0 + dt.timedelta(hours=2), "volume_surge") in z      # just above 3
    r = z[(T0 + dt.timedelta(hours=2), "volume_surge")]
    assert r["severity"] == "low" and abs(r["mean_value"] - 1.0) < 1e-12
    w3 = _windows(spark, [0.0, 2.0, 1 + 3 * s2 * (1 - 1e-12)])
    assert detect_anomalies(w3).count() == 0


def test_severity_bands(spark):
    from tickwise.functions.columns import severity
    df = spark.createDataFrame([(3.5,), (4.0,), (4.5,), (5.0,), (-5.5,)], "z double")
    got = [r[0] for r in df.select(severity("z")).collect()]
    assert got == ["low", "low", "medium", "medium", "high"]


def test_compat_fallback_fires_all_three_labels(spark):
    # first window: z = 0 for every feature; return 10 % -> all three labels, severity low
    w = _windows(spark, [10.0], feature="price_return_pct")
    a = detect_anomalies(w).collect()
    assert sorted(r["anomaly_type"] for r in a) == ["price_spike", "volatility_burst", "volume_surge"]
    assert {r["severity"] for r in a} == {"low"}
    assert {(r["mean_value"], r["std_value"]) for r in a} == {(0.0, 1.0)}
    strict = detect_anomalies(w, mode="strict").collect()
    assert [r["anomaly_type"] for r in strict] == ["price_spike"]


def test_min_rows_guard(spark):
    w = _windows(spark, [10.0], feature="price_return_pct")
    assert detect_anomalies(w, min_rows=2).count() == 0
    assert detect_anomalies(w, min_rows=1).count() == 3


def test_quality_edges(spark):
    clean = spark.createDataFrame(
        [("A", "stock", T0, T0, 1.0, 1.0, 1.0, 1.0, 1.0, 0.0, 0.0, 0.0, 1, T0),
         ("A", "stock", T0, T0, 1.0, 100.0, 1.0, 1.0, 1.0, 0.0, 0.0, 0.0, 1, T0),   # duplicate
         ("B", "crypto", T0, T0, 1.0, None, 1.0, 1.0, 1.0, 0.0, 0.0, 0.0, 1, T0),   # null close
         ("SYSTEM", "system", T0, T0, 1.0, 1.0, 1.0, 1.0, 1.0, 0.0, 0.0, 0.0, 1, T0)],
        "symbol string, asset_type string, window_start timestamp, window_end timestamp, "
        "open_price double, close_price double, high_price double, low_price double, "
        "volume double, price_return_pct double, rolling_volatility double, "
        "volume_delta double, record_count long, created_at timestamp")
    assert Q.dq_nulls(clean).first()["null_rows"] == 1
    d = Q.dq_duplicates(clean).first()
    assert (d["duplicate_groups"], d["status"]) == (1, "PASS")
    ps = {r["symbol"]: r["status"] for r in Q.dq_price_sanity(clean, as_of=T0 + dt.timedelta(minutes=1)).collect()}
    assert ps["A"] == "PASS"      # 100 / 1 = 100 is not > 100
    anoms = spark.createDataFrame([("SYSTEM", "high", 0.0)], "symbol string, severity string, z_score double")
    assert R.anomaly_count(anoms).first()["anomalies"] == 0
    assert R.high_severity_count(anoms).first()["high_severity"] == 0
