"""Queries over vendor payloads on events that share a time, an id or a fetch, or have no time."""

import datetime as dt

import pytest

import __spark_entry__ as E
from oracle_check import compare, duck

T0 = dt.datetime(2024, 1, 1, 10, 0, 0, 250000)
EVENT = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def _event(event_id, minute, price, symbol="signup", k=7):
    ts = None if minute is None else T0 + dt.timedelta(minutes=minute)
    return event_id, ts, 1, symbol, price, '{"k": %d}' % k


#: Responses hold the events of four ids.
SAME_TIME = [_event(0, 0, 20.0), _event(1, 0, 21.0), _event(2, 1, 22.0, k=3), _event(3, 2, 5.5),
             _event(4, 3, 0.5), _event(5, 3, 30.0), _event(8, 4, 480.0), _event(9, 4, 31.0), _event(12, 5, 32.0),
             _event(16, 6, 33.0), _event(16, 6, 33.0), _event(17, 6, 3.0), _event(18, 6, 40.0, "view")]
SAME_FETCH = [_event(4 * g + i, i, 10.0 * (i + 1), symbol) for g in range(6) for i in range(2) for symbol in ("signup", "purchase")] + [
    _event(4 * g + 100, 9, price) for g in range(3) for price in (0.5, 0.5)]
NO_TIME = [_event(0, None, 20.0), _event(1, 1, 21.0), _event(4, None, 22.0), _event(5, None, 22.0),
           _event(8, None, 5.5), _event(9, 2, 5.5), _event(12, None, 23.0)]


def _matches(spark, tmp, name, rows):
    spark.createDataFrame(rows, EVENT).coalesce(1).write.parquet(f"{tmp}/events.parquet")
    con = duck(tmp)
    con.execute(f"CREATE OR REPLACE VIEW events AS SELECT * FROM read_parquet('{tmp}/events.parquet/*.parquet')")
    return compare(spark, con, name, E.queries()[name], E.oracle_sql()[name], tmp)


@pytest.mark.parametrize("rows", [SAME_TIME, SAME_FETCH, NO_TIME], ids=["same_time", "same_fetch", "no_time"])
@pytest.mark.parametrize("name", ["classify_payload", "flatten_intraday", "flatten_intraday_defects", "latest_tick_per_symbol", "payload_rejects"])
def test_payload_query_matches_oracle(spark, tmp, name, rows):
    r = _matches(spark, tmp, name, rows)
    assert r["ok"] and r["rows"], r


def test_intraday_entries_of_one_time_stay(spark, tmp):
    """A response names the time of each tick, as often as ticks have it."""
    from tickwise.sources.tables import intraday_payloads
    spark.createDataFrame(SAME_TIME[:4], EVENT).coalesce(1).write.parquet(f"{tmp}/events.parquet")
    payload, = [r["payload"] for r in intraday_payloads(spark, tmp).collect()]
    assert payload.startswith('{"Time Series (5min)":{"2024-01-01 ') and payload.endswith("}}}")
    assert payload.count('"2024-01-01 10:00:00.250000":{') == 2 and payload.count('"2024-01-01 ') == 4
    assert '"2024-01-01 10:01:00.250000":{"1. open":"22.0","2. high":"22.0","3. low":"22.0","4. close":"22.0","5. volume":"3.0"}' in payload


def test_flatten_keeps_entries_that_repeat(spark):
    payload = '{"Time Series (5min)":{"t":{"1. open":"1"},"t":{"1. open":"2","5. volume":"x"},"":{},"t":{"1. open":"1"}}}'
    from tickwise.sources.payloads import flatten_intraday
    df = spark.createDataFrame([("A", payload, T0)], "symbol string, payload string, fetched_at timestamp")
    got = [(r["timestamp"], r["open"], r["volume"]) for r in flatten_intraday(df).collect()]
    assert sorted(got, key=repr) == [("t", 1.0, 0.0), ("t", 1.0, 0.0), ("t", 2.0, None), (None, 0.0, 0.0)]


def test_latest_tick_of_each_response(spark):
    """Responses of one fetch time stay apart by the columns that name them; ticks without time come last."""
    from tickwise.sources.payloads import flatten_intraday, latest_tick_per_symbol
    series = '{"Time Series (5min)":{%s}}'
    rows = [("A", 1, series % '"t1":{"1. open":"1"},"t2":{"1. open":"2"}', T0), ("A", 2, series % '"t1":{"1. open":"3"},"":{"1. open":"4"}', T0),
            ("A", 3, series % '"":{"1. open":"5"}', T0), ("A", 4, series % "", T0)]
    df = spark.createDataFrame(rows, "symbol string, id long, payload string, fetched_at timestamp")
    assert flatten_intraday(df, keep_fetch=True).columns[:3] == ["symbol", "fetched_at", "asset_type"]
    flat = flatten_intraday(df, keep_fetch=True, response=("id",))
    last = latest_tick_per_symbol(flat, keys=("symbol", "fetched_at", "id")).orderBy("id").collect()
    assert [(r["id"], r["asset_type"], r["timestamp"], r["open"]) for r in last] == [
        (1, "stock", "t2", 2.0), (2, "stock", "t1", 3.0), (3, "stock", None, 5.0)]
    assert [r["open"] for r in latest_tick_per_symbol(flat).collect()] == [2.0]


def test_rejects_of_one_fetch(spark):
    """A status is told once for a symbol and fetch time; unreadable fields are told one by one."""
    from tickwise.sources.payloads import payload_rejects
    ok = '{"Time Series (5min)":{"t":{"1. open":"x"},"t":{"1. open":"x"},"":{"2. high":"y","3. low":"1"}}}'
    rows = [("A", p, T0) for p in ('{"Note":"n"}', '{"Note":"m"}', '{"Error Message":"e"}', ok, ok)] + [("B", '{"Note":"n"}', T0), ("C", None, None)]
    df = spark.createDataFrame(rows, "symbol string, payload string, fetched_at timestamp")
    got = [(r["symbol"], r["status"], r["timestamp"], r["field"], r["value"]) for r in payload_rejects(df).collect()]
    assert sorted(got, key=repr) == sorted(
        [("A", "rate_limited", None, None, None), ("A", "error", None, None, None), ("B", "rate_limited", None, None, None),
         ("C", "invalid", None, None, None)] + 4 * [("A", "unreadable", "t", "1. open", "x")] + 2 * [("A", "unreadable", None, "2. high", "y")], key=repr)
