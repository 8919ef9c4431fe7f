"""The chunked prefix scan equals the plain per-symbol window."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SF_MID, SF_SMALL
from tickwise.operators.rolling import FEATURES, merge_moments, moments, rolling_stats
from tickwise.sources import tables as T

STATS = [f"{f}_{s}" for f in FEATURES for s in ("mean", "std")]


def _rows(df):
    out = {}
    for r in df.collect():
        out[(r["symbol"], r["asset_type"], r["window_start"])] = tuple(
            None if r[c] is None else round(r[c], 6) for c in STATS)
    return out


@pytest.mark.parametrize("lookback,kw", [
    (None, dict(chunk_seconds=3 * 3600)),          # many chunks per symbol
    (None, dict(chunk_rows=7)),
    (20, dict(block_rows=25)),                      # halo crosses many blocks
    (3, dict(block_rows=3)),                        # block = lookback
])
def test_chunked_equals_direct(spark, lookback, kw):
    w = T.windows_from_events(spark, SF_MID)
    a = _rows(rolling_stats(w, lookback=lookback, strategy="direct"))
    b = _rows(rolling_stats(w, lookback=lookback, **kw))
    assert a == b and len(a) == 3385


def test_hot_symbol_is_split(spark):
    """One symbol with most of the rows: chunk groups stay bounded."""
    t = T.ticks_from_lineitem(spark, SF_SMALL).withColumn(
        "symbol", F.when(F.col("symbol").cast("int") % 3 != 0, F.lit("HOT"))
        .otherwise(F.col("symbol")))
    from tickwise.operators.features import window_features
    w = window_features(t, "1 day", "event_id")
    hot = w.filter(F.col("symbol") == "HOT").count()
    assert hot > w.count() / 2
    a = _rows(rolling_stats(w, strategy="direct"))
    b = _rows(rolling_stats(w, chunk_rows=16))
    assert a == b
    # largest (symbol, chunk) group in the chunked plan stays within the bound
    from tickwise.operators.rolling import _chunk_col
    from tickwise.session import materialize
    m = materialize(w)
    biggest = (m.withColumn("_c", _chunk_col(m, "window_start", None, 16))
               .groupBy("symbol", "asset_type", "_c").count().agg(F.max("count")).first()[0])
    assert biggest <= 16


def test_base_moments_equal_full_history(spark):
    """Scoring the second half with moments of the first half = one run over all."""
    w = T.windows_from_events(spark, SF_SMALL)
    cut = dt.datetime(2024, 1, 15)
    first, second = w.filter(F.col("window_start") < cut), w.filter(F.col("window_start") >= cut)
    full = _rows(rolling_stats(w, strategy="direct"))
    part = _rows(rolling_stats(second, base=moments(first)))
    assert part == {k: v for k, v in full.items() if k[2] >= cut}
    # merging moments of two halves = moments of the whole
    m_all = {r["symbol"]: r for r in moments(w).collect()}
    m_mrg = {r["symbol"]: r for r in merge_moments(moments(first), moments(second)).collect()}
    for s, r in m_all.items():
        for f in FEATURES:
            assert r[f"{f}_n"] == m_mrg[s][f"{f}_n"]
            assert abs(r[f"{f}_m2"] - m_mrg[s][f"{f}_m2"]) <= 1e-6 * max(1.0, abs(r[f"{f}_m2"]))


@pytest.mark.parametrize("lookback", [None, 3])
def test_null_keys_are_keys(spark, lookback):
    """Windows with a null asset type are scored like any others."""
    w = T.windows_from_events(spark, SF_SMALL)
    w = w.withColumn("asset_type", F.when(F.col("symbol") != "click", F.col("asset_type")))
    full = _rows(rolling_stats(w, strategy="direct", lookback=lookback))
    assert _rows(rolling_stats(w, lookback=lookback)) == full and len(full) == w.count()
    m = moments(w)
    assert merge_moments(m, m).count() == m.count()
