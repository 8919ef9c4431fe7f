"""Pure helpers: oracle SQL rounding rewrite, interval parsing, rounding rule."""

import os

import pytest

from conftest import SF_SMALL

from tickwise.functions.columns import interval_seconds, round_half_away, round_sql
from tickwise.plans.catalog import snap_rounds


def test_snap_rounds_rewrites_every_round_call():
    sql = "SELECT round(avg(abs(z)), 2) AS a, ROUND(x, 6), ground(y, 1) FROM t"
    assert snap_rounds(sql) == (f"SELECT {round_sql('avg(abs(z))', 2)} AS a, "
                                f"{round_sql('x', 6)}, ground(y, 1) FROM t")
    assert snap_rounds("SELECT 1") == "SELECT 1"
    # nested round calls are rewritten inside out
    assert snap_rounds("round(round(v, 3), 1)") == round_sql(round_sql("v", 3), 1)


@pytest.mark.parametrize("text,sec", [("5 minutes", 300), ("1 hour", 3600), ("7 days", 604800),
                                      ("30 seconds", 30), ("1 Week", 604800), ("1 day 2 hours", None)])
def test_interval_seconds(text, sec):
    assert interval_seconds(text) == sec


def test_rounding_rule_on_ties(spark):
    df = spark.createDataFrame([(1037.0821875,), (-2.675,), (53.25093749999999,), (2.5,)], "x double")
    got = [r[0] for r in df.select(round_half_away("x", 6)).collect()]
    assert got == [1037.082188, -2.675, 53.250938, 2.5]
    assert [r[0] for r in df.select(round_half_away("x", 2)).collect()] == [1037.08, -2.68, 53.25, 2.5]
    assert [r[0] for r in df.select(round_half_away("x", 0)).collect()] == [1037.0, -3.0, 53.0, 3.0]


def test_rounding_rule_same_in_duckdb():
    import duckdb
    vals = [1037.0821875, -2.675, 53.25093749999999, 2.5, 0.0000005, 5.05e10 + 0.5]
    con = duckdb.connect()
    for d in (0, 2, 6):
        got = [r[0] for r in con.execute(
            f"SELECT {round_sql('x', d)} FROM (SELECT unnest(?::DOUBLE[]) AS x)", [vals]).fetchall()]
        exp = {0: [1037.0, -3.0, 53.0, 3.0, 0.0, 50500000001.0],
               2: [1037.08, -2.68, 53.25, 2.5, 0.0, 50500000000.5],
               6: [1037.082188, -2.675, 53.250938, 2.5, 0.000001, 50500000000.5]}[d]
        assert got == exp


def test_every_oracle_rounding_uses_the_shared_rule():
    import re
    import __spark_entry__ as E
    for name, sql in E.oracle_sql().items():
        low = sql.lower()
        bare = len(re.findall(r"(?<![a-z_])round\(", low))
        shared = low.count(f"as decimal(38,9)), ")
        assert bare == 2 * shared, name


def test_rounding_of_values_without_places(spark):
    import math
    from pyspark.sql import functions as F
    from tickwise.functions.columns import round_half_away, round_sql
    import duckdb
    values = [2.675, -2.675, 0.0, 1e14 + 0.5, 1e15, 1e30, -1e300, float("inf"), float("-inf"), float("nan"), None]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = [r[0] for r in df.select(round_half_away("x", 2)).collect()]
    sql = [duckdb.sql(f"SELECT {round_sql('x', 2)} FROM (SELECT CAST('{v}' AS DOUBLE) AS x)").fetchall()[0][0]
           if v is not None else None for v in values]
    assert got[:2] == [2.68, -2.68] and got[4:9] == values[4:9] and math.isnan(got[9]) and got[10] is None
    assert repr(got) == repr(sql)


def test_scratch_removes_what_a_run_wrote(spark):
    """Tables of nested blocks and of a registered query, after errors too; others stay."""
    from tickwise.plans import catalog
    from tickwise.session import checkpoint_dir, materialize, scratch, scratch_path
    root = checkpoint_dir(spark)
    before = set(os.listdir(root))
    plain = catalog.queries()["z_scores"](spark, SF_SMALL).count()
    left = set(os.listdir(root)) - before
    assert left
    with scratch(spark) as outer:
        assert catalog.queries()["z_scores"](spark, SF_SMALL).count() == plain and os.listdir(outer)
        with pytest.raises(ValueError), scratch(spark) as inner:
            materialize(spark.range(5).groupBy("id").count(), "x")
            assert os.path.dirname(inner) == outer and len(os.listdir(inner)) == 1
            raise ValueError
        assert not os.path.exists(inner) and scratch_path(spark, "a") == os.path.join(outer, "a")
    assert set(os.listdir(root)) == before | left and scratch_path(spark, "a") == os.path.join(root, "a")


def test_batches_of_a_scorer_leave_no_tables(spark, tmp):
    from tickwise.session import checkpoint_dir
    from tickwise.sources import tables as T
    from tickwise.streaming.pipeline import make_batch_scorer
    root = checkpoint_dir(spark)
    before = set(os.listdir(root))
    windows = T.windows_from_events(spark, SF_SMALL)
    make_batch_scorer(spark, f"{tmp}/lake", f"{tmp}/anomalies", f"{tmp}/state", lookback=20)(windows, 0)
    assert spark.read.parquet(f"{tmp}/lake").count() == windows.count()
    assert set(os.listdir(root)) == before
