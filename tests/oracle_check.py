"""Run registered queries on Spark and their SQL twins on DuckDB; compare.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
Compares row count, column names (sorted) and the multiset of rows with
columns in name order; floats compare exactly, so every computed double is
rounded explicitly on both sides (``round_cols`` / SQL ``round``).
"""

from __future__ import annotations

import datetime as dt
import decimal
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir):
    import duckdb
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    # floats compare exactly (as a value hash would); only -0.0 == 0.0 and NaN
    if isinstance(v, float):
        if v != v:
            return "nan"
        return v + 0.0
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6) + 0.0
    if isinstance(v, dt.datetime) and v.tzinfo is not None:
        return v.astimezone(dt.timezone.utc).replace(tzinfo=None)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return _norm(v.asDict(recursive=True))
    return v


def rows_key(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr)


def compare(spark, con, name, builder, sql, sf_dir):
    t0 = time.time()
    df = builder(spark, sf_dir)
    got_cols = df.columns
    got = [tuple(r) for r in df.collect()]
    t1 = time.time()
    if sql is None:
        return dict(name=name, ok=None, rows=len(got), spark_s=round(t1 - t0, 2))
    cur = con.execute(sql)
    exp_cols = [d[0] for d in cur.description]
    exp = cur.fetchall()
    res = dict(name=name, rows=len(got), exp_rows=len(exp), spark_s=round(t1 - t0, 2))
    if sorted(got_cols) != sorted(exp_cols):
        res.update(ok=False, why=f"columns {sorted(got_cols)} != {sorted(exp_cols)}")
        return res
    a, b = rows_key(got_cols, got), rows_key(exp_cols, exp)
    if a != b:
        sa, sb = set(a), set(b)
        res.update(ok=False, why=f"only spark {list(sa - sb)[:2]} only duck {list(sb - sa)[:2]}")
        return res
    res["ok"] = True
    return res


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if not a.startswith("/")]
    from tickwise.session import get_session
    import __spark_entry__ as E
    spark = get_session("local[8]", shuffle_partitions=8)
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        try:
            r = compare(spark, con, name, fn, sqls.get(name), sf_dir)
        except Exception as e:  # report and continue
            r = dict(name=name, ok=False, why=f"{type(e).__name__}: {str(e)[:300]}")
        bad += r.get("ok") is False
        print(r, flush=True)
    print(f"FAILED {bad}" if bad else "ALL OK")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
