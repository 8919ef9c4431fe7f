"""The registered queries against DuckDB, the pipeline against its stages by brute force."""

import subprocess
import sys

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
import corpus_pipeline as C
import llm_fixtures as X
from conftest import ROOT, SF_SMALL
from oracle_check import compare, duck
from tickwise.llm import queries as Q
from tickwise.llm.common import table


@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
def test_query_matches_sql(spark, name):
    r = compare(spark, duck(SF_SMALL), name, Q.queries()[name], Q.oracle_sql()[name], SF_SMALL)
    assert r["ok"], r


def test_all_are_registered():
    numbers = {int(n[2:].split("_")[0]) for n in E.queries() if n.startswith("op")}
    assert numbers == set(range(1, 14)) and "pipeline" in E.queries()


def test_entry_module_works_without_the_package(tmp_path):
    code = ("import sys; sys.modules['corpus_pipeline'] = None; import __spark_entry__ as e; "
            "assert not any(n.startswith('op') for n in e.queries()) and 'pipeline' not in e.oracle_sql()")
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True)


def test_stages_do_what_they_say(spark):
    """Clean rows pass, columns stay, and every stage acts on what the one before kept."""
    rows = X.texts()
    docs = X.frame(spark, rows)
    lines = C.without_repeated_lines(spark, docs, SF_SMALL)
    assert lines.columns == docs.columns
    want = [(i, t) for i, n, gone, t in X.kept_lines(rows) if gone < n or not gone]
    after = [(r["doc_id"], r["text"]) for r in lines.collect()]
    assert X.multiset(after) == X.multiset(want)
    near = C.one_of_near_duplicates(spark, X.frame(spark, after), SF_SMALL)
    got = [(r["doc_id"], r["text"]) for r in near.collect()]
    groups = X.near_groups(after, 5)
    with_words = {g for _, g in groups if g is not None}
    assert near.columns == docs.columns
    assert sum(bool(X.WORD.search(t or "")) for _, t in got) == len(with_words)
    assert {i for i, t in got if not X.WORD.search(t or "")} == {i for i, t in after if not X.WORD.search(t or "")}
    bench = C.without_benchmark(spark, X.frame(spark, got), SF_SMALL)
    items = [(r["item_id"], r["text"]) for r in table(spark, SF_SMALL, "benchmark").collect()]
    clean = [i for (i, t), (_, hit, _) in zip(got, X.benchmark_hits([t for _, t in got], items)) if not hit]
    assert X.multiset(r["doc_id"] for r in bench.collect()) == X.multiset(clean)
    assert C.good_quality(spark, docs, SF_SMALL).columns == docs.columns
    empty = X.frame(spark, [])
    for _, stage in C.STAGES[1:]:
        assert stage(spark, empty, SF_SMALL).count() == 0


def test_run_keeps_good_documents(spark):
    docs, labels = table(spark, SF_SMALL, "documents"), table(spark, SF_SMALL, "labels")
    out = C.run(spark, SF_SMALL)
    assert out.columns == ["doc_id", "lang", "source", "n_tokens", "ids_sha256", "decoded_sha256"]
    kept = {r[0] for r in out.select("doc_id").collect()}
    assert len(kept) == out.count() > 100
    bad = {r[0] for r in labels.filter("quality = 0").select("doc_id").collect()}
    assert len(kept & bad) <= len(bad) // 4
