"""The registered queries on one written table against brute force, every column."""

import hashlib
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import llm_fixtures as X
from oracle_check import compare
from test_scans import KEY, PKCS8, TOKEN, b64
from test_scores import distance
from test_warc import PAGES, want as archived
from tickwise.llm import decontaminate, quality_model, queries, secret_scan, toxicity
from tickwise.llm.common import table

PEM = f"-----BEGIN PRIVATE KEY-----\n{b64(PKCS8)}\n-----END PRIVATE KEY-----"
HIDDEN = b64(b"password = hunter2hunter2")
#: Text, and what the method finds in it beyond the base kinds.
PLANTED = [(f"é {PEM} x", [("key", PEM)]), (f"data {b64(KEY)} x", [("key", b64(KEY))]), (f"bearer {TOKEN}", [("token", TOKEN)]),
           (f"see {HIDDEN} there", [("encoded", HIDDEN)]), (f"see {b64(b'just some words here, nothing else')}", [])]


def letters(i):
    return "".join("abcdefghij"[int(d)] for d in f"{i:03d}")


@pytest.fixture(scope="module")
def rows():
    kinds = ["zounds", "zoundse", "zoumds", '"zounds"', "said zounds", "z0unds", "zoundly", "zoundful", "zoundish"]
    harsh = [(2000 + i, f"you {letters(i)}xq {kinds[i % 9]} {letters(i)}yq " * 3) for i in range(90)]
    plain = [(3000 + i, f"they {letters(i)}xw and {letters(i)}yw " * 3) for i in range(90)]
    return (X.texts() + harsh + plain + [(4000 + i, t) for i, (t, _) in enumerate(PLANTED)]
            + [(4100, "white\rspace\x0bof\x0call kinds\r" * 20), (4101, "long " + "zounds" + "y" * 5000 + " word")])


@pytest.fixture(scope="module")
def labels(rows):
    known = {i for i, _ in rows if i is not None and i < 4000}
    return [(i, int(i % 2 == 0), int(2000 <= i < 3000)) for i in sorted(known)] + [(None, 1, 1), (10 ** 9, 0, 0), (2001, None, None)]


@pytest.fixture(scope="module")
def items(rows):
    return [(1, rows[5][1]), (2, None), (3, "they aaaxw and"), (4, "never here at all"), (None, "one")]


@pytest.fixture(scope="module")
def sf_dir(spark, rows, labels, items, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("registered"))
    X.frame(spark, rows).repartition(5).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    spark.createDataFrame([(i, "http://x", h) for i, h in PAGES], "page_id long, url string, html string").write.parquet(
        f"{path}/pages.parquet")
    return path


@pytest.fixture(scope="module")
def empty_dir(spark, sf_dir, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("none"))
    for t in ("documents", "labels", "benchmark", "pages"):
        spark.read.parquet(f"{sf_dir}/{t}.parquet").limit(0).write.parquet(f"{path}/{t}.parquet")
    return path


def run(spark, sf_dir, name, columns):
    got = queries.queries()[name](spark, sf_dir)
    assert got.columns[:len(columns)] == columns
    return [tuple(r)[:len(columns)] for r in got.collect()]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_near_duplicates(spark, rows, sf_dir):
    got = run(spark, sf_dir, "op1_minhash", ["doc_id", "n_shingles", "component_id", "kept"])
    groups, least = X.near_groups(rows, 4), {}
    for (i, _), (_, g) in zip(rows, groups):
        if g is not None and i is not None:
            least[g] = min(least.get(g, i), i)
    want = [(i, n, least.get(g) if g is not None else i) for (i, _), (n, g) in zip(rows, groups)]
    assert X.multiset(got) == X.multiset((i, n, c, i == c) for i, n, c in want)


def test_repeated_bytes(spark, rows, sf_dir):
    got = run(spark, sf_dir, "op2_suffixes", ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])
    assert X.multiset(got) == X.multiset(X.repeated_bytes(rows))


def is_held_out(i):
    return zlib.crc32(b"" if i is None else str(i).encode()) % 5 == 0


def slow_score(trees, x):
    total = trees.base
    for node in trees.roots:
        while trees.left[node] != node:
            node = (trees.left if x[trees.feature[node]] <= trees.threshold[node] else trees.right)[node]
        total += trees.value[node]
    return 1 / (1 + np.exp(-total))


def compare_scores(got, rows, slow, least):
    """``slow``: score of one text; rows of an id are told apart by their scores."""
    want = sorted(((i is not None, i or 0), is_held_out(i), slow(t or "")) for i, t in rows)
    got = sorted(((i is not None, i or 0), out, s, p) for i, out, s, p in got)
    assert [(i, out) for i, out, _, _ in got] == [(i, out) for i, out, _ in want]
    assert np.allclose([g[2] for g in got], [w[2] for w in want])
    assert all(p == int(s >= least) and 0 <= s <= 1 for _, _, s, p in got)


def test_toxicity(spark, rows, sf_dir, monkeypatch):
    got = run(spark, sf_dir, "op3_toxicity", ["doc_id", "held_out", "score", "predicted"])
    model = toxicity.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    assert model.terms and model.left_out == 0

    def lookup(self, word):
        """The nearest term by comparing all, a beginning with the first letters that it may reach."""
        found = []
        for i, t in enumerate(self.terms):
            ends = range(min(len(word), len(t.text) + 2) + 1) if t.beginning else [len(word)]
            d = min(distance(word[:k], t.text) if abs(k - len(t.text)) <= 2 else 9 for k in ends)
            if d == 0 or (len(word) >= 5 and d <= toxicity.edits(len(t.text))):
                found.append((d, t.beginning and d == 0, i))
        exact = [f for f in found if f[0] == 0 and not f[1]]
        d, _, i = min(exact or found, default=(0, 0, None))
        return None if i is None else (i, d)
    monkeypatch.setattr(toxicity.Lexicon, "lookup", lookup)
    finder = toxicity.Finder(toxicity.Lexicon(model.terms))
    compare_scores(got, rows, lambda t: slow_score(model.trees, finder.find([t])[0][0]), 0.5)
    harsh = {i: s for i, out, s, _ in got if i is not None and 2000 <= i < 4000 and out}
    assert np.mean([s for i, s in harsh.items() if i < 3000]) > 0.8 > 0.2 > np.mean([s for i, s in harsh.items() if i >= 3000])
    assert finder.find([dict(rows)[4101]])[0][1], "a padded word is found by its beginning"


def test_quality(spark, rows, sf_dir):
    got = run(spark, sf_dir, "op6_quality", ["doc_id", "held_out", "score", "predicted"])
    model = quality_model.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    compare_scores(got, rows, lambda t: slow_score(model, quality_model.statistics(t)), 0.3)


@pytest.mark.parametrize("label", [None, 0, 1])
def test_labels_that_teach_nothing(spark, sf_dir, label):
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").withColumn("toxic", F.lit(label).cast("int"))
    model = toxicity.train(docs, labels)
    scores = {r[0] for r in toxicity.score(docs, model).select("toxicity.score").distinct().collect()}
    assert not model.terms and len(scores) == 1
    (score,) = scores
    assert score == 0.5 if label is None else (score > 0.9 if label else score < 0.1)


def test_secrets(spark, rows, sf_dir):
    got = run(spark, sf_dir, "op4_secrets", ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])
    assign = re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    want = []
    for i, t in rows:
        t = t or ""
        base = [(m.start(), 0, m.end()) for m in assign.finditer(t) if len(m[2]) >= 12]
        base += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 18]
        base += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 16]
        more = [(t.index(x), secret_scan.KINDS.index(k), t.index(x) + len(x))
                for k, x in (PLANTED[i - 4000][1] if i is not None and 4000 <= i < 4100 else [])]

        def written(spans):
            return ",".join(f"{secret_scan.KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))
        n = [sum(k == kind for _, k, _ in base) for kind in range(3)]
        want.append((i, *n, sha(written(base)), written(base + more)))
    assert X.multiset(got) == X.multiset(want) and any(r[1] and r[2] for r in want)


def test_tokens(spark, rows, sf_dir):
    import tiktoken
    from tiktoken.load import load_tiktoken_bpe
    path, pattern = queries.vocabulary()
    ranks = load_tiktoken_bpe(path)
    own = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    got = run(spark, sf_dir, "op9_bpe", ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    ids = [own.encode_ordinary(t or "") for _, t in rows]
    assert X.multiset(got) == X.multiset((i, len(x), sha(",".join(map(str, x))), sha(t or "")) for (i, t), x in zip(rows, ids))


def test_archives(spark, sf_dir):
    got = run(spark, sf_dir, "op10_warc", ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])
    assert X.multiset(got) == X.multiset(archived(PAGES))


@pytest.mark.parametrize("block", [decontaminate.BLOCK_BYTES, 60])
def test_benchmark(spark, rows, items, sf_dir, monkeypatch, block):
    monkeypatch.setattr(decontaminate.search, "__defaults__", (*decontaminate.search.__defaults__[:-1], block))
    got = run(spark, sf_dir, "op7_decontaminate", ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"])
    hits = X.benchmark_hits([t for _, t in rows], items)
    assert X.multiset(got) == X.multiset((i, n, h, len(f), sha(",".join(sorted(map(str, f)))), h > 0)
                                         for (i, _), (n, h, f) in zip(rows, hits)) and any(h for _, h, _ in hits)


def test_blocks_come_one_after_another(spark, sf_dir):
    """One search in a plan, however many blocks; columns keep their names and order."""
    docs, bench = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    for block in (decontaminate.BLOCK_BYTES, 40):
        found = decontaminate.search(docs.withColumn("text_key", F.lit("clash")), bench, block_bytes=block)
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("search(") == 1
        assert found.columns == ["text_key" if c == "+" else c for c in (*docs.columns, "+")]


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for t in ("documents", "labels", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet/*.parquet')")
    r = compare(spark, con, name, queries.queries()[name], queries.oracle_sql()[name], sf_dir)
    assert r["ok"], r


def test_empty_tables(spark, empty_dir):
    for name, query in queries.queries().items():
        assert query(spark, empty_dir).count() == 0, name
