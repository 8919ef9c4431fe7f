"""Shards, filter audit and fill-in-the-middle: the registered queries against brute force, every column."""

import hashlib
import math
import random
import zlib
from collections import Counter
from itertools import permutations

import pytest
from pyspark.sql import functions as F

import llm_fixtures as X
from tickwise.llm import fill_in_middle, filter_audit, queries, sharding

SOURCES = ["src0", "src0", "src1", "", None, "lonely"]


@pytest.fixture(scope="module")
def rows():
    extra = [(500, "<P> in the text\nmore\n"), (501, "\n\n"), (502, "\nno newline at the end"), (503, "A" * 30 + " b" * 60),
             (504, "x" * 300_000 + "\n" + "line\n" * 40_000), (None, None)] + [(505, "many equal rows")] * 50
    return X.texts() + extra


@pytest.fixture(scope="module")
def sources(rows):
    return [SOURCES[i % len(SOURCES)] for i in range(len(rows))]


@pytest.fixture(scope="module")
def labels(rows):
    rnd = random.Random(3)
    out = [(i, rnd.choice([0, 1, None]), rnd.choice([0, 1])) for i in {i for i, _ in rows if i is not None} if i % 3]
    return out + [(None, 1, 1), (1, 1, 1), (10 ** 9, 1, 1)]


@pytest.fixture(scope="module")
def sf_dir(spark, rows, sources, labels, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame([(i, t, "en", s, len(t or ""), "clash", 1, "x") for (i, t), s in zip(rows, sources)],
                          "doc_id long, text string, lang string, source string, n_chars long, Shard string, n long, "
                          "fim string").repartition(5).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


@pytest.fixture(scope="module")
def empty_dir(spark, sf_dir, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("empty"))
    for t in ("documents", "labels"):
        spark.read.parquet(f"{sf_dir}/{t}.parquet").limit(0).write.parquet(f"{path}/{t}.parquet")
    return path


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute_shard(i, weights):
    key = "n" if i is None else f"k:{i}"
    scores = [(-math.log((int(hashlib.md5(f"{key}:{s}".encode()).hexdigest()[:13], 16) + 0.5) / 2 ** 52) / w, s)
              for s, w in enumerate(weights) if w > 0]
    return min(scores)[1]


@pytest.mark.parametrize("block", [sharding.BLOCK, 7])
def test_shards_equal_brute_force(spark, rows, sf_dir, monkeypatch, block):
    monkeypatch.setattr(sharding, "BLOCK", block)       # 7: the record of 50 copies is dealt out in blocks
    got = [tuple(r) for r in queries.queries()["op11_sharding"](spark, sf_dir).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard").collect()]
    want, places = [], {}
    for i, t in rows:
        data = (t or "").encode()
        shard, grown = brute_shard(i, [1] * 8), brute_shard(i, [1] * 9)
        assert grown in (shard, 8)
        key = "n" if i is None else f"k:{i}"
        place = hashlib.md5(f"{key}:{len(data) + 1}:{zlib.crc32(data)}".encode()).hexdigest()
        places.setdefault(shard, []).append((place, (i, len(data) + 1, zlib.crc32(data), "key", shard), grown))
    for records in places.values():
        want += [(*r, slot, grown) for slot, (_, r, grown) in enumerate(sorted(records, key=lambda x: x[0]))]
    assert X.multiset(got) == X.multiset(want)
    assert len({r[6] for r in got}) == 9


def test_shards_by_weight(spark, tmp):
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"), F.lit(1).alias("SHARD"))
    weights = [1.0, 2.0, 0.0, 5.0]
    placed = {r["doc_id"]: r["shard"] for r in sharding.assign(docs, weights).collect()}
    share = Counter(placed.values())
    assert set(share) == {0, 1, 3}
    assert all(abs(share[s] / 20_000 - w / 8) < 0.015 for s, w in enumerate(weights))
    heavier = {r["doc_id"]: r["shard"] for r in sharding.assign(docs, [1.0, 4.0, 0.0, 5.0]).collect()}
    assert {heavier[i] for i in placed if heavier[i] != placed[i]} == {1}
    less = {r["doc_id"]: r["shard"] for r in sharding.assign(docs, [1.0, 2.0, 0.0, 0.0]).collect()}
    assert {placed[i] for i in placed if less[i] != placed[i]} == {3}
    assert all(placed[i] == brute_shard(i, weights) for i in range(0, 20_000, 97))
    sharding.write(docs, weights, f"{tmp}/shards", files=3)
    back = spark.read.parquet(f"{tmp}/shards")
    assert {r["doc_id"]: r["shard"] for r in back.collect()} == placed and back.count() == 20_000
    with pytest.raises(ValueError):
        sharding.assign(docs, [0.0, 0.0])


def test_shards_stay_native(spark, sf_dir):
    plan = sharding.assign(spark.read.parquet(f"{sf_dir}/documents.parquet"), [1.0] * 8)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def brute_audit(rows, sources, labels):
    least = {}
    for i, t in rows:
        k = math.inf if i is None else i
        least[t or ""] = min(least.get(t or "", math.inf), k)
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    fails, parts = [], {}
    for n, ((i, t), s) in enumerate(zip(rows, sources)):
        t = t or ""
        w, bad = X.WORD.findall(t), ""
        bad += "A" if len(w) < 50 else ""
        bad += "B" if 100 * len(set(w)) < 65 * len(w) else ""
        bad += "C" if 100 * sum("A" <= c <= "Z" for c in t) > 5 * len(t) else ""
        bad += "D" if any(c in "#$%&*|" for c in t) else ""
        bad += "E" if (math.inf if i is None else i) > least[t] else ""
        fails.append(set(bad))
        parts.setdefault(s or "", []).append(n)
    out = []
    for part, ns in parts.items():
        shapley, lines = Counter(), []
        for order in permutations("ABCDE"):
            alive = set(ns)
            for step, f in enumerate(order, 1):
                gone = {n for n in alive if f in fails[n]}
                alive -= gone
                shapley[f] += len(gone)
                lines.append(("".join(order), step, f, len(alive), len(gone), sum(f in fails[n] for n in ns) - len(gone),
                              sum(fails[n] == {f} for n in ns), sum(rows[n][0] in good for n in gone),
                              sum(rows[n][0] in toxic for n in gone)))
        out += [(part, o, s, *rest, shapley[f]) for o, s, f, *rest in lines]
    return out


@pytest.mark.parametrize("block", [filter_audit.RANGE, 4])
def test_audit_equals_brute_force(spark, rows, sources, labels, sf_dir, monkeypatch, block):
    monkeypatch.setattr(filter_audit, "RANGE", block)   # 4: a part has many ranges
    got = queries.queries()["op12_filter_audit"](spark, sf_dir)
    assert [c.dataType.simpleString() for c in got.schema] == ["string", "string", "int"] + ["bigint"] * 7
    assert got.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost",
                           "toxic_lost", "shapley"]
    want = brute_audit(rows, sources, labels)
    assert X.multiset(tuple(r) for r in got.collect()) == X.multiset(want)
    assert len(want) == 600 * 4 and any(r[7] for r in want) and any(r[8] for r in want) and any(r[5] for r in want)


def test_galloping_merges():
    rnd = random.Random(4)
    for _ in range(300):
        lists = [sorted(rnd.sample(range(60), rnd.randrange(0, 40))) for _ in range(rnd.randrange(1, 6))]
        assert filter_audit.union(lists) == sorted(set().union(*lists))
        assert filter_audit.difference(lists[0], lists[-1]) == len(set(lists[0]) - set(lists[-1]))
        at = rnd.randrange(0, len(lists[0]) + 1)
        bound = rnd.randrange(60)
        assert filter_audit.gallop(lists[0], bound, at) == max(at, sum(x < bound for x in lists[0]))


def brute_middle(i, t, percent=100):
    t = t or ""
    units = [u + "\n" for u in t.split("\n")[:-1]] + [u for u in t.split("\n")[-1:] if u]
    h = hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()
    h = [int(h[8 * k:8 * k + 8], 16) for k in range(4)]
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not t or "<P>" in t or "<S>" in t or "<M>" in t or h[2] % 100 >= percent:
        return i, n, "plain", None, None, digest(t), digest(t)
    if h[3] % 100 < 50:
        return i, n, "spm", len(p), len(m), digest(f"<S>{s}<P>{p}<M>{m}"), digest(t)
    return i, n, "psm", len(p), len(m), digest(f"<P>{p}<S>{s}<M>{m}"), digest(t)


def test_middles_equal_brute_force(spark, rows, sf_dir):
    got = [tuple(r) for r in queries.queries()["op13_fill_in_middle"](spark, sf_dir).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256").collect()]
    want = [brute_middle(i, t) for i, t in rows]
    assert X.multiset(got) == X.multiset(want)
    assert len({r[2] for r in want}) == 3 and any(r[4] for r in want)


def test_middles_by_rate(spark, rows, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    done = fill_in_middle.transform(docs, percent=40)
    assert sorted(done.columns) == sorted(docs.columns)      # ``fim`` is replaced, all others are passed on
    got = done.select("doc_id", "fim.n", "fim.form", "fim.prefix_chars", "fim.middle_chars").collect()
    want = [brute_middle(i, t, 40)[:5] for i, t in rows]
    assert X.multiset(map(tuple, got)) == X.multiset(want) and sum(r[2] == "plain" for r in want) > 30


def test_empty_tables(spark, empty_dir):
    for name in ("op11_sharding", "op12_filter_audit", "op13_fill_in_middle"):
        assert queries.queries()[name](spark, empty_dir).count() == 0
