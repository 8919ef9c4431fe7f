"""Near duplicates, repeated bytes and repeated lines against brute force."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import llm_fixtures as X
from tickwise.llm import line_dedup, minhash, suffix_dedup


@pytest.fixture(scope="module")
def rows():
    return X.texts()


def test_near_duplicates_equal_all_pairs(spark, rows):
    got = [tuple(r) for r in minhash.near_duplicates(X.frame(spark, rows), words=4)
           .select("id", "n_shingles", "component_id").collect()]
    groups = X.near_groups(rows)
    least = {}
    for (i, _), (_, g) in zip(rows, groups):
        if g is not None and i is not None:
            least[g] = min(least.get(g, i), i)
    assert X.multiset(got) == X.multiset((i, n, i if g is None else least.get(g)) for (i, _), (n, g) in zip(rows, groups))
    assert sum(n > 1 for n in X.Counter(g for _, g in groups if g is not None).values()) > 5


@pytest.mark.parametrize("block", [minhash.BLOCK_TOKENS, 500])
def test_large_buckets_are_compared_whole(spark, monkeypatch, block):
    """One group of near copies at all distances, whole and in blocks of a few documents."""
    rnd = random.Random(2)
    base = [f"w{i}" for i in range(90)]
    rows = []
    for i in range(150):
        words = list(base)
        for _ in range(rnd.randrange(0, 12)):
            words[rnd.randrange(len(words))] = f"x{rnd.random()}"
        rows.append((1000 - i, " ".join(words)))
    monkeypatch.setattr(minhash, "BLOCK_TOKENS", block)
    got = [tuple(r) for r in minhash.near_duplicates(X.frame(spark, rows), words=4).select("id", "component_id").collect()]
    groups = X.near_groups(rows)
    least = {}
    for (i, _), (_, g) in zip(rows, groups):
        least[g] = min(least.get(g, i), i)
    assert sorted(got) == sorted((i, least[g]) for (i, _), (_, g) in zip(rows, groups))
    assert 1 < len(least) < 150


def test_links_inside_a_bucket_equal_all_pairs():
    rnd = np.random.default_rng(3)
    for _ in range(60):
        base = rnd.integers(0, 1 << 62, 60)
        m = int(rnd.integers(2, 30))
        sets = [np.unique(np.r_[rnd.choice(base, int(rnd.integers(40, 60)), replace=False), rnd.integers(0, 1 << 62, int(rnd.integers(0, 6)))])
                for _ in range(m)]
        labels = rnd.integers(0, m, m)
        sides = rnd.integers(0, 2, m) if rnd.random() < 0.5 else np.zeros(m, int)
        two = sides.min() != sides.max()

        def joined(pairs):
            top = {int(x): int(x) for x in labels}

            def root(x):
                while top[x] != x:
                    x = top[x]
                return x
            for i, j in pairs:
                top[root(int(labels[i]))] = root(int(labels[j]))
            return [root(int(x)) for x in labels]

        def partition(roots):
            return [min(j for j, y in enumerate(roots) if y == x) for x in roots]
        every = [(i, j) for i in range(m) for j in range(i) if not two or sides[i] != sides[j]
                 if 100 * (k := len(np.intersect1d(sets[i], sets[j]))) >= 80 * (len(sets[i]) + len(sets[j]) - k)]
        got = minhash.links_inside(np.arange(m), labels, sets, sides, 80)
        assert set(map(tuple, map(sorted, got))) <= {tuple(sorted(x)) for x in every}
        assert partition(joined(got)) == partition(joined(every))


@pytest.mark.parametrize("n", [200, 400])
def test_unlinked_copies_travel_once_a_bucket(spark, monkeypatch, n):
    """Near copies of one text that stay unlinked (0.73): components as by all pairs, and what
    is sent grows with the members of buckets, not with their pairs."""
    rnd = random.Random(9)
    base = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(n):
        words = list(base)
        for at in rnd.sample(range(200), 4):
            words[at] = f"x{rnd.random()}"
        rows.append((i, " ".join(words)))
    sent = []
    real = minhash.links_of_buckets

    def counted(members, sets, percent):
        sent.append(members.count())
        return real(members, sets, percent)
    monkeypatch.setattr(minhash, "links_of_buckets", counted)
    got = {r["id"]: r["component_id"] for r in minhash.near_duplicates(X.frame(spark, rows), words=4).collect()}
    least = {}
    groups = X.near_groups(rows)
    for (i, _), (_, g) in zip(rows, groups):
        least[g] = min(least.get(g, i), i)
    assert got == {i: least[g] for (i, _), (_, g) in zip(rows, groups)}
    assert len(least) > 20 and sent[0] <= 32 * n


def test_signatures_estimate_similarity():
    rnd = np.random.default_rng(0)
    both, a, b = (rnd.integers(0, 1 << 63, n, dtype=np.uint64) for n in (800, 100, 100))
    s = minhash.signatures([np.unique(np.r_[both, a]), np.unique(np.r_[both, b]), both[:3], both[:0]])
    assert abs((s[0] == s[1]).mean() - 0.8) < 0.12
    assert len(np.unique(s[2] >> np.uint64(32))) > 10 and (s[3] == np.iinfo(np.uint64).max).all()
    alone = minhash.signatures([np.unique(np.r_[both, a])])
    assert (alone[0] == s[0]).all()      # a signature does not depend on its neighbours


def test_repeated_bytes_equal_brute_force(spark, rows):
    done = suffix_dedup.dedup(X.frame(spark, rows))
    got = [(r["id"], r["n_bytes"], sum(x["end"] - x["start"] for x in r["runs"]), len(r["runs"]),
            X.hashlib.sha256(bytes(r["kept"])).hexdigest()) for r in done.collect()]
    want = X.repeated_bytes(rows)
    assert X.multiset(got) == X.multiset(want) and sum(r[2] for r in want) > 3000


def test_repeated_grams_over_batch_borders():
    """Rows of a gram that go on over many batches: what a task keeps of them doesn't matter."""
    rnd = random.Random(3)
    for _ in range(200):
        rows = []
        for key in range(rnd.randrange(1, 6)):
            ids = rnd.choice([[1], [1, 2, 3]])
            rows += [(key, rnd.choice(ids), rnd.randrange(50)) for _ in range(rnd.randrange(1, 12))]
            rows += [(key, 0, suffix_dedup.MARK)] * rnd.choice([0, 0, 1])
            rows += [(key, 9, -2 - rnd.randrange(50))] * rnd.choice([0, 1])
        rnd.shuffle(rows)
        rows.sort(key=lambda r: r[0])
        batches, rest = [], rows
        while rest:
            n = rnd.randrange(0, 4)
            batches.append(pa.record_batch([pa.array([r[i] for r in rest[:n]], f.type) for i, f in
                                              enumerate(suffix_dedup._ANCHORS)], schema=suffix_dedup._ANCHORS))
            rest = rest[n:]
        got = [(r["id"], r["at"]) for b in suffix_dedup._repeated(iter(batches)) for r in b.to_pylist()]
        want = [(i, -2 - at) for _, i, at in rows if at < suffix_dedup.MARK]
        for key in {r[0] for r in rows}:
            own = [r[1:] for r in rows if r[0] == key and r[2] >= 0]
            if len({i for i, _ in own}) > 1 or any(r[0] == key and r[2] == suffix_dedup.MARK for r in rows):
                want += own
        assert X.multiset(got) == X.multiset(want)


def test_spans_come_from_leaves(monkeypatch):
    """Equal contexts of a gram are sorted as one set of suffixes; a byte goes if a leaf that
    covers it has a smaller id."""
    sorted_sets, real = [], suffix_dedup.sort_suffixes

    def counted(buffer, starts, group):
        order, label = real(buffer, starts, group)
        sorted_sets.append((len(starts), int(label.max()) + 1))
        return order, label
    monkeypatch.setattr(suffix_dedup, "sort_suffixes", counted)
    rnd = random.Random(9)
    for _ in range(100):
        base = bytes(rnd.choice(b"ab") for _ in range(70))
        rows = []
        for i in range(rnd.randrange(2, 9)):
            a = rnd.randrange(0, 10)
            c = base[a:a + 50 + rnd.randrange(0, 11)]
            if rnd.random() < 0.5:
                c = c[:-3] + bytes(rnd.choice(b"ab") for _ in range(3))
            rows += [(7, rnd.randrange(4), 100 + i, 5, len(c), c)] * rnd.choice([1, 1, 2])
        least = {}
        for _, i, _, _, _, c in rows:
            for x in range(len(c) - 49):
                least[c[x:x + 50]] = min(least.get(c[x:x + 50], i), i)
        want = {(i, t, lo + x + k) for _, i, t, lo, _, c in rows for x in range(len(c) - 49)
                if least[c[x:x + 50]] < i for k in range(50)}
        before = len(sorted_sets)
        got = {(i, t, lo + k) for i, t, lo, n in suffix_dedup._covered(rows) for k in range(n)}
        assert got == want
        if want and len({r[5] for r in rows}) > 1:
            suffixes, leaves = sorted_sets[before]
            assert leaves == len(least) and suffixes == sum(len(c) - 49 for c in {r[5] for r in rows})


def test_blind_trie_orders_and_groups():
    rnd = random.Random(5)
    for _ in range(300):
        strings = ["".join(rnd.choice("ab") for _ in range(6)).encode() for _ in range(rnd.randrange(1, 30))]
        leaves = suffix_dedup.blind_trie(strings)
        assert [strings[x[0]] for x in leaves] == sorted(set(strings))
        assert sorted(i for x in leaves for i in x) == list(range(len(strings)))
        assert all(strings[i] == strings[x[0]] for x in leaves for i in x)


def test_repeated_lines_equal_brute_force(spark, rows):
    docs = X.frame(spark, rows)
    done = line_dedup.dedup(docs)
    assert set(done.columns) == set(docs.columns)      # ``kept`` is replaced, all others are passed on
    got = [(r["doc_id"], r["kept"]["n_lines"], r["kept"]["n_removed"], r["kept"]["text"]) for r in done.collect()]
    want = X.kept_lines(rows)
    assert X.multiset(got) == X.multiset(want) and sum(r[2] for r in want) > 50


def test_empty_tables(spark):
    none = X.frame(spark, [])
    assert minhash.near_duplicates(none).count() == 0
    assert suffix_dedup.dedup(none).count() == 0
    assert line_dedup.dedup(none).count() == 0
