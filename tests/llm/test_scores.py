"""Trees, quality and toxicity scores, quality rules."""

import numpy as np
from pyspark.sql import functions as F

import llm_fixtures as X
from conftest import SF_MID
from tickwise.llm import boosting, quality_model, quality_rules, toxicity
from tickwise.llm.common import held_out, table


def area(score, label):
    """Area under the curve of scores against labels."""
    rank = np.argsort(np.argsort(score, kind="stable"), kind="stable") + 1
    good = label == 1
    return (rank[good].sum() - good.sum() * (good.sum() + 1) / 2) / (good.sum() * (~good).sum())


def test_trees_learn_and_flatten():
    rnd = np.random.default_rng(1)
    x = rnd.normal(size=(2000, 4))
    y = ((x[:, 0] > 0.3) ^ (x[:, 2] > 0)).astype(float)
    trees = boosting.fit(x[:1500], y[:1500])
    assert area(trees.score(x[1500:]), y[1500:]) > 0.97

    def walk(node, row):
        while trees.left[node] != node:
            node = trees.left[node] if row[trees.feature[node]] <= trees.threshold[node] else trees.right[node]
        return trees.value[node]
    slow = [1 / (1 + np.exp(-trees.base - sum(walk(r, row) for r in trees.roots))) for row in x[:50]]
    assert np.allclose(slow, trees.score(x[:50]))
    assert (boosting.fit(x[:0], y[:0]).score(x[:3]) == 0.5).all()
    assert (boosting.fit(x[:9], np.ones(9)).score(x[:3]) > 0.8).all()


SF_LARGE = "/root/testdata/sf0.1"      # only some tenth of the labels are toxic


def scored(spark, label, train, score, column, sf_dir=SF_MID):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = train(docs, labels)
    rows = score(docs, model).select("doc_id", held_out().alias("out"), F.col(column).alias("s")).join(labels, "doc_id")
    got = rows.filter("out").select("s", label).toPandas()
    return model, got["s"].to_numpy(), got[label].to_numpy()


def test_quality_of_held_out_rows(spark):
    model, score, label = scored(spark, "quality", quality_model.train, quality_model.score, "score")
    assert area(score, label) > 0.97
    rows = X.texts()
    got = quality_model.score(X.frame(spark, rows), model)
    assert got.filter("score between 0 and 1").count() == len(rows)
    assert quality_model.keep_good(X.frame(spark, rows), model, 0.0).columns == X.frame(spark, []).columns
    assert quality_model.score(X.frame(spark, []), model).count() == 0
    none = table(spark, SF_MID, "labels").withColumn("quality", F.lit(None).cast("int"))
    assert (quality_model.train(table(spark, SF_MID, "documents"), none).score(np.zeros((2, 23))) == 0.5).all()


def test_toxicity_of_held_out_rows(spark):
    model, score, label = scored(spark, "toxic", toxicity.train, toxicity.score, "toxicity.score", SF_LARGE)
    assert area(score, label) > 0.9
    rows = [(5001, "You are an idiot and a moron, " + "plain words here " * 20), (5002, "plain words here " * 20), *X.texts()]
    got = {r["doc_id"]: r["toxicity"] for r in toxicity.score(X.frame(spark, rows), model).collect() if r["doc_id"] in (5001, 5002)}
    assert got[5001]["score"] > got[5002]["score"] and 0 <= got[5002]["score"] <= 1
    assert toxicity.score(X.frame(spark, []), model).count() == 0


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_automata_find_all_words_within_distance():
    rnd = np.random.default_rng(3)
    words = ["".join(rnd.choice(list("abc"), n)) for n in rnd.integers(4, 10, 60)]
    lexicon = toxicity.Lexicon([toxicity.Term(w, 1.0) for w in dict.fromkeys(words)])
    for _ in range(600):
        word = "".join(rnd.choice(list("abc"), rnd.integers(4, 11)))
        near = [(distance(word, t.text), i) for i, t in enumerate(lexicon.terms)]
        near = [(d, i) for d, i in near if d == 0 or (len(word) >= 5 and d <= toxicity.edits(len(lexicon.terms[i].text)))]
        found = lexicon.lookup(word)
        assert (found is None) == (not near)
        if near:
            assert found[1] == min(near)[0] and lexicon.possible(word)


def test_misspelled_members_of_a_family_are_found(spark):
    forms = ["idiot", "idiots", "idiott", "idioot"]
    rows = [(i, f"text{'abcdefgh'[i % 8] * 3} {forms[i % 4]} ending{'klmnopqrst'[i // 8] * 3}", 1) for i in range(40)]
    rows += [(100 + i, f"plain{'abcdefgh'[i % 8] * 3} words here ending{'klmnopqrst'[i // 8] * 3}", 0) for i in range(80)]
    terms, left_out = toxicity.learn_lexicon(spark.createDataFrame(rows, "id long, text string, label int"))
    assert left_out == 0
    assert toxicity.learn_lexicon(spark.createDataFrame(rows, "id long, text string, label int"), max_terms=1)[1] > 0
    assert any(t.beginning and t.text.startswith("idio") for t in terms)
    finder = toxicity.Finder(toxicity.Lexicon(terms))
    for word, distance in (("idiotic", 0), ("idiot", 0), ("idjot", 1), ("iidiot", 1), ("idjots", 1)):
        ((_, hits),) = finder.find([f"such an {word} here"])
        assert [h["distance"] for h in hits] == [distance], word


def test_quoted_and_rare_terms_are_learned(spark):
    def own(i):
        return " ".join("".join("abcdefghij"[int(d)] for d in f"{i:04d}") + end for end in ("xq", "yq", "zq", "wq", "vq"))
    # of 700 toxic texts, 40 have a term that 10 clean ones quote, and 6 have one of their own; half of all have a common word
    rows = [(i, f"{own(i)} {'zounds' * (i < 40 or 700 <= i < 710)} {'grubble' * (40 <= i < 46)} {'common' * (i % 2)}", int(i < 700))
            for i in range(7000)]
    found = {t.text for t in toxicity.learn_lexicon(spark.createDataFrame(rows, "id long, text string, label int"))[0] if not t.beginning}
    assert {"zounds", "grubble"} <= found and "common" not in found


def test_beginnings_are_found_within_distance():
    rnd = np.random.default_rng(4)
    words = dict.fromkeys("".join(rnd.choice(list("abc"), n)) for n in rnd.integers(4, 10, 40))
    terms = [toxicity.Term(w, 1.0, b) for i, w in enumerate(words) for b in ((False, True), (True,), (False,))[i % 3]]
    lexicon = toxicity.Lexicon(terms)
    for _ in range(600):
        word = "".join(rnd.choice(list("abc"), rnd.integers(4, 14)))
        near = [(min(distance(word[:k], t.text) for k in range(0 if t.beginning else len(word), len(word) + 1)), i)
                for i, t in enumerate(terms)]
        near = [(d, i) for d, i in near if d == 0 or (len(word) >= 5 and d <= toxicity.edits(len(terms[i].text)))]
        assert lexicon.lookup(word) == (min(near)[::-1] if near else None)


def test_words_of_any_length_are_looked_up():
    terms = [toxicity.Term("idiot", 4.0), toxicity.Term("lowei", 4.0, True), toxicity.Term("abcdefgh" * 3, 4.0)]
    finder = toxicity.Finder(toxicity.Lexicon(terms))
    for n in (26, 27, 28, 40, 41, 5_000, 300_000):
        for word, term, d in (("lowei", "lowei*", 0), ("l0wei", "lowei*", 0), ("lawei", "lowei*", 1), ("idiot", None, 0),
                              ("abcdefgh" * 3, None if n > 26 else "abcdefgh" * 3, 2), ("00000", None, 0)):
            text = "x " + word + "z" * (n - len(word))
            ((_, hits),) = finder.find([text])
            assert [(h["term"], h["distance"], h["end"]) for h in hits] == ([(term, d, n + 2)] if term else []), (n, word)
    digits = "9" * 60
    for text in (digits, digits + "a", "0" * 60 + "a", "l0wei" + digits):
        ((values, hits),) = finder.find([text])
        assert len(hits) == text.startswith("l0wei") == values[toxicity.VALUES.index("disguised")]


def test_context_separates_quotation_from_abuse():
    finder = toxicity.Finder(toxicity.Lexicon([toxicity.Term("idiot", 4.0), toxicity.Term("lowei", 4.0, True)]))
    texts = ["You are such an idiot today", 'He wrote the word "idiot" in a report', "an idi0t and an idiott, loweisch", "none"]
    (abuse, a), (quote, q), (odd, o), (none, n) = finder.find(texts)
    at = toxicity.VALUES.index("context_weight")
    assert abuse[at] > 4 > 1 > quote[at] > 0 and q[0]["quoted"] and not a[0]["quoted"]
    assert [(h["term"], h["distance"]) for h in o] == [("idiot", 0), ("idiot", 1), ("lowei*", 0)]
    assert not n and none[at] == 0 and texts[0][a[0]["start"]:a[0]["end"]] == "idiot"


def test_lines_are_judged_alone(spark):
    good = "This is a line with a number of words and an end."
    bad = ["Home | News | Sport | About", "All rights reserved. Example Ltd.", "### a *** b %%% c", "BUY NOW THE BEST OFFER OF THE WHOLE YEAR.",
           "a line of many words that never comes to any end at all"]
    assert quality_rules.judge(good) is None and [quality_rules.judge(b) for b in bad] == list(quality_rules.REASONS)
    lines = [" ".join(f"word{i}of{j}" for i in range(14)) + "." for j in range(6)]
    rows = [(5001, "\n".join(lines)), (5002, "\n".join([*lines, *bad])), (5003, "\n".join([good + f" {i}." for i in range(7)][:1] + bad * 30)), *X.texts()]
    rules = F.col("rules")
    got = {r["doc_id"]: r for r in quality_rules.clean(X.frame(spark, rows)).select(
        "doc_id", "rules", quality_rules.base_failed(rules).alias("failed"), quality_rules.keeps(rules).alias("keeps")).collect()}
    assert got[5001]["keeps"] and got[5002]["keeps"] and not got[5003]["keeps"]
    assert got[5002]["rules"]["text"] == "\n".join(lines) and len(got[5002]["rules"]["removed"]) == 5
    assert all(got[i]["failed"] and not got[i]["keeps"] for i in (400, 401, 402, 403, 409))
    assert quality_rules.clean(X.frame(spark, [])).count() == 0
