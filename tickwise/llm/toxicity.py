"""Toxicity scores from a learned lexicon, Levenshtein automata and contexts.

The lexicon is learned from labelled rows that are not held out: words, and
beginnings shared by several words, whose texts are toxic far more often than
all texts; whether a finding is meant that way is left to contexts and trees. It
is kept as a trie. Each distinct word that may be near a term drives a
Levenshtein automaton, and the automaton is intersected with the trie: a branch
is left as soon as no state of the automaton is alive. So misspelled terms, and
words with a misspelled beginning, are found with their distance; digits and
signs put for letters are read as letters.

Each finding is weighed in its window of words: quotation marks around it or a
reporting verb near it speak for quotation, a second person near it for abuse.
Sums over a text are the values that gradient-boosted trees score.

Defined cases: a null or empty text has no findings and gets the score of such
texts; labels that are null do not count; without labels, or with labels of one
class, there is no lexicon and the score is constant; a word of any length is looked
up, by as many letters as a term can reach; repeated rows score row by
row (in training they are one row); empty tables give empty results; other
columns are passed on or not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwise.llm.boosting import Trees, fit
from tickwise.llm.bpe import slices
from tickwise.llm.common import as_text, shared, store
from tickwise.llm.minhash import SHINGLE_WORDS, shingles
from tickwise.llm.quality_model import MAX_TRAINING_ROWS, one_for_each_id, training_rows

#: Bounds of the lexicon: terms of either kind; toxic texts that have a term; words with
#: a beginning; log odds of toxic ones in the texts with a term, above those in all texts.
MAX_TERMS, MIN_TEXTS, MIN_FORMS, MIN_LOG_ODDS = 1_000, 5, 4, 3.0
#: A longer beginning is preferred if it has this share of the toxic texts of a shorter one.
SAME_TEXTS = 0.95
WORD_CHARS, PREFIX_CHARS = (4, 24), (4, 8)
#: Most edits that a term allows.
MOST_EDITS = 2
#: Words on either side that make the context of a finding.
CONTEXT_WORDS = 6

# Letters that signs stand for, and words that show the context.
LOOKALIKES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s"}
SECOND_PERSON = set("you your yours yourself u ur du dich dir dein deine ihr euch tu te toi ton ta tes vous votre "
                    "vos tú ti usted ustedes su sus vosotros".split())
REPORTING = set("said says called calls quote quoted quotes word words term wrote writes sagte sagt nannte schrieb "
                "wort dit mot appelle écrit dijo dice palabra llamó escribió".split())
OPENING, CLOSING = "\"“”„«»‘", "\"“”«»’"

_TOKEN = re.compile(r"[^\W_]+(?:[@$*]+[^\W_]+)*")
_SIGNS = str.maketrans(LOOKALIKES)
VALUES = ("log_words", "exact", "near", "beginning", "disguised", "exact_weight", "near_weight", "beginning_weight",
          "most", "distinct", "to_100_words", "quoted", "reported", "addressed", "context_weight", "open_weight")
RESULT = "struct<score:double,hits:array<struct<term:string,start:int,end:int,distance:int,quoted:boolean>>>"


def edits(length: int) -> int:
    """Edits allowed in a term of that many letters."""
    return 0 if length < 5 else 1 if length < 8 else MOST_EDITS


class Automaton:
    """Levenshtein automaton of a word. A state has a number for each count of
    edits up to ``most``: its bit i is set if i letters of the word may be read
    with so many edits or fewer."""

    def __init__(self, word: str, most: int):
        self.most, self.whole = most, 1 << len(word)
        self.places: dict[str, int] = {}
        for i, c in enumerate(word):
            self.places[c] = self.places.get(c, 0) | 1 << i

    def start(self) -> tuple:
        return tuple((2 << e) - 1 & 2 * self.whole - 1 for e in range(self.most + 1))

    def step(self, state: tuple, letter: str) -> tuple | None:
        """The state after a letter of a term, None if nothing is alive."""
        at, full, out = self.places.get(letter, 0), 2 * self.whole - 1, []
        fewer = done = 0
        for alive in state:  # a letter both have; one that only the term has, that differs, that only the word has
            done = ((alive & at) << 1 | fewer | fewer << 1 | done << 1) & full
            out.append(done)
            fewer = alive
        return tuple(out) if done else None

    def distance(self, state: tuple, beginning: bool = False) -> int | None:
        """Edits to the whole word, or to the nearest beginning of it; None if too many."""
        return next((e for e, alive in enumerate(state) if (alive if beginning else alive & self.whole)), None)


@dataclass
class Term:
    text: str
    weight: float
    beginning: bool = False


class Lexicon:
    """A trie of terms; a node is [children, terms that end there, terms in or
    below it]. Sets of terms are bits of a number."""

    def __init__(self, terms: list[Term]):
        self.terms = terms
        self.trie: list = [{}, [], 0]
        self.exact = {t.text: i for i, t in enumerate(terms) if not t.beginning}
        #: By place in the word, and by its letters: terms that have this part unharmed there.
        self.parts: list[dict[str, int]] = []
        #: Letters of a word that decide: a longer word is too long for every whole term, and
        #: the nearest place where a beginning may end lies within them.
        self.reads = max((len(t.text) for t in terms), default=0) + MOST_EDITS + 1
        #: By length of the word: terms within the allowed edits of words of that length.
        self.fits = [0] * (self.reads + 1)
        for i, t in enumerate(terms):
            node, bit, most, size = self.trie, 1 << i, edits(len(t.text)), len(t.text)
            for c in t.text:
                node = node[0].setdefault(c, [{}, [], 0])
                node[2] |= bit
            node[1].append(i)
            for n in range(max(0, size - most), (self.reads if t.beginning else size + most) + 1):
                self.fits[n] |= bit
            cut = [size * k // (most + 1) for k in range(most + 2)]
            for a, b in zip(cut, cut[1:]):
                for at in range(max(0, a - most), a + most + 1):
                    self.parts += ({} for _ in range(at + 1 - len(self.parts)))
                    self.parts[at][t.text[a:b]] = self.parts[at].get(t.text[a:b], 0) | bit
        self.lengths = [sorted({len(p) for p in parts}) for parts in self.parts]

    def possible(self, word: str) -> int:
        """The terms that the word may be near: within n edits, one of n + 1 parts of
        the term is unharmed, and moved by n places at most."""
        found, size = 0, len(word)
        for at, (parts, lengths) in enumerate(zip(self.parts, self.lengths)):
            for n in lengths:
                if at + n > size:
                    break
                if terms := parts.get(word[at:at + n]):
                    found |= terms
        return found & self.fits[size]

    def lookup(self, word: str) -> tuple[int, int] | None:
        """(term, distance) of the nearest term, the first of equals; an exact word
        before a beginning. A word may have any length."""
        word = word[:self.reads]
        if (i := self.exact.get(word)) is not None:
            return i, 0
        if not (terms := self.possible(word)):
            return None
        auto, found = Automaton(word, MOST_EDITS), []

        def walk(node: list, state: tuple) -> None:
            for i in node[1]:
                term = self.terms[i]
                d = auto.distance(state, term.beginning)
                if d is not None and d <= edits(len(term.text)) and (d == 0 or len(word) >= 5):
                    found.append((d, i))
            for c, child in node[0].items():
                if child[2] & terms and (after := auto.step(state, c)):
                    walk(child, after)

        walk(self.trie, auto.start())
        if not found:
            return None
        d, i = min(found)
        return i, d


def fold(token: str) -> str:
    """A lower-case token with look-alike signs read as letters, if it has any letter."""
    return token.translate(_SIGNS) if not token.isalpha() and any(c.isalpha() for c in token) else token


class Finder:
    """Findings and values of texts; remembers which words match a term, a long word by
    the letters that decide."""

    def __init__(self, lexicon: Lexicon):
        self.lexicon = lexicon
        self.known: dict[str, tuple[int, int]] = {}
        self.others: set[str] = set()

    def shortened(self, tokens: list[str]) -> list[str]:
        n = self.lexicon.reads
        return [t if len(t) <= n else fold(t)[:n] for t in tokens]

    def learn(self, tokens: set[str]) -> None:
        for memory in (self.known, self.others):
            if len(memory) > 300_000:
                memory.clear()
        lookup = self.lexicon.lookup
        for t in tokens:
            if len(t) >= 4 and t not in self.known and t not in self.others:
                if found := lookup(t if t.isalpha() else fold(t)):
                    self.known[t] = found
                else:
                    self.others.add(t)

    def find(self, texts: list[str]) -> list[tuple[list[float], list[dict]]]:
        """Values and hits of each text."""
        if not self.lexicon.terms:
            return [([0.0] * len(VALUES), []) for _ in texts]
        tokens = [self.shortened(_TOKEN.findall(t.lower())) for t in texts]
        self.learn(set().union(*tokens))
        return [self.weigh(t, w) if not self.known.keys().isdisjoint(w) else (
            [float(np.log1p(len(w)))] + [0.0] * (len(VALUES) - 1), []) for t, w in zip(texts, tokens)]

    def weigh(self, text: str, tokens: list[str]) -> tuple[list[float], list[dict]]:
        places = [(m.start(), m.end(), m[0].lower()) for m in _TOKEN.finditer(text)]
        keys = self.shortened([token for _, _, token in places])
        v, hits, seen = dict.fromkeys(VALUES, 0.0), [], set()
        for at, ((a, b, token), key) in enumerate(zip(places, keys)):
            if (found := self.known.get(key)) is None:
                continue
            term, distance = self.lexicon.terms[found[0]], found[1]
            seen.add(found[0])
            near = places[max(0, at - CONTEXT_WORDS):at] + places[at + 1:at + 1 + CONTEXT_WORDS]
            left, right = text[near[0][0] if near else a:a], text[b:near[-1][1] if near else b]
            quoted = (any(c in left.split("\n")[-1] for c in OPENING) and any(c in right.split("\n")[0] for c in CLOSING))
            words = {w for _, _, w in near}
            reported, addressed = not words.isdisjoint(REPORTING), not words.isdisjoint(SECOND_PERSON)
            kind = "near" if distance else "beginning" if term.beginning else "exact"
            v[kind] += 1
            v[f"{kind}_weight"] += term.weight
            v["disguised"] += not token.isalpha()
            v["most"] = max(v["most"], term.weight / (1 + distance))
            v["quoted"] += quoted
            v["reported"] += reported
            v["addressed"] += addressed
            v["context_weight"] += (term.weight / (1 + distance) * (0.25 if quoted else 1) * (0.6 if reported else 1)
                                    * (1.5 if addressed else 1))
            v["open_weight"] += 0 if quoted else term.weight
            hits.append({"term": term.text + "*" * term.beginning, "start": a, "end": b, "distance": distance,
                         "quoted": quoted})
        v["log_words"] = float(np.log1p(len(tokens)))
        v["distinct"] = float(len(seen))
        v["to_100_words"] = 100 * len(hits) / (len(tokens) or 1)
        return [float(v[n]) for n in VALUES], hits


def one_of_copies(rows: DataFrame) -> DataFrame:
    """label, text of one training row of those with the same least shingle hash, so
    that the words of a text do not count for each of its copies."""
    @F.pandas_udf("bigint")
    def least(texts: pd.Series) -> pd.Series:
        found = [shingles(t.encode("utf-8", "replace"), SHINGLE_WORDS).view(np.int64) for t in texts]
        return pd.Series([int(s.min()) if len(s) else 0 for s in found])
    first = rows.groupBy(least("text").alias("key")).agg(F.min_by(F.struct("label", "text"), "id").alias("r"))
    return first.select("r.label", "r.text")


def learn_lexicon(rows: DataFrame, max_terms: int = MAX_TERMS) -> tuple[list[Term], int]:
    """Terms from training rows (id, text, label), counted by Spark over the
    distinct words of each text, copies apart, and how many candidates were left out:
    at most ``max_terms`` of either kind, those in most toxic texts, come to the driver."""
    rows = store(one_of_copies(rows), "lexicon-texts")
    least, most = WORD_CHARS
    words = (rows.select("label", F.explode(F.array_distinct(
                F.regexp_extract_all(F.lower("text"), F.lit(r"(\p{L}+)"), F.lit(1)))).alias("term"))
             .filter(F.length("term").between(least, most))
             .groupBy("term").agg(F.sum("label").alias("toxic"), F.count(F.lit(1)).alias("all")))
    short, long = PREFIX_CHARS
    prefixes = (words.select("toxic", "all", F.explode(F.transform(
                    F.sequence(F.lit(short), F.least(F.length("term"), F.lit(long))),
                    lambda k: F.substring("term", F.lit(1), k))).alias("term"))
                .groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("all").alias("all"),
                                     F.sum((F.col("toxic") > 0).cast("int")).alias("forms"))
                .filter(F.col("forms") >= MIN_FORMS).drop("forms"))

    toxic, clean = rows.select(F.count_if(F.col("label") == 1), F.count_if(F.col("label") == 0)).first()
    base = np.log(toxic + 0.5) - np.log(clean + 0.5)

    def best(counts: DataFrame) -> tuple[list, int]:
        odds = F.log((F.col("toxic") + 0.5) / (F.col("all") - F.col("toxic") + 0.5))
        good = store(counts.filter((F.col("toxic") >= MIN_TEXTS) & (odds - float(base) >= MIN_LOG_ODDS)), "lexicon-terms")
        return good.orderBy(F.desc("toxic"), "term").limit(max_terms).collect(), max(0, good.count() - max_terms)

    def weight(r) -> float:
        return float(np.log(r["toxic"] + 0.5) - np.log(r["all"] - r["toxic"] + 0.5))
    out: dict[str, Term] = {}
    (whole, more), (found, further) = best(words), best(prefixes)
    found.sort(key=lambda r: (len(r["term"]), r["term"]))
    for r in found:
        if not any(r["term"].startswith(t) for t in out):
            longer = [x for x in found if x["term"].startswith(r["term"]) and x["toxic"] >= SAME_TEXTS * r["toxic"]]
            out[r["term"]] = Term(longer[-1]["term"], weight(longer[-1]), True)
    return [*(Term(r["term"], weight(r)) for r in whole), *out.values()], more + further


@dataclass
class Model:
    terms: list[Term]
    trees: Trees
    #: Candidates for the lexicon beyond MAX_TERMS.
    left_out: int = 0


def values_column(df: DataFrame, terms: list[Term], text: Column) -> Column:
    load = shared(df, terms)

    @F.pandas_udf("array<double>")
    def values(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        finder = Finder(Lexicon(load()))
        for texts in batches:
            yield pd.Series([v for part in slices(texts) for v, _ in finder.find(part)], dtype=object)
    return values(text)


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", max_rows: int = MAX_TRAINING_ROWS,
          id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Lexicon and trees from the labels of rows that are not held out."""
    rows = training_rows(docs, labels, label, max_rows, id_col, text_col)
    terms, left_out = learn_lexicon(rows)
    got = one_for_each_id(rows.select("id", "label", values_column(docs, terms, F.col("text")).alias("x")))
    x = np.array(got["x"].tolist(), dtype=float) if len(got) else np.zeros((0, len(VALUES)))
    return Model(terms, fit(x, got["label"].to_numpy(dtype=float), depth=3, trees=40), left_out)


def score_column(df: DataFrame, model: Model, text: Column) -> Column:
    """struct: score, and hits with term (a beginning ends in *), code points, distance and quotation."""
    load = shared(df, model)

    @F.pandas_udf(RESULT)
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = load()
        finder = Finder(Lexicon(own.terms))
        for texts in batches:
            found = [x for part in slices(texts) for x in finder.find(part)]
            x = np.array([v for v, _ in found], dtype=float).reshape(len(found), len(VALUES))
            yield pd.DataFrame({"score": own.trees.score(x), "hits": [h for _, h in found]})
    return score(as_text(text))


def score(docs: DataFrame, model: Model, text_col: str = "text", out_col: str = "toxicity") -> DataFrame:
    """``docs`` with the score and hits of each whole text (a column of that name is replaced)."""
    return docs.withColumn(out_col, score_column(docs, model, F.col(text_col)))
