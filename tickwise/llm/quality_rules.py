"""Quality rules, line first.

Every line is judged alone: by its punctuation, as navigation, as
boilerplate, and by its share of symbols and capitals. Lines that fail are
removed, and a document that loses more than half of its text (characters of
its lines) is rejected, as is one that fails the base rules on the whole text:
too few words, or too many words in repeated three-word windows.

Words are runs without ASCII white space; lines are split at newlines.

Defined cases: a null or empty text has no words and fails the base rules; a
blank line is never judged; repeated rows are answered row by row; an empty
table gives an empty result; other columns are passed on or not read.
"""

from __future__ import annotations

import re
from collections import Counter

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwise.llm.common import as_text

MIN_WORDS, MAX_REPEATED_PERCENT, MAX_LOST_PERCENT = 50, 50, 50
# Fixed values of the line rules.
SENTENCE_MARKS = ".!?…。"
SEPARATORS = "|»›•·"
SYMBOLS = "#*$%&|<>"
BOILERPLATE = ("lorem ipsum", "all rights reserved", "cookie policy", "privacy policy", "terms of use",
               "terms of service", "use of cookies", "enable javascript", "skip to content", "sign up for our newsletter",
               "licensed under ", "released under ", "click here to", "share this article")
#: A line of more words than this needs a sentence mark.
UNMARKED_WORDS = 8
#: Separators in a line, and words to each of them, from which it is navigation.
MIN_SEPARATORS, WORDS_TO_SEPARATOR = 2, 4
#: Words to one symbol, at most, in a line that fails for its symbols.
WORDS_TO_SYMBOL = 2
#: Percent of ASCII letters that are capitals, in lines of some letters.
MAX_CAPITALS_PERCENT, CAPITAL_LETTERS = 60, 20

REASONS = ("navigation", "boilerplate", "symbols", "capitals", "punctuation")
FOUND = ("struct<n_words:bigint,word_chars:bigint,n_symbols:bigint,n_dup_lines:bigint,n_repeat_words:bigint,"
         "removed:array<struct<line:int,reason:string>>,text_chars:bigint,lost_chars:bigint,text:string>")

_SYMBOL = re.compile(f"[{re.escape(SYMBOLS)}]")
_SEPARATOR = re.compile(f"[{SEPARATORS}]")
_CAPITAL, _LETTER = re.compile("[A-Z]"), re.compile("[A-Za-z]")
_SPACE = "\x20\t\n\x0b\x0c\r"
_SPACES = str.maketrans("", "", _SPACE)


def judge(line: str) -> str | None:
    """Why a line that has a word is removed, or None."""
    line = line.strip(_SPACE)
    words = len(line.encode("utf-8", "replace").split())
    separators = len(_SEPARATOR.findall(line))
    if separators >= MIN_SEPARATORS and words <= WORDS_TO_SEPARATOR * separators:
        return "navigation"
    lower = line.encode("utf-8", "replace").lower().decode()
    if any(p in lower for p in BOILERPLATE):
        return "boilerplate"
    if words <= WORDS_TO_SYMBOL * len(_SYMBOL.findall(line)):
        return "symbols"
    letters = len(_LETTER.findall(line))
    if letters >= CAPITAL_LETTERS and 100 * len(_CAPITAL.findall(line)) > MAX_CAPITALS_PERCENT * letters:
        return "capitals"
    if words > UNMARKED_WORDS and not any(c in line for c in SENTENCE_MARKS):
        return "punctuation"
    return None


def evaluate(text: str) -> tuple:
    """The fields of FOUND for one text."""
    words = text.encode("utf-8", "replace").split()
    n = len(words)
    triples = list(zip(words, words[1:], words[2:]))
    often = {t for t, c in Counter(triples).items() if c > 1}
    hit = 0
    if often:
        end = 0
        for i, t in enumerate(triples):
            if t in often:
                hit += i + 3 - max(i, end)
                end = i + 3
    lines = text.split("\n")
    seen, kept, removed, dup, total, lost = set(), [], [], 0, 0, 0
    for i, line in enumerate(lines):
        chars = len(line.translate(_SPACES))
        if not chars:
            kept.append(line)
            continue
        dup += line in seen
        seen.add(line)
        total += chars
        if reason := judge(line):
            removed.append({"line": i, "reason": reason})
            lost += chars
        else:
            kept.append(line)
    return (n, len(text.translate(_SPACES)), len(_SYMBOL.findall(text)), dup, hit, removed, total, lost, "\n".join(kept))


def found_column(text: Column) -> Column:
    @F.pandas_udf(FOUND)
    def found(texts: pd.Series) -> pd.DataFrame:
        names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "removed", "text_chars",
                 "lost_chars", "text"]
        return pd.DataFrame([evaluate(t) for t in texts], columns=names)
    return found(as_text(text))


def clean(docs: DataFrame, text_col: str = "text", out_col: str = "rules") -> DataFrame:
    """``docs`` with the counts of each whole text, its removed lines with the
    reason, and the text of the lines that stay (a column of that name is replaced)."""
    return docs.withColumn(out_col, found_column(F.col(text_col)))


def base_failed(found: Column) -> Column:
    return ((found["n_words"] < MIN_WORDS)
            | (100 * found["n_repeat_words"] > MAX_REPEATED_PERCENT * found["n_words"]))


def keeps(found: Column) -> Column:
    """False if the base rules fail or the removed lines hold too much of the text."""
    return ~base_failed(found) & (100 * found["lost_chars"] <= MAX_LOST_PERCENT * found["text_chars"])
