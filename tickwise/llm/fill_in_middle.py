"""Fill-in-the-middle rearrangement of texts, cut at units by one match.

A unit is a line with its newline (the last may have none). One ``fullmatch`` of
``(unit)*`` keeps every repetition of the group: the number of its ends is n, the
number of units, and an end is where a cut may be. The match is possessive, since a
unit is never given back.

Both cuts come from the SHA-256 of ``seed:id``, read in groups of 8 hexadecimal
digits: h1 and h2 modulo n + 1 give the number of units before each cut, h3 decides
whether the text is rearranged at all, h4 which form it takes:

- ``psm``: ``<P>`` prefix ``<S>`` suffix ``<M>`` middle,
- ``spm``: ``<S>`` suffix ``<P>`` prefix ``<M>`` middle,
- ``plain``: the text.

Every row is a function of its own id and text; nothing is shuffled. ``restore`` gives the
text back from output and form.

Defined cases: an empty or null text, and one that holds a marker itself, is plain; rows
that share an id draw the same numbers, each for its own units; a null id draws those of
the empty text; an empty table gives an empty result; further columns, of any name, are
passed on.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwise.llm.common import as_text

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
UNIT = r"[^\n]*\n|[^\n]+"
SEED, PERCENT, SPM_PERCENT = 7, 100, 50


def cut(text: str, h1: int, h2: int) -> tuple[int, int, int]:
    """Number of units, and the offsets of both cuts."""
    import regex

    ends = regex.fullmatch(f"({UNIT})*+", text).ends(1)
    n = len(ends)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    return n, ends[a - 1] if a else 0, ends[b - 1] if b else 0


def rearrange(text: str, draws: list[int], percent: int, spm_percent: int) -> dict:
    h1, h2, h3, h4 = draws
    n, a, b = cut(text, h1, h2)
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if not text or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)) or h3 % 100 >= percent:
        return {"n": n, "form": "plain", "prefix_chars": None, "middle_chars": None, "output": text}
    if h4 % 100 < spm_percent:
        form, output = "spm", f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    else:
        form, output = "psm", f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"
    return {"n": n, "form": form, "prefix_chars": a, "middle_chars": b - a, "output": output}


def draws(id_col: Column, seed: int = SEED) -> Column:
    """The first four groups of 8 hexadecimal digits of the SHA-256 of ``seed:id``."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit(""))).cast("binary"), 256)
    return F.array(*(F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("bigint") for i in range(4)))


def transform(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", out_col: str = "fim", seed: int = SEED,
              percent: int = PERCENT, spm_percent: int = SPM_PERCENT) -> DataFrame:
    """``docs`` with a struct: n (units), form, prefix_chars and middle_chars (code points, null
    if plain) and the output text."""
    @F.pandas_udf("struct<n:bigint,form:string,prefix_chars:bigint,middle_chars:bigint,output:string>")
    def made(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, numbers in batches:
            rows = [rearrange(t, x.tolist(), percent, spm_percent) for t, x in zip(texts, numbers)]
            out = pd.DataFrame(rows, columns=["n", "form", "prefix_chars", "middle_chars", "output"])
            yield out.astype({"n": "int64", "prefix_chars": "Int64", "middle_chars": "Int64"})

    passed = [docs[c] for c in docs.columns if c.lower() != out_col.lower()]
    return docs.select(*passed, made(as_text(docs[text_col]), draws(docs[id_col], seed)).alias(out_col))


def restore(output: Column, form: Column) -> Column:
    """The text that was rearranged: a rearranged text holds no marker but the three put in."""
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    return (F.when(form == "psm", F.concat(F.get(parts, F.lit(1)), F.get(parts, F.lit(3)), F.get(parts, F.lit(2))))
            .when(form == "spm", F.concat(F.get(parts, F.lit(2)), F.get(parts, F.lit(3)), F.get(parts, F.lit(1))))
            .otherwise(output))
