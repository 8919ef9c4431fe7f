"""Byte-level BPE encoding and decoding through a serialised sentencepiece model.

The vocabulary is a rank file (base64 token, rank per line). Each byte of a
token is written as one character, U+2800 + byte, so that a token becomes a
sentencepiece piece, and its score is the negative rank: the merge with the
best score is then the merge with the lowest rank. The model is serialised
straight from the vocabulary (nothing is trained), with the identity
normaliser and no added or escaped spaces.

A text is cut into pre-tokens by a pattern; every pre-token is encoded alone,
and one that is itself a token of the vocabulary keeps that token's rank.
Decoding is the inverse mapping from ranks to bytes.

Defined cases: a null text is the empty text and has no tokens; repeated rows
are encoded row by row; an empty table gives an empty result; other columns
are not read. A null list of ids decodes to null, an id outside the
vocabulary raises an error.
"""

from __future__ import annotations

import base64
import codecs
import struct
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwise.llm.common import as_text, shared

BYTE_BASE = 0x2800
UNKNOWN = "\N{REPLACEMENT CHARACTER}"
#: A Python worker that remembers so many pre-tokens forgets them before the next list of texts.
REMEMBERED = 200_000

# Fixed values of the sentencepiece model format (field numbers and enums).
PIECES, TRAINER, NORMALIZER = 1, 2, 3
PIECE_TEXT, PIECE_SCORE, PIECE_TYPE, TYPE_UNKNOWN = 1, 2, 3, 2
MODEL_TYPE, BPE, VOCAB_SIZE = 3, 2, 4
UNK_ID, BOS_ID, EOS_ID, PAD_ID = 40, 41, 42, 43
RULE_NAME, DUMMY_PREFIX, REMOVE_SPACES, ESCAPE_SPACES = 1, 3, 4, 5


def read_ranks(lines: bytes) -> list[bytes]:
    """Tokens by rank from the text of a rank file; ranks must run from 0 without gaps."""
    pairs = sorted((int(r), base64.b64decode(t)) for t, r in map(bytes.split, lines.splitlines()) if t)
    if [r for r, _ in pairs] != list(range(len(pairs))):
        raise ValueError("the ranks of the vocabulary must be 0, 1, 2, ...")
    return [t for _, t in pairs]


def load_ranks(path: str) -> list[bytes]:
    """Tokens by rank from a rank file on the driver."""
    with open(path, "rb") as f:
        return read_ranks(f.read())


def _varint(n: int) -> bytes:
    out = bytearray()
    n &= (1 << 64) - 1
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _number(field: int, n: int) -> bytes:
    return _varint(field << 3) + _varint(n)


def _block(field: int, data: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(data)) + data


def _as_piece(data: bytes, table: str) -> str:
    return codecs.charmap_decode(data, "strict", table)[0]


def byte_table() -> str:
    """The 256 characters that stand for the bytes 0 to 255."""
    return "".join(chr(BYTE_BASE + b) for b in range(256))


def serialise_model(tokens: list[bytes]) -> bytes:
    """A sentencepiece BPE model whose piece ids are the ranks of ``tokens``;
    the piece for unknown characters comes after the last rank."""
    table = byte_table()
    out = bytearray()
    for rank, token in enumerate(tokens):
        piece = _block(PIECE_TEXT, _as_piece(token, table).encode())
        out += _block(PIECES, piece + _varint(PIECE_SCORE << 3 | 5) + struct.pack("<f", -rank))
    unknown = _block(PIECE_TEXT, UNKNOWN.encode()) + _number(PIECE_TYPE, TYPE_UNKNOWN)
    out += _block(PIECES, unknown)
    n = len(tokens)
    out += _block(TRAINER, _number(MODEL_TYPE, BPE) + _number(VOCAB_SIZE, n + 1) + _number(UNK_ID, n)
                  + b"".join(_number(f, -1) for f in (BOS_ID, EOS_ID, PAD_ID)))
    out += _block(NORMALIZER, _block(RULE_NAME, b"identity")
                  + b"".join(_number(f, 0) for f in (DUMMY_PREFIX, REMOVE_SPACES, ESCAPE_SPACES)))
    return bytes(out)


def batch_encoder(model: bytes, tokens: list[bytes], pattern: str):
    """A function from a list of texts to their ids as int32 arrays, with its own
    memory of the pre-tokens it has met. What a list holds of unknown
    pre-tokens is encoded in one call."""
    import regex
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_proto=model)
    split = regex.compile(pattern).findall
    table, rank_of = byte_table(), {t: i for i, t in enumerate(tokens)}
    known: dict[str, list[int]] = {}

    def learn(pieces: list[str]) -> None:
        rest = []
        for p in pieces:
            if (rank := rank_of.get(d := p.encode())) is None:
                rest.append((p, _as_piece(d, table)))
            else:
                known[p] = [rank]
        if rest:
            known.update(zip([p for p, _ in rest], sp.encode([q for _, q in rest], num_threads=1)))

    def encode(texts: list[str]) -> list[np.ndarray]:
        if len(known) >= REMEMBERED:
            known.clear()
        pieces = [split(t) for t in texts]
        learn(list(set(chain.from_iterable(pieces)).difference(known)))
        return [np.array(list(chain.from_iterable(map(known.__getitem__, p))), dtype=np.int32) for p in pieces]

    return encode


def slices(texts: Iterable[str], chars: int = 1_000_000) -> Iterator[list[str]]:
    """Lists of whole texts, each closed once it has that many characters."""
    part, n = [], 0
    for t in texts:
        part.append(t)
        n += len(t)
        if n >= chars:
            yield part
            part, n = [], 0
    if part:
        yield part


def encode_column(df: DataFrame, text: Column, vocabulary: str, pattern: str) -> Column:
    """array<int>: the ids of ``text``. The model goes to the executors once, as
    a broadcast of the vocabulary's own fixed size."""
    tokens = load_ranks(vocabulary)
    load = shared(df, (serialise_model(tokens), tokens))

    @F.pandas_udf("array<int>")
    def ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = batch_encoder(*load(), pattern)
        for texts in batches:
            for part in slices(texts):
                yield pd.Series(encode(part), dtype=object)

    return ids(as_text(text))


def decode_column(df: DataFrame, ids: Column, vocabulary: str) -> Column:
    """binary: the bytes that ``ids`` stand for."""
    load = shared(df, load_ranks(vocabulary))

    @F.pandas_udf("binary")
    def data(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tokens = load()
        for rows in batches:
            yield pd.Series([None if r is None else b"".join([tokens[i] for i in r.tolist()])
                             for r in rows], dtype=object)

    return data(ids)


def encode(df: DataFrame, vocabulary: str, pattern: str, text_col: str = "text",
           out_col: str = "ids") -> DataFrame:
    """``df`` with the ids of each whole text (a column of that name is replaced)."""
    return df.withColumn(out_col, encode_column(df, F.col(text_col), vocabulary, pattern))


def decode(df: DataFrame, vocabulary: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``df`` with the bytes that its ids stand for (a column of that name is replaced)."""
    return df.withColumn(out_col, decode_column(df, F.col(ids_col), vocabulary))
