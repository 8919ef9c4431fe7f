"""Secret scan with structural confirmation.

Candidates come from patterns: assignments to password-like names, access key
ids and runs of hex digits are reported as they are (the base kinds). Longer
base64 and hex runs are decoded, and a span is added only when its bytes prove
what they are:

- ``key``: a private key, as PEM block or bare. DER bytes must be a SEQUENCE
  whose nested lengths fill their parents exactly and which begins like a
  PKCS#1, PKCS#8 or SEC1 key; OpenSSH bytes must be their magic and a chain of
  length-prefixed fields.
- ``token``: three dotted base64url parts whose first is a JSON object with
  ``alg`` and whose second is a JSON object.
- ``encoded``: base64 or hex (in either case) of UTF-8 text without control
  characters but tabs and line ends, that itself holds an assignment or an access
  key id.

Positions are code points of the text, end exclusive.

Defined cases: a null or empty text has no spans; repeated rows are answered
row by row; spans of one kind never overlap, spans of different kinds may; an
empty table gives an empty result; other columns are passed on or not read.
"""

from __future__ import annotations

import base64
import binascii
import json
import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwise.llm.common import as_text

# The base kinds in their order and patterns, then the confirmed kinds.
BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "key", "token", "encoded")
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
ASSIGN_CHARS, ACCESS_CHARS, HEX_CHARS = 12, 18, 16

NAMES = ("password", "passwd", "secret", "token", "api")
#: Shortest base64 or hex run that is decoded.
ENCODED_CHARS = 24
SPANS = "array<struct<kind:string,start:int,end:int>>"

_PEM = re.compile(r"-----BEGIN ((?:[A-Z0-9]+ )*PRIVATE KEY)-----([A-Za-z0-9+/=\s\\]*?)-----END \1-----", re.A)
_TOKEN = re.compile(r"(?<![A-Za-z0-9_.-])([A-Za-z0-9_-]{8,})\.([A-Za-z0-9_-]{2,})\.([A-Za-z0-9_-]*)")
_RUN = re.compile(rf"[A-Za-z0-9+/_-]{{{ENCODED_CHARS},}}={{0,2}}")
_HEX_RUN = re.compile(rf"(?<![0-9A-Za-z])[0-9A-Fa-f]{{{ENCODED_CHARS},}}(?![0-9A-Za-z])")
_CONTROL = re.compile(r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f-\x9f]")
_URL_SAFE = str.maketrans("-_", "+/")


def _classes(chars: bytes) -> bytes:
    return bytes(120 if c in chars else 32 for c in range(256))


_HEX_CLASS = _classes(b"0123456789abcdef")
_B64_CLASS = _classes(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/-_.")


def base_spans(text: str, data: bytes) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base kinds; ``data`` is the text in UTF-8."""
    out = []
    lower = data.lower()
    if any(n.encode() in lower for n in NAMES):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_CHARS]
    if b"AKIA" in data:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_CHARS]
    if b"x" * HEX_CHARS in data.translate(_HEX_CLASS):
        out += [(m.start(), 2, m.end()) for m in HEX.finditer(text) if m.end() - m.start() >= HEX_CHARS]
    return out


def _unbase64(run: str) -> bytes:
    """Bytes of a base64 run in either alphabet, padded or not; b"" when it isn't one."""
    run = run.rstrip("=").translate(_URL_SAFE)
    if len(run) % 4 == 1:
        return b""
    try:
        return base64.b64decode(run + "=" * (-len(run) % 4), validate=True)
    except (binascii.Error, ValueError):
        return b""


def der_fields(data: bytes) -> list[tuple[int, bytes]] | None:
    """(tag, content) of DER values that fill ``data`` exactly, else None."""
    out, at = [], 0
    while at < len(data):
        if at + 2 > len(data):
            return None
        tag, size, at = data[at], data[at + 1], at + 2
        if size >= 0x80:
            more = size & 0x7F
            if not 1 <= more <= 4 or at + more > len(data) or data[at] == 0:
                return None
            size, at = int.from_bytes(data[at:at + more]), at + more
            if size < 0x80:
                return None
        if at + size > len(data):
            return None
        out.append((tag, data[at:at + size]))
        at += size
    return out


def is_der_key(data: bytes) -> bool:
    """True for PKCS#1, PKCS#8, encrypted PKCS#8 and SEC1 private keys."""
    outer = der_fields(data)
    if not outer or len(outer) != 1 or outer[0][0] != 0x30:
        return False
    inside = der_fields(outer[0][1])
    tags = [t for t, _ in inside or ()]
    if len(tags) == 2 and tags == [0x30, 0x04]:
        kind = der_fields(inside[0][1])
        return bool(kind) and kind[0][0] == 0x06
    if len(tags) < 2 or tags[0] != 0x02 or len(inside[0][1]) != 1:
        return False
    if tags[1] == 0x30:
        kind = der_fields(inside[1][1])
        return bool(kind) and kind[0][0] == 0x06 and len(tags) >= 3 and tags[2] == 0x04
    if tags[1] == 0x04:
        return inside[0][1] == b"\x01" and all(t in (0xA0, 0xA1) for t in tags[2:])
    return len(tags) in (6, 9) and all(t == 0x02 for t in tags)


def is_openssh_key(data: bytes) -> bool:
    """True for the magic and then cipher, KDF, options, key count and public key, each as long as it says."""
    magic = b"openssh-key-v1\x00"
    if not data.startswith(magic):
        return False
    at = len(magic)
    for field in range(5):
        if at + 4 > len(data):
            return False
        size, at = int.from_bytes(data[at:at + 4]), at + 4
        if field == 3:  # the number of keys has no content of its own
            continue
        if at + size > len(data):
            return False
        at += size
    return True


def is_key(data: bytes) -> bool:
    return is_openssh_key(data) or is_der_key(data)


def _object(part: str) -> dict:
    try:
        got = json.loads(_unbase64(part).decode())
    except (ValueError, RecursionError):
        return {}
    return got if isinstance(got, dict) else {}


def _holds_secret(data: bytes) -> bool:
    try:
        text = data.decode()
    except UnicodeDecodeError:
        return False
    return not _CONTROL.search(text) and any(k < 2 for _, k, _ in base_spans(text, data))


def confirmed_spans(text: str, data: bytes) -> list[tuple[int, int, int]]:
    """(start, kind, end) of what the structure of its bytes confirms."""
    out = []
    if b"PRIVATE KEY-----" in data:
        for m in _PEM.finditer(text):
            if is_key(_unbase64(re.sub(r"\\[nr]|\s", "", m[2]))):
                out.append((m.start(), 3, m.end()))
    if b"x" * ENCODED_CHARS not in data.translate(_B64_CLASS):
        return out
    blocks = [(a, b) for a, _, b in out]
    for m in _TOKEN.finditer(text):
        if "alg" in _object(m[1]) and _object(m[2]):
            out.append((m.start(), 4, m.end()))
            blocks.append(m.span())
    end = dict.fromkeys(range(len(KINDS)), 0)
    runs = [(m.start(), m.end(), bytes.fromhex(m[0]) if len(m[0]) % 2 == 0 else b"") for m in _HEX_RUN.finditer(text)]
    runs += [(m.start(), m.end(), _unbase64(m[0])) for m in _RUN.finditer(text)]
    for a, b, got in sorted(runs, key=lambda r: (r[0], -r[1])):
        if not got or any(a < y and b > x for x, y in blocks):
            continue
        kind = 3 if is_key(got) else 5 if _holds_secret(got) else None
        if kind and a >= end[kind]:
            out.append((a, kind, b))
            end[kind] = b
    return out


def spans(text: str) -> list[tuple[int, int, int]]:
    """All (start, kind, end) in order."""
    data = text.encode("utf-8", "replace")
    return sorted([*base_spans(text, data), *confirmed_spans(text, data)])


def spans_column(text: Column) -> Column:
    @F.pandas_udf(SPANS)
    def found(texts: pd.Series) -> pd.Series:
        return pd.Series([[{"kind": KINDS[k], "start": a, "end": b} for a, k, b in spans(t)] for t in texts], dtype=object)
    return found(as_text(text))


def scan(docs: DataFrame, text_col: str = "text", out_col: str = "spans") -> DataFrame:
    """``docs`` with the spans of each whole text, by start and then kind as in
    KINDS (a column of that name is replaced)."""
    return docs.withColumn(out_col, spans_column(F.col(text_col)))


def written(spans: Column) -> Column:
    """kind:start:end of the spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
