"""WARC archives: write pages as records, read records back by boundary chains.

Writing. Of pages with the same payload, the one with the largest id becomes a
response with the payload, the others revisit it without a payload. Payloads
are grouped by digest, counted before the shuffle; only groups of several pages
are kept, in a table of the shared folder, which the pages meet in a join
(broadcast by Spark when that table is small, split at skewed keys else). Spark's
text writer makes the archive files.

Reading. Spark's text reader cuts archives at the version line, so a task sees
candidates in order and knows their offsets. Every candidate gives the offset of
its successor from its header. A candidate is a record only if the chain from the
start of its file leads there: pointers are doubled until every chain is walked,
so a version line inside a payload is rejected, however well formed what follows
may be. A payload that holds version lines spans several pieces; these are read
once more and put together.

Defined cases: a null payload is empty; empty payloads are equal payloads; pages
that share an id and a payload are written alike; a null id is no target of a
revisit unless all pages of a payload have null ids, then all are responses;
line breaks in a URL become spaces; an empty table writes no record, an empty
archive has none; a record that is cut off at the end of its file is no record;
other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickwise.llm.common import as_text, store

# Fixed values of the archive format.
MAGIC = "WARC/1.0\r\n"
END = "\r\n\r\n"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"

#: Bytes of a payload from which equal payloads are revisited.
MIN_REVISIT_BYTES = 0

FIELDS = ("file string, block long, at long, until long, candidate boolean, next long, type string, id string, "
          "uri string, refers_to string, payload_bytes long, payload_digest string, stated_digest string")


def base32_sha1(data: Column) -> Column:
    """Bare upper-case base32 of the SHA-1 of a binary column."""
    digest = F.sha1(data)
    letters = []
    for part in range(4):
        bits = F.conv(F.substring(digest, 1 + 10 * part, 10), 16, 10).cast("bigint")
        letters += [F.substring(F.lit(ALPHABET), (F.shiftright(bits, 35 - 5 * i).bitwiseAND(F.lit(31)) + 1).cast("int"),
                                F.lit(1)) for i in range(8)]
    return F.concat(*letters)


def _line(name: str, value: Column | str) -> Column:
    return F.concat(F.lit(f"{name}: "), F.lit(value) if isinstance(value, str) else value, F.lit("\r\n"))


def records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
            min_revisit_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """One column, the text of a record without its final line breaks."""
    rows = pages.select(F.col(id_col).alias("id"), as_text(url_col).alias("url"),
                        as_text(payload_col).alias("payload"))
    data = F.col("payload").cast("binary")
    key = F.unhex(F.sha2(data, 256))
    groups = store(rows.groupBy(key.alias("key")).agg(F.max("id").alias("keeper"), F.count(F.lit(1)).alias("n"))
                   .filter((F.col("n") > 1) & F.col("keeper").isNotNull()).select("key", "keeper"), "warc-groups")
    rows = rows.withColumns({"key": key, "digest": base32_sha1(data), "bytes": F.octet_length("payload")})
    rows = rows.join(groups, "key", "left")
    revisit = (F.col("keeper").isNotNull() & ~F.col("keeper").eqNullSafe(F.col("id"))
               & (F.col("bytes") >= min_revisit_bytes))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"),
                    _line("Content-Length", F.col("bytes").cast("string")), F.lit("\r\n"))
    block = F.concat(http, F.when(revisit, "").otherwise(F.col("payload")))

    def urn(c: Column) -> Column:
        return F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    head = F.concat(
        F.lit(MAGIC), _line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _line("WARC-Record-ID", urn(F.col("id"))), _line("WARC-Date", DATE),
        _line("WARC-Target-URI", F.translate("url", "\r\n", "  ")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.when(revisit, F.concat(_line("WARC-Refers-To", urn(F.col("keeper"))), _line("WARC-Profile", REVISIT_PROFILE)))
        .otherwise(""),
        _line("Content-Type", "application/http; msgtype=response"),
        _line("Content-Length", F.octet_length(block).cast("string")), F.lit("\r\n"))
    return rows.select(F.concat(head, block).alias("value"))


def write(pages: DataFrame, path: str, records_per_file: int = 100_000, **kw) -> None:
    """Archives of ``pages`` under ``path``, at most so many records in a file."""
    (records(pages, **kw).write.option("lineSep", END).option("maxRecordsPerFile", records_per_file).text(path))


def _headers(block: bytes) -> dict[bytes, bytes]:
    return {k.strip().lower(): v.strip() for k, found, v in (x.partition(b":") for x in block.split(b"\r\n")) if found}


def _name(value: bytes | None) -> str | None:
    return None if value is None else value.decode("utf-8", "replace")


def parse(piece: bytes) -> tuple | None:
    """From what follows a version line: bytes to the next version line, and
    type, id, uri, refers_to, payload, stated payload bytes and digest. The
    payload is cut short if the piece ends before its record. None without a
    valid header."""
    head, found, rest = piece.partition(b"\r\n\r\n")
    h = _headers(head)
    size = h.get(b"content-length", b"")
    if not found or not size.isdigit() or len(size) > 15 or b"warc-type" not in h:
        return None
    payload, stated = rest[:int(size)], None
    if h.get(b"content-type", b"").startswith(b"application/http"):
        http, _, payload = payload.partition(b"\r\n\r\n")
        n = _headers(http).get(b"content-length", b"")
        stated = int(n) if n.isdigit() and len(n) <= 15 else None
    return (len(head) + 4 + int(size) + 4, _name(h[b"warc-type"]), _name(h.get(b"warc-record-id")),
            _name(h.get(b"warc-target-uri")), _name(h.get(b"warc-refers-to")), payload, stated,
            (_name(h.get(b"warc-payload-digest")) or "").removeprefix("sha1:") or None)


def _result(got: tuple) -> tuple:
    """type, id, uri, refers_to, payload bytes, digest, stated digest of a whole record."""
    _, kind, name, uri, refers, payload, stated, digest = got
    if kind == "revisit":
        return kind, name, uri, refers, stated, digest, digest
    return kind, name, uri, refers, len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode(), digest


def _scan(spark: SparkSession, path: str) -> DataFrame:
    return (spark.read.option("lineSep", MAGIC).text(path)
            .select(F.col("value").cast("binary").alias("value"), F.col("_metadata.file_path").alias("file"),
                    F.col("_metadata.file_block_start").alias("block")))


def _walk(frames: Iterator[pd.DataFrame]) -> Iterator[tuple[str, int, int, bool, bytes]]:
    """(file, block, offset in the block after the version line, candidate?, bytes) of the
    pieces in order. What comes before the first version line of a file is no candidate."""
    file = block = None
    at = 0
    for frame in frames:
        for value, f, b in zip(frame["value"], frame["file"], frame["block"]):
            if (f, b) != (file, block):
                file, block, at, first = f, b, 0, b == 0
            yield f, b, at, not first, value
            first = False
            at += len(value) + len(MAGIC)


def pieces(spark: SparkSession, path: str) -> DataFrame:
    """Candidates with their place in the block (``at`` the version line,
    ``until`` the next one), and the offset ``next`` of the successor, counted
    from the same place; fields of the record when the piece holds all of it."""
    def emit(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = [c.split()[0] for c in FIELDS.split(", ")]
        out = []
        for file, block, at, candidate, value in _walk(frames):
            start, until = at - len(MAGIC), at + len(value)
            got = parse(value) if candidate else None
            after = at + got[0] if got else None
            out.append((file, block, start, until, candidate, after,
                        *(_result(got) if got and after == until else (None,) * 7)))
            if len(out) >= 5000:
                yield pd.DataFrame(out, columns=columns)
                out = []
        yield pd.DataFrame(out, columns=columns)
    return _scan(spark, path).mapInPandas(emit, FIELDS)


def _placed(found: DataFrame) -> DataFrame:
    """``found`` with offsets in the file in place of offsets in the block."""
    blocks = found.groupBy("file", "block").agg((F.max("until") + len(MAGIC)).alias("size"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    base = blocks.select("file", "block", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base"))
    rows = found.join(base, ["file", "block"])
    moved = {c: F.col(c) + F.col("base") for c in ("at", "until", "next")}
    return rows.withColumns(moved)


def _reached(candidates: DataFrame, longest: int) -> DataFrame:
    """file, at of the candidates to which a chain from offset 0 leads. Every round
    doubles the length of the pointers and of the chains walked, and is written
    to the shared folder."""
    state = store(candidates.select("file", "at", F.col("next").alias("jump"), (F.col("at") == 0).alias("on")), "warc-chain")
    for _ in range(max(1, longest).bit_length()):
        ahead = state.filter("on and jump is not null").select("file", F.col("jump").alias("at"), F.lit(True).alias("hit"))
        ends = state.select("file", F.col("at").alias("jump"), F.col("jump").alias("further"))
        state = store(state.join(ahead.distinct(), ["file", "at"], "left").join(ends, ["file", "jump"], "left")
                      .select("file", "at", F.col("further").alias("jump"),
                              (F.col("on") | F.coalesce("hit", F.lit(False))).alias("on")), "warc-chain")
    return state.filter("on").select("file", "at")


def read(spark: SparkSession, path: str) -> DataFrame:
    """file, at (offset), type, id, uri, refers_to, payload_bytes, payload_digest (of the
    bytes read; of a revisit, as stated), stated_digest of every record under ``path``."""
    found = store(_placed(store(pieces(spark, path), "warc-pieces")), "warc-placed")
    candidates = found.filter("candidate")
    longest = candidates.groupBy("file").count().agg(F.max("count")).first()[0] or 0
    chain = _reached(candidates, longest)
    linked = candidates.join(chain, ["file", "at"])
    names = ["file", "at", "type", "id", "uri", "refers_to", "payload_bytes", "payload_digest", "stated_digest"]
    whole = linked.filter(F.col("next") == F.col("until")).select(*names)
    parts = linked.filter(F.col("next") > F.col("until")).select("file", F.col("at").alias("owner"), "next")
    return whole.unionByName(_joined(spark, path, candidates, store(parts, "warc-parts"))).select(*names)


def _joined(spark: SparkSession, path: str, candidates: DataFrame, parts: DataFrame) -> DataFrame:
    """The records of several pieces. An owner's pieces lie between it and its
    successor: each piece takes the last owner before it, found within its
    block and, where a block begins inside a record, from the blocks before."""
    rows = candidates.select("file", "block", "base", "at", "until").join(
        parts.select("file", F.col("owner").alias("at"), F.col("next").alias("end")), ["file", "at"], "left")
    inside = Window.partitionBy("file", "block").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    own = F.when(F.col("end").isNotNull(), F.struct(F.col("at").alias("owner"), "end"))
    carried = rows.groupBy("file", "block").agg(F.max(own).alias("last")).select(
        "file", "block", F.max("last").over(earlier).alias("carried"))
    owned = (rows.withColumn("mine", F.last(own, True).over(inside)).join(carried, ["file", "block"])
             .withColumn("by", F.coalesce("mine", "carried")).filter(F.col("by.end") > F.col("at"))
             .select("file", "block", (F.col("at") - F.col("base")).alias("local"), "at", "by.owner", "by.end"))
    needed = store(owned, "warc-needed")

    def emit(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out, n = [], 0
        for f, b, at, candidate, value in _walk(frames):
            if candidate:
                out.append((f, b, at - len(MAGIC), value))
                n += len(value)
            if n >= 1 << 22:
                yield pd.DataFrame(out, columns=["file", "block", "local", "value"])
                out, n = [], 0
        yield pd.DataFrame(out, columns=["file", "block", "local", "value"])

    @F.pandas_udf("struct<type:string,id:string,uri:string,refers_to:string,payload_bytes:long,payload_digest:string,"
                  "stated_digest:string,ends:boolean>")
    def put_together(values: pd.Series, sizes: pd.Series) -> pd.DataFrame:
        out = []
        for parts, size in zip(values, sizes):
            data = MAGIC.encode().join(p["value"] for p in parts)
            got = parse(data)
            out.append((*_result(got), len(data) >= size - len(MAGIC)))
        return pd.DataFrame(out, columns=["type", "id", "uri", "refers_to", "payload_bytes", "payload_digest",
                                          "stated_digest", "ends"])

    data = _scan(spark, path).mapInPandas(emit, "file string, block long, local long, value binary")
    records = (data.join(needed, ["file", "block", "local"]).groupBy("file", "owner", "end")
               .agg(F.array_sort(F.collect_list(F.struct("at", "value"))).alias("parts"))
               .select("file", F.col("owner").alias("at"), put_together("parts", F.col("end") - F.col("owner")).alias("r")))
    return records.filter("r.ends").select("file", "at", "r.*").drop("ends")
