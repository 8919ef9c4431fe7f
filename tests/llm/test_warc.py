"""Archives: what is written is read back, whatever the payloads hold and wherever files are split."""

import base64
import hashlib

import pytest
from pyspark.sql import functions as F

import llm_fixtures as X
from tickwise.llm import warc

RECORD = ("WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:77>\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n")
PAGES = [(1, "a"), (2, "a"), (3, None), (4, ""), (5, "x" + warc.MAGIC + "y"), (6, RECORD), (7, RECORD * 3 + "tail"),
         (8, warc.MAGIC), (9, "\r\n\r\nWARC/1.0\r\nContent-Length: 99999\r\n\r\n"), (10, "é日本"), (10, "é日本"), (11, "é日本"),
         (None, "a"), (None, "own"), (12, "z" * 5000 + RECORD + warc.MAGIC * 3)] + [
    (100 + i, f"page {i % 37} " + RECORD * (i % 3) + "q" * (i * 7 % 900)) for i in range(60)]


def want(pages):
    best, out = {}, []
    for i, h in pages:
        if i is not None:
            best[h or ""] = max(best.get(h or "", i), i)
    for i, h in pages:
        data, keeper = (h or "").encode(), best.get(h or "")
        revisit = keeper is not None and keeper != i
        out.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(),
                    "revisit" if revisit else "response", keeper if revisit else None))
    return out


@pytest.mark.parametrize("split", ["128m", "12k"])
def test_round_trip(spark, tmp, split):
    rows = [(i, "http://x/\r\ny", h, "k", 1) for i, h in PAGES]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, id string, bytes int").repartition(3)
    warc.write(df, f"{tmp}/archive")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        def number(name):
            return F.regexp_extract(name, "^<urn:page:(-?[0-9]+)>$", 1).try_cast("bigint")
        got = [tuple(r) for r in warc.read(spark, f"{tmp}/archive").select(
            number("id"), "payload_bytes", "payload_digest", "type", number("refers_to")).collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert X.multiset(got) == X.multiset(want(PAGES))


def test_empty_table(spark, tmp):
    warc.write(spark.createDataFrame([], "page_id long, url string, html string"), f"{tmp}/none")
    assert warc.read(spark, f"{tmp}/none").count() == 0


def test_damaged_headers_are_no_records():
    assert warc.parse(b"WARC-Type: response\r\nContent-Length: x\r\n\r\n") is None
    assert warc.parse(b"no header") is None and warc.parse(b"Content-Length: 1\r\n\r\na") is None
