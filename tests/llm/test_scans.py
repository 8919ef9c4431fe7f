"""Secrets, benchmark hits and tokens against brute force and the public library."""

import base64
import json
import random
import re

import pytest
from pyspark.sql import functions as F

import llm_fixtures as X
from tickwise.llm import bpe, decontaminate, secret_scan
from tickwise.llm.queries import vocabulary


def der(tag, *parts):
    body = b"".join(parts)
    size = bytes([len(body)]) if len(body) < 128 else bytes([0x82]) + len(body).to_bytes(2)
    return bytes([tag]) + size + body


KEY = der(0x30, der(2, b"\0"), *(der(2, bytes([1 + i]) * 40) for i in range(8)))
PKCS8 = der(0x30, der(2, b"\0"), der(0x30, der(6, b"\x2a\x86\x48")), der(4, KEY))


def b64(data, url=False):
    return (base64.urlsafe_b64encode if url else base64.b64encode)(data).decode().rstrip("=" if url else "")


TOKEN = ".".join([b64(json.dumps({"alg": "HS256"}).encode(), True), b64(json.dumps({"sub": 1}).encode(), True), "c2ln"])


def kinds(text):
    return {(secret_scan.KINDS[k], text[a:b]) for a, k, b in secret_scan.spans(text)}


def test_structures_are_confirmed():
    pem = f"-----BEGIN PRIVATE KEY-----\n{b64(PKCS8)}\n-----END PRIVATE KEY-----"
    assert ("key", pem) in kinds(f"é {pem} x")
    assert ("key", b64(KEY)) in kinds(f"data {b64(KEY)} x") and ("key", KEY.hex()) in kinds(f"h {KEY.hex()}.")
    assert ("token", TOKEN) in kinds(f"bearer {TOKEN}")
    hidden = b64(b"password = hunter2hunter2")
    assert ("encoded", hidden) in kinds(f"see {hidden} there")


@pytest.mark.parametrize("inside", ["user = x\r\npassword = hunter2hunter2\r\n", "clé\u00a0: x\npassword = hunter2hunter2"])
def test_decoded_files_may_have_any_line_ends_and_letters(inside):
    data = inside.encode()
    mixed = "".join(c.upper() if i % 3 else c for i, c in enumerate(data.hex()))
    for hidden in (base64.b64encode(data).decode(), data.hex(), data.hex().upper(), mixed):
        assert ("encoded", hidden) in kinds(f"see {hidden} there")
    for broken in (b"\x00" + data, b"\xff" + data):
        assert not {k for k, _ in kinds(f"see {b64(broken)} there")} & {"encoded"}


@pytest.mark.parametrize("text", [
    f"-----BEGIN PRIVATE KEY-----\n{b64(b'no key at all, only text')}\n-----END PRIVATE KEY-----",
    b64(KEY[:-1]), b64(KEY + b"x"), TOKEN.replace(TOKEN.split(".")[0], b64(b"[1]", True)), "a" * 200, b64(b"just some words here, nothing else")])
def test_unconfirmed_candidates_are_not_reported(text):
    assert not {k for k, _ in kinds(text)} & {"key", "token", "encoded"}


def test_base_kinds_follow_their_patterns(spark):
    rnd = random.Random(1)
    parts = ["password", "Token", "api_key", "=", ": ", "\"", "'", " ", "0123abcd", "AKIA", "XYZ09", "ſecret", "é", "-", "deadbeef", "secret"]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randrange(30))) for _ in range(400)] + [None, ""]
    got = secret_scan.scan(X.frame(spark, list(enumerate(texts)))).orderBy("doc_id").collect()
    assign = re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    for r, t in zip(got, texts):
        t = t or ""
        want = [(m.start(), 0, m.end()) for m in assign.finditer(t) if len(m[2]) >= 12]
        want += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 18]
        want += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 16]
        base = [(s["start"], secret_scan.KINDS.index(s["kind"]), s["end"]) for s in r["spans"] if s["kind"] in secret_scan.BASE_KINDS]
        assert base == sorted(want)


def test_benchmark_search_equals_brute_force(spark):
    rnd = random.Random(3)
    vocabulary_ = ["A", "b", "ab", "É1", "ccc", "x9"]

    def text(n):
        return "".join(rnd.choice(vocabulary_) + rnd.choice([" ", "-", "\n", "  "]) for _ in range(rnd.randrange(n)))
    rows = [*X.texts(), *((1000 + i, text(80)) for i in range(60))]
    items = [(i, text(16)) for i in range(25)] + [(50, rows[5][1]), (51, None), (52, ""), (None, text(12)), (3, text(15)), (53, "one two")]
    bench = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, n_words int")
    for block in (decontaminate.BLOCK_BYTES, 150):     # one block, and many
        found = decontaminate.search(X.frame(spark, rows), bench, block_bytes=block)
        got = [(r["doc_id"], r["found"]["n_words"], sum(s["end"] - s["start"] for s in r["found"]["spans"]), r["found"]["items"])
               for r in found.collect()]
        want = [(i, n, h, sorted(map(str, f))) for (i, _), (n, h, f) in zip(rows, X.benchmark_hits([t for _, t in rows], items))]
        assert X.multiset(got) == X.multiset(want)
    assert decontaminate.search(X.frame(spark, rows), bench.limit(0)).filter(F.size("found.spans") > 0).count() == 0
    assert decontaminate.search(X.frame(spark, []), bench).count() == 0


def test_tokens_equal_the_public_library_and_round_trip(spark):
    import tiktoken
    path, pattern = vocabulary()
    tokens = bpe.load_ranks(path)
    own = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks={t: i for i, t in enumerate(tokens)}, special_tokens={})
    rnd = random.Random(4)
    odd = ["⠀⠁ a", "� \U0001F600 日本語  ", "a" * 3000, " \t\r\n" * 50, "\x00\x1c<|endoftext|> '’s it's",
           "".join(chr(rnd.choice([rnd.randrange(32, 127), rnd.randrange(0x80, 0x3000), rnd.randrange(0x10000, 0x1F000)])) for _ in range(2000))]
    rows = [*X.texts(), *enumerate(odd, 2000)]
    done = bpe.decode(bpe.encode(X.frame(spark, rows), path, pattern), path).collect()
    got = [(r["doc_id"], r["ids"], bytes(r["decoded"])) for r in done]
    assert X.multiset(got) == X.multiset((i, own.encode_ordinary(t or ""), (t or "").encode()) for i, t in rows)
    assert bpe.encode(X.frame(spark, []), path, pattern).count() == 0
    with pytest.raises(ValueError):
        bpe.read_ranks(b"YQ== 0\nYg== 2\n")
