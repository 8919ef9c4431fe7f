"""Rows that every operator has to handle, and brute-force forms of the operators."""

import hashlib
import random
import re
from collections import Counter, defaultdict

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, score double, found string, id string, "
          "t long, ids string, kept string, Spans string, key string")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SECRET = "0123456789abcdef0123"


def texts(seed=7, n=40):
    """(id, text): random prose, copies, near copies, shared lines, nulls, empty, long and tied rows."""
    rnd = random.Random(seed)
    vocabulary = ["".join(rnd.choice("abcdéfgh") for _ in range(rnd.randrange(1, 9))) for _ in range(300)]

    def prose(words):
        return " ".join(rnd.choice(vocabulary) for _ in range(words)).capitalize() + "."
    shared = [prose(20) for _ in range(4)]
    rows = [(i, "\n".join(prose(rnd.randrange(5, 40)) for _ in range(rnd.randrange(1, 6)))) for i in range(n)]
    for i in range(12):
        words = rows[i][1].split(" ")
        words[rnd.randrange(len(words))] = "CHANGED"
        rows += [(100 + i, rows[i][1]), (200 + i, " ".join(words))]
    for i in range(12):
        rows.append((300 + i, "\n".join([prose(6), *shared, prose(7)])))
    rows += [(400, None), (401, ""), (402, " \n\t \n\n\n\n "), (403, "one"), (404, "one"), (405, "ONE two"), (None, rows[3][1]),
             (None, "no id"), (406, "a" * 3000), (407, "a" * 2000 + "b"), (408, "password = " + SECRET + " AKIA" + "X" * 16),
             (409, "same words again. " * 80), (410, prose(9000)), (410, "another text of an id"), rows[0], rows[0]]
    rnd.shuffle(rows)
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), 0.5, "f", "x", 1, "y", "k", "S", "q") for i, t in rows], SCHEMA)


def shingle_set(text, n):
    words = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(words[i:i + n]) for i in range(max(1, len(words) - n + 1))) if words else frozenset()


def near_groups(rows, n=4, percent=80):
    """Per row: (set size, component number or None) by comparing all pairs."""
    sets = [shingle_set(t, n) for _, t in rows]
    kinds = sorted({s for s in sets if s}, key=sorted)
    at = {s: i for i, s in enumerate(kinds)}
    top = list(range(len(kinds)))

    def root(x):
        while top[x] != x:
            x = top[x]
        return x
    for i, a in enumerate(kinds):
        for j in range(i):
            both = len(a & kinds[j])
            if 100 * both >= percent * (len(a) + len(kinds[j]) - both):
                top[root(i)] = root(j)
    return [(len(s), root(at[s]) if s else None) for s in sets]


def repeated_bytes(rows, k=50):
    """Per row: (id, bytes, removed, runs, sha256 of the rest)."""
    last, first, out = (1 << 63) - 1, {}, []
    for i, t in rows:
        data, i = (t or "").encode(), last if i is None else i
        for p in range(len(data) - k + 1):
            first[data[p:p + k]] = min(first.get(data[p:p + k], i), i)
    for given, t in rows:
        data, i = (t or "").encode(), last if given is None else given
        mask = bytearray(len(data))
        for p in range(len(data) - k + 1):
            if first[data[p:p + k]] < i:
                mask[p:p + k] = b"\1" * k
        runs = [x for x in bytes(mask).split(b"\0") if x]
        rest = bytes(b for b, m in zip(data, mask) if not m)
        out.append((given, len(data), sum(mask), len(runs), hashlib.sha256(rest).hexdigest()))
    return out


def kept_lines(rows):
    """Per row: (id, lines, removed lines, text that stays); windows of three lines."""
    last, first, out = 1 << 63, {}, []
    for i, t in rows:
        lines, i = (t or "").split("\n"), last if i is None else i
        for p in range(len(lines) - 2):
            w = tuple(lines[p:p + 3])
            first[w] = min(first.get(w, (i, p)), (i, p))
    for given, t in rows:
        lines, i = (t or "").split("\n"), last if given is None else given
        gone = {q for p in range(len(lines) - 2) if any(x.strip(" ") for x in lines[p:p + 3])
                and first[tuple(lines[p:p + 3])] < (i, p) for q in range(p, p + 3)}
        rest = "\n".join(x for q, x in enumerate(lines) if q not in gone)
        out.append((given, len(lines), len(gone), t if not gone else rest))
    return out


def benchmark_hits(docs, items, n=10):
    """Per text: (words, hit words, items that occur)."""
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    patterns, out = defaultdict(set), []
    for i, t in items:
        w = word.findall((t or "").translate(LOWER))
        for k in range(max(1, len(w) - n + 1)) if w else []:
            patterns[tuple(w[k:k + n])].add(i)
    sizes = {len(p) for p in patterns}
    for t in docs:
        w, hit, found = word.findall((t or "").translate(LOWER)), set(), set()
        for size in sizes:
            for k in range(len(w) - size + 1):
                if (p := tuple(w[k:k + size])) in patterns:
                    hit.update(range(k, k + size))
                    found |= patterns[p]
        out.append((len(w), len(hit), found - {None}))
    return out


def multiset(rows):
    return Counter(map(repr, rows))
