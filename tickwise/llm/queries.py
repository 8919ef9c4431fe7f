"""Registered queries of the text operators: name -> query, name -> DuckDB SQL.

Each query applies one operator with its production parameters to a whole
table and derives the digest columns from the operator's own output.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwise.llm import (bpe, decontaminate, fill_in_middle, filter_audit, line_dedup, minhash, quality_model, quality_rules,
                          secret_scan, sharding, suffix_dedup, toxicity, warc)
from tickwise.llm.common import held_out, small_batches, table
from tickwise.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]

#: Scores from which a text counts as toxic, and as good.
TOXIC_FROM, GOOD_FROM = 0.5, 0.3


def vocabulary() -> tuple[str, str]:
    """Path of the rank file and the pre-token pattern."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def listed(values: Column) -> Column:
    """Lowercase hex SHA-256 of the values joined by commas."""
    return F.sha2(F.concat_ws(",", values.cast("array<string>")).cast("binary"), 256)


def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    near = minhash.near_duplicates(table(spark, sf_dir, "documents"), words=4)
    return near.select(F.col("id").alias("doc_id"), "n_shingles", "component_id",
                       F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def op2_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = suffix_dedup.dedup(table(spark, sf_dir, "documents"))
    removed = F.aggregate("runs", F.lit(0).cast("bigint"), lambda n, r: n + r["end"] - r["start"])
    return done.select(F.col("id").alias("doc_id"), "n_bytes", removed.alias("n_removed"),
                       F.size("runs").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return (toxicity.score(docs.select("doc_id", "text"), model)
            .select("doc_id", held_out().alias("held_out"), "toxicity.score")
            .withColumn("predicted", (F.col("score") >= TOXIC_FROM).cast("int")))


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = F.col("spans")
    base = F.filter(spans, lambda s: s["kind"].isin(*secret_scan.BASE_KINDS))

    def count(kind: str) -> Column:
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    return secret_scan.scan(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", *(count(k) for k in secret_scan.BASE_KINDS),
        F.sha2(secret_scan.written(base).cast("binary"), 256).alias("base_sha256"),
        secret_scan.written(spans).alias("spans"))


def op5_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = F.col("rules")
    return quality_rules.clean(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "rules.n_words", "rules.word_chars", "rules.n_symbols", "rules.n_dup_lines", "rules.n_repeat_words",
        quality_rules.base_failed(rules).alias("base_failed"), quality_rules.keeps(rules).alias("kept"))


_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
OP5_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM d),
tri AS (SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS t FROM w, unnest(range(1, len(w) - 1)) AS u(i)),
often AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, t) AS c FROM tri) WHERE c > 1),
rep AS (SELECT r, count(DISTINCT p) AS n FROM often, unnest(range(i, i + 3)) AS u(p) GROUP BY r),
line AS (SELECT r, i, l[i] AS raw, trim(l[i], chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS x
         FROM (SELECT r, string_split(text, chr(10)) AS l FROM d), unnest(range(1, len(l) + 1)) AS u(i)),
f AS (SELECT r, i, raw, len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')) AS words,
             len(regexp_extract_all(x, '[|»›•·]')) AS separators, len(regexp_extract_all(x, '[#*$%&|<>]')) AS symbols,
             len(regexp_extract_all(x, '[A-Z]')) AS capitals, len(regexp_extract_all(x, '[A-Za-z]')) AS letters,
             regexp_matches({_LOWER.format("x")}, '{"|".join(quality_rules.BOILERPLATE)}') AS boilerplate,
             regexp_matches(x, '[.!?…。]') AS marked, length(regexp_replace(x, '[\x20\x09-\x0D]', '', 'g')) AS chars
      FROM line WHERE x <> ''),
j AS (SELECT *, separators >= 2 AND words <= 4 * separators OR boilerplate OR words <= 2 * symbols
             OR letters >= 20 AND 100 * capitals > 60 * letters OR words > 8 AND NOT marked AS failed,
             row_number() OVER (PARTITION BY r, raw ORDER BY i) > 1 AS dup FROM f),
s AS (SELECT r, sum(chars) AS total, sum(CASE WHEN failed THEN chars ELSE 0 END) AS lost,
             sum(CASE WHEN dup THEN 1 ELSE 0 END) AS dups FROM j GROUP BY r),
a AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
             CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
             CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
             CAST(coalesce(dups, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words,
             coalesce(total, 0) AS total, coalesce(lost, 0) AS lost
      FROM d JOIN w USING (r) LEFT JOIN rep USING (r) LEFT JOIN s USING (r)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM a)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND 100 * lost <= 50 * total AS kept FROM b
"""


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality_model.train(docs, table(spark, sf_dir, "labels"))
    return (quality_model.score(docs.select("doc_id", "text"), model)
            .select("doc_id", held_out().alias("held_out"), "score",
                    (F.col("score") >= GOOD_FROM).cast("int").alias("predicted")))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.search(table(spark, sf_dir, "documents").select("doc_id", "text"),
                                 table(spark, sf_dir, "benchmark"))
    n_hit = decontaminate.hit_words(F.col("found"))
    return found.select("doc_id", "found.n_words", n_hit.alias("n_hit"),
                        F.size("found.items").cast("bigint").alias("n_items"),
                        listed(F.col("found.items")).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


OP7_SQL = r"""
WITH dw AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
bw AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''),
       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
pat AS (SELECT DISTINCT item_id, least(len(w), 10) AS k, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS p
        FROM bw, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS t(i) WHERE len(w) > 0),
ks AS (SELECT DISTINCT k FROM pat),
dwin AS (SELECT r, i, k, array_to_string(w[i:i + k - 1], ' ') AS p
         FROM dw, ks, unnest(range(1, len(w) - k + 2)) AS t(i) WHERE len(w) >= k),
hit AS (SELECT DISTINCT r, i, k, item_id FROM dwin JOIN pat USING (k, p)),
words AS (SELECT r, count(DISTINCT pos) AS n_hit FROM hit, unnest(range(i, i + k)) AS t(pos) GROUP BY r),
items AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
          FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM hit WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN words USING (r) LEFT JOIN items USING (r)
"""


def op8_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = line_dedup.dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select("doc_id", "kept.n_lines", "kept.n_removed", F.size("kept.spans").cast("bigint").alias("n_spans"),
                       F.sha2(F.coalesce("kept.text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


OP8_SQL = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
w AS (SELECT r, doc_id, i, l[i] AS a, l[i + 1] AS b, l[i + 2] AS c FROM d, unnest(range(1, len(l) - 1)) AS t(i)),
f AS (SELECT r, doc_id, i, first_value(doc_id) OVER same AS doc, first_value(i) OVER same AS pos FROM w
      WHERE trim(a) <> '' OR trim(b) <> '' OR trim(c) <> ''
      WINDOW same AS (PARTITION BY a, b, c ORDER BY doc_id, i)),
gone AS (SELECT DISTINCT r, p FROM f, unnest(range(i, i + 3)) AS t(p) WHERE doc_id > doc OR doc_id = doc AND i > pos),
runs AS (SELECT r, count(*) AS n_removed, sum(CAST(before IS DISTINCT FROM p - 1 AS INT)) AS n_spans
         FROM (SELECT r, p, lag(p) OVER (PARTITION BY r ORDER BY p) AS before FROM gone) GROUP BY r),
kept AS (SELECT r, string_agg(line, chr(10) ORDER BY p) AS text
         FROM (SELECT r, unnest(l) AS line, unnest(range(1, len(l) + 1)) AS p FROM d) ANTI JOIN gone USING (r, p) GROUP BY r)
SELECT doc_id, CAST(len(l) AS BIGINT) AS n_lines, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN runs USING (r) LEFT JOIN kept USING (r)
"""


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, pattern = vocabulary()
    ids = bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), path, pattern)
    return bpe.decode(ids.drop("text"), path).select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"), listed(F.col("ids")).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, f"warc-{uuid.uuid4().hex}")
    warc.write(table(spark, sf_dir, "pages"), path)

    def number(name: str) -> Column:
        return F.regexp_extract(name, "^<urn:page:(-?[0-9]+)>$", 1).try_cast("bigint")
    return warc.read(spark, path).select(
        number("id").alias("page_id"), "payload_bytes", "payload_digest", F.col("type").alias("record_type"),
        number("refers_to").alias("refers_to"))


#: Shards of the documents, all of one weight.
SHARDS = 8


def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.manifest(table(spark, sf_dir, "documents"), [1.0] * SHARDS, [1.0] * (SHARDS + 1))
    return placed.select(F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot",
                         "grown_shard")


# CRC-32 byte by byte, with the table that its polynomial gives
OP11_SQL = f"""
WITH crc AS (SELECT list(x ORDER BY i) AS t FROM (
       SELECT i, list_reduce(list_prepend(i, range(8)), lambda x, k: xor(x >> 1, (x & 1) * 3988292384)) AS x
       FROM range(256) AS r(i))),
b AS (SELECT doc_id, coalesce('k:' || doc_id, 'n') AS key, list_transform(
        regexp_extract_all(hex(coalesce(text, '')), '..'), lambda p: CAST('0x' || p AS BIGINT)) AS l FROM documents),
c AS (SELECT doc_id, key, CAST(len(l) + 1 AS BIGINT) AS size, xor(list_reduce(list_prepend(4294967295::BIGINT, l),
        lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) AS text_crc32 FROM b, crc),
s AS (SELECT *, list_transform(range({SHARDS + 1}), lambda s: {{'score':
        -ln((CAST('0x' || substr(md5(key || ':' || s), 1, 13) AS BIGINT) + 0.5) / 4503599627370496.0), 'shard': s}}) AS bids FROM c),
w AS (SELECT *, list_sort(bids[1:{SHARDS}])[1].shard AS shard, list_sort(bids)[1].shard AS grown_shard FROM s)
SELECT doc_id, size, CAST(text_crc32 AS BIGINT) AS text_crc32, 'key' AS law, CAST(shard AS INT) AS shard,
       row_number() OVER (PARTITION BY shard ORDER BY md5(key || ':' || size || ':' || text_crc32), doc_id, size, text_crc32) - 1 AS slot,
       CAST(grown_shard AS INT) AS grown_shard FROM w
"""


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


OP12_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, coalesce(source, '') AS part FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w, min(doc_id) OVER (PARTITION BY text) AS least FROM d),
l AS (SELECT doc_id, max(quality) AS good, max(toxic) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
m AS (SELECT r, part, coalesce(good, 0) = 1 AS good, coalesce(toxic, 0) = 1 AS toxic,
       CAST(len(w) < 50 AS INT) + 2 * CAST(100 * len(list_distinct(w)) < 65 * len(w) AS INT)
       + 4 * CAST(100 * len(regexp_extract_all(text, '[A-Z]')) > 5 * length(text) AS INT)
       + 8 * CAST(regexp_matches(text, '[#$%&*|]') AS INT)
       + 16 * CAST(coalesce(w.doc_id > least, least IS NOT NULL) AS INT) AS mask FROM w LEFT JOIN l ON w.doc_id = l.doc_id),
c AS (SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM m GROUP BY part, mask),
o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
      FROM (VALUES ('A'), ('B'), ('C'), ('D'), ('E')) AS a(x), (VALUES ('A'), ('B'), ('C'), ('D'), ('E')) AS b(x),
           (VALUES ('A'), ('B'), ('C'), ('D'), ('E')) AS c(x), (VALUES ('A'), ('B'), ('C'), ('D'), ('E')) AS d(x),
           (VALUES ('A'), ('B'), ('C'), ('D'), ('E')) AS e(x)
      WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
p AS (SELECT filter_order, step, 1 << (ascii(filter_order[step]) - 65) AS f, coalesce(list_sum(list_transform(
        range(1, step), lambda i: 1 << (ascii(filter_order[i]) - 65))), 0)::INT AS earlier
      FROM o, range(1, 6) AS t(step)),
s AS (SELECT part, filter_order, step, f, coalesce(sum(n) FILTER (mask & (f | earlier) = 0), 0) AS kept,
       coalesce(sum(n) FILTER (mask & f <> 0 AND mask & earlier = 0), 0) AS removed,
       coalesce(sum(n) FILTER (mask & f <> 0 AND mask & earlier <> 0), 0) AS redundant,
       coalesce(sum(n) FILTER (mask = f), 0) AS unique_fails,
       coalesce(sum(good) FILTER (mask & f <> 0 AND mask & earlier = 0), 0) AS good_lost,
       coalesce(sum(toxic) FILTER (mask & f <> 0 AND mask & earlier = 0), 0) AS toxic_lost
      FROM c, p GROUP BY part, filter_order, step, f)
SELECT part, filter_order, CAST(step AS INT) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley FROM s
"""


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle.transform(table(spark, sf_dir, "documents").select("doc_id", "text"))
    output = F.col("fim.output")
    return made.select("doc_id", "fim.n", "fim.form", "fim.prefix_chars", "fim.middle_chars",
                       F.sha2(output.cast("binary"), 256).alias("output_sha256"),
                       F.sha2(fill_in_middle.restore(output, F.col("fim.form")).cast("binary"), 256).alias("restored_sha256"))


OP13_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^
]*
|[^
]+') AS l,
                  sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS x FROM documents),
h AS (SELECT doc_id, text, l, len(l) AS n, list_transform(range(4), lambda i: CAST('0x' || substr(x, 8 * i + 1, 8) AS BIGINT)) AS h FROM d),
c AS (SELECT *, least(h[1] % (n + 1), h[2] % (n + 1)) AS a, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS b,
             text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h[3] % 100 >= 100 AS plain FROM h),
p AS (SELECT *, coalesce(array_to_string(l[1:a], ''), '') AS prefix, coalesce(array_to_string(l[a + 1:b], ''), '') AS middle,
             coalesce(array_to_string(l[b + 1:n], ''), '') AS suffix,
             CASE WHEN plain THEN 'plain' WHEN h[4] % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM c)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN NOT plain THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
       CASE WHEN NOT plain THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle
              ELSE '<P>' || prefix || '<S>' || suffix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256 FROM p
"""

_QUERIES = (op1_minhash, op2_suffixes, op3_toxicity, op4_secrets, op5_rules, op6_quality, op7_decontaminate, op8_lines, op9_bpe, op10_warc,
            op11_sharding, op12_filter_audit, op13_fill_in_middle)


def _with_small_batches(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        small_batches(spark)
        return query(spark, sf_dir)
    return run


def queries() -> dict[str, Query]:
    return {q.__name__: _with_small_batches(q) for q in _QUERIES}


def oracle_sql() -> dict[str, str]:
    return {"op5_rules": OP5_SQL, "op7_decontaminate": OP7_SQL, "op8_lines": OP8_SQL, "op11_sharding": OP11_SQL,
            "op12_filter_audit": OP12_SQL, "op13_fill_in_middle": OP13_SQL}
