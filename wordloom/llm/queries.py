"""The registered queries of this subpackage and their SQL. Each takes (spark, sf_dir)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.llm import common as C
from wordloom.llm import codes, decontamination, filter_audit, html_extract, langid, lm, neardup, pieces, pii, quality, sharding, tokencount, warc


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    out = decontamination.decontaminate(_documents(spark, sf_dir), bench)
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"), decontamination.items_digest("items").alias("items_sha256"), "contaminated")


def op2_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    out = lm.lm_score(docs, C.fold(F.col("doc_id"), 7) != 2)
    return out.select("doc_id", (C.fold(F.col("doc_id"), 7) == 2).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("piece_bpe_32k.model")
    return pieces.segment(_documents(spark, sf_dir), path, k=2, seed=7, finish=pieces.checked(path), schema=f"{pieces.SAMPLES}, {pieces.DIGEST}")


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = C.Scratch(spark, "shards").path("out")
    out = sharding.shuffle_to_shards(_documents(spark, sf_dir), folder, shards=40)
    crc = F.crc32(F.coalesce("text", F.lit("")).cast("binary"))
    return out.select("doc_id", F.col("_size").alias("size"), crc.alias("text_crc32"), F.lit("rows").alias("law"), F.col("_shard").alias("shard"), F.col("_slot").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = neardup.classes(_documents(spark, sf_dir))
    return out.select("doc_id", "class_id", "class_size", (F.col("doc_id") == F.col("class_id")).alias("kept"))


def op6_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = html_extract.extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return out.select("page_id", "url", "text", F.char_length("text").cast("bigint").alias("n_chars"), "path")


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = C.Scratch(spark, "warc").path("out")
    warc.write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"), folder)
    back = warc.read_warc(spark, folder)
    page = lambda c: F.regexp_extract(c, r"<urn:page:(-?\d+)>", 1)
    digest = F.when(F.col("record_type") == "response", F.sha1("payload")).otherwise(F.col("payload_digest"))
    number = lambda c: F.when(page(c) != "", page(c).cast("bigint"))
    return back.select(number("record_id").alias("page_id"), "payload_bytes", digest.alias("payload_digest"), "record_type", number("refers_to").alias("refers_to"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = quality.apply_policy(quality.ledger(_documents(spark, sf_dir)), quality.POLICY_V1)
    base = quality.failed(quality.POLICY_BASE) != 0
    return entries.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base.alias("base_failed"), "kept", "fail_bits")


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    out = langid.identify(docs, C.fold(F.col("doc_id"), 3) != 1)
    return out.select("doc_id", (C.fold(F.col("doc_id"), 3) == 1).alias("held_out"), "lang_pred", "score", "cross_entropy", "rejected")


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    out = tokencount.count_tokens(_documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))
    return out.select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    books = codes.learn(vectors, parts=16, entries=64, rounds=2, scale=256)
    coded = C.Scratch(spark, "codes").table(codes.encode(vectors, books), "coded")
    out = codes.with_label_error(coded)
    return out.select("vec_id", "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op13_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pii.detect(_documents(spark, sf_dir))
    number = [F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("bigint").alias(f"n_{pii.KINDS[kind]}") for kind in range(4)]
    return out.select("doc_id", *number, F.sha2(pii.joined(F.col("base")), 256).alias("base_sha256"), pii.joined(F.col("spans")).alias("spans"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_decontamination,
        op2_lm_score,
        op3_sentencepiece,
        op4_sharding,
        op5_near_duplicates,
        op6_html_extract,
        op7_warc,
        op8_quality,
        op9_language_id,
        op10_token_counts,
        op11_vector_codes,
        op12_filter_audit,
        op13_personal_data,
    )
}

# ---------------------------------------------------------------------------
# DuckDB SQL of the queries that SQL can express
# ---------------------------------------------------------------------------

_ASCII = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_ASCII}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

_OP1 = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, array_to_string(w[i : i + 12], ' ') AS t, least(len(w), 13) AS n
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM win),
places AS (
  SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS t
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
hits AS (SELECT p.doc_id, p.i, p.n, win.item_id FROM places p JOIN win ON win.n = p.n AND win.t = p.t),
covered AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS pos FROM hits) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS list
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(c.n_hit, 0) AS n_hit, coalesce(i.n_items, 0) AS n_items,
       sha256(coalesce(i.list, '')) AS items_sha256, coalesce(c.n_hit, 0) > 0 AND 20 * coalesce(c.n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN covered c USING (doc_id) LEFT JOIN items i USING (doc_id)"""

_OP5 = f"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce(text, '') AS text, {_WORDS} AS w FROM documents),
g AS (
  SELECT doc_id, array_to_string(w[i : i + 4], ' ') AS g, count(*) AS n
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0) GROUP BY ALL),
total AS (SELECT doc_id, sum(n) AS n FROM g GROUP BY doc_id),
low AS (SELECT a.doc_id AS a, b.doc_id AS b, sum(least(a.n, b.n)) AS n FROM g a JOIN g b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
near AS (
  SELECT low.a, low.b FROM low JOIN total x ON x.doc_id = low.a JOIN total y ON y.doc_id = low.b
  WHERE low.n >= {neardup.THRESHOLD} * (x.n + y.n - low.n)
  UNION SELECT a.doc_id, b.doc_id FROM d a JOIN d b ON a.text = b.text AND a.doc_id < b.doc_id),
links AS (SELECT a, b FROM near UNION SELECT b, a FROM near),
reach(a, b) AS (SELECT doc_id, doc_id FROM d UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
cls AS (SELECT a AS doc_id, min(b) AS class_id, count(*) AS class_size FROM reach GROUP BY a)
SELECT doc_id, class_id, class_size, doc_id = class_id AS kept FROM cls"""

_OP7 = f"""
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
k AS (SELECT payload_digest, max(page_id) AS keeper FROM p WHERE payload_bytes >= {warc.DEDUP_BYTES} GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN keeper <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN keeper <> page_id THEN keeper END AS refers_to
FROM p LEFT JOIN k USING (payload_digest)"""

_BITS = " | ".join(f"(CASE WHEN {r.fails} THEN {1 << r.bit} ELSE 0 END)" for r in quality.RULES)
_OP8 = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d),
grams AS (SELECT doc_id, i, [w[i], w[i + 1], w[i + 2]] AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM w WHERE len(w) > 2)),
again AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM grams) WHERE n > 1),
covered AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM again) GROUP BY doc_id),
m AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, CAST(len(l) AS BIGINT) AS n_lines,
         CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words,
         len(regexp_extract_all(t, '\p{{Lu}}')) AS n_upper, len(regexp_extract_all(t, '\p{{L}}')) AS n_letters
  FROM w LEFT JOIN covered c USING (doc_id)),
f AS (SELECT *, CAST({_BITS} AS BIGINT) AS fail_bits FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (fail_bits & {quality.POLICY_BASE.mask()}) <> 0 AS base_failed, (fail_bits & {quality.POLICY_V1.mask()}) = 0 AS kept, fail_bits
FROM f"""



def _op11(parts: int = 16, entries: int = 64, rounds: int = 2, scale: int = 256) -> str:
    """Every part against every entry of its codebook; ``b0`` .. are the codebooks of the rounds."""
    nearest = "SELECT *, row_number() OVER (PARTITION BY v, p ORDER BY e, k) AS r FROM (SELECT x.v, x.p, b.k, list_sum(list_transform(list_zip(x.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS e FROM x JOIN {book} b USING (p))"
    sql = f"""
WITH kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda c: CAST(floor({scale} * c) AS BIGINT)) AS f, row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
wide AS (SELECT max(len(f)) // {parts} AS w FROM kept),
x AS MATERIALIZED (SELECT v, p, f[p * w + 1 : p * w + w] AS x FROM (SELECT v, f, w, unnest(range({parts})) AS p FROM kept, wide)),
b0 AS MATERIALIZED (SELECT p, v - 1 AS k, x FROM x WHERE v <= {entries})"""
    for i in range(rounds):
        sql += f""",
n{i} AS MATERIALIZED (SELECT v, p, k FROM ({nearest.format(book=f"b{i}")}) WHERE r = 1),
s{i} AS (SELECT p, k, j, sum(c) AS s, count(*) AS n FROM (SELECT n.p, n.k, unnest(x.x) AS c, unnest(range(len(x.x))) AS j FROM n{i} n JOIN x USING (v, p)) GROUP BY ALL),
m{i} AS (SELECT p, k, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY j) AS x FROM s{i} GROUP BY p, k),
b{i + 1} AS MATERIALIZED (SELECT b.p, b.k, coalesce(m.x, b.x) AS x FROM b{i} b LEFT JOIN m{i} m USING (p, k))"""
    return sql + f""",
last AS (SELECT v, p, k, e FROM ({nearest.format(book=f"b{rounds}")}) WHERE r = 1),
coded AS (SELECT v, string_agg(printf('%02x', k), '' ORDER BY p) AS code, CAST(sum(e) AS BIGINT) AS error FROM last GROUP BY v),
sha AS (SELECT sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY p, k, j)) AS s FROM (SELECT p, k, unnest(x) AS c, unnest(range(len(x))) AS j FROM b{rounds}))
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, sha.s AS codebooks_sha256
FROM kept JOIN coded USING (v), sha"""


_OP12 = r"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
         min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first FROM documents),
m AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
f AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
         (CASE WHEN len(w) < 100 THEN 'A' ELSE '' END) || (CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 'B' ELSE '' END)
         || (CASE WHEN 100 * len(regexp_extract_all(t, '[A-Z]')) > 10 * length(t) THEN 'C' ELSE '' END)
         || (CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END) || (CASE WHEN first < doc_id THEN 'E' ELSE '' END) AS fails
  FROM d LEFT JOIN m USING (doc_id)),
c AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY ALL),
l(x) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
o AS (
  SELECT filter_order FROM (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM l a, l b, l c, l d, l e) WHERE len(list_distinct(string_split(filter_order, ''))) = 5),
s AS (SELECT filter_order, step, filter_order[step] AS own, filter_order[1 : step - 1] AS before FROM (SELECT filter_order, CAST(unnest(range(1, 6)) AS INTEGER) AS step FROM o)),
r AS (
  SELECT part, filter_order, step, own, n, good, toxic, contains(fails, own) AS now, fails = own AS only_this,
         before <> '' AND regexp_matches(fails, '[' || CASE WHEN before = '' THEN '-' ELSE before END || ']') AS gone
  FROM c, s),
t AS (
  SELECT part, filter_order, step, own, CAST(sum(CASE WHEN NOT now AND NOT gone THEN n ELSE 0 END) AS BIGINT) AS kept,
         CAST(sum(CASE WHEN now AND NOT gone THEN n ELSE 0 END) AS BIGINT) AS removed, CAST(sum(CASE WHEN now AND gone THEN n ELSE 0 END) AS BIGINT) AS redundant,
         CAST(sum(CASE WHEN only_this THEN n ELSE 0 END) AS BIGINT) AS unique_fails, CAST(sum(CASE WHEN now AND NOT gone THEN good ELSE 0 END) AS BIGINT) AS good_lost,
         CAST(sum(CASE WHEN now AND NOT gone THEN toxic ELSE 0 END) AS BIGINT) AS toxic_lost
  FROM r GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley FROM t"""

ORACLE_SQL: dict[str, str] = {"op1_decontamination": _OP1, "op5_near_duplicates": _OP5, "op7_warc": _OP7, "op8_quality": _OP8, "op11_vector_codes": _op11(), "op12_filter_audit": _OP12}
