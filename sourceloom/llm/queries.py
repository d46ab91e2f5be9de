"""The registered queries opN_<name> and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, jaccard, lines, packing, pii, quality, quotes, toxicity, urls, vectors
from .common import read


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base spans and what patterns add, of every document; see pii.find_pii."""
    found = pii.find_pii(read(spark, sf_dir, "documents"))
    count = lambda k: F.size(F.filter("base", lambda x: x["k"] == k)).cast("long")
    return found.select("doc_id", *[count(k).alias(f"n_{kind}") for k, kind in enumerate(pii.KINDS)], F.sha2(pii.written(F.col("base")), 256).alias("base_sha256"), pii.written(F.col("spans")).alias("spans"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger and verdict of policy v1; see quality.ledger."""
    judged = quality.apply_policy(quality.ledger(read(spark, sf_dir, "documents")), "v1")
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "failed")


def op3_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on each page's URL; see urls.judge."""
    return urls.judge(read(spark, sf_dir, "pages"))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of ids and decoded text; see bpe.encode_decode."""
    return bpe.encode_decode(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), digest=True)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of a model fitted on labels that aren't held out; see toxicity.fit."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score(docs, toxicity.fit(docs, read(spark, sf_dir, "labels")))
    return scored.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), F.col("__score").alias("score"), (F.col("__score") >= 0.5).cast("int").alias("predicted"))


def op6_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of cosine 0.9; see vectors.near_vectors."""
    return vectors.near_vectors(read(spark, sf_dir, "embeddings"))


def op7_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 5-word shingles agree to 0.8; see jaccard.near_duplicates."""
    return jaccard.near_duplicates(read(spark, sf_dir, "documents"))


def op8_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of texts without repeated lines; see lines.dedup_lines."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return lines.dedup_lines(docs).select("doc_id", F.col("__n_lines").alias("n_lines"), F.col("__n_dropped").alias("n_dropped"), F.sha2("__kept_text", 256).alias("kept_sha256"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each piece of each document goes, near copies apart; see packing.pack."""
    docs = read(spark, sf_dir, "documents")
    return packing.pack(docs, clusters=packing.near_clusters(docs))


def op10_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages without quotes, in reply order by thread_root and position; see
    quotes.link_quotes."""
    return quotes.link_quotes(read(spark, sf_dir, "conversations"))


QUERIES = {f.__name__: f for f in (op1_pii, op2_quality, op3_urls, op4_bpe, op5_toxicity, op6_vectors, op7_jaccard, op8_lines, op9_packing, op10_quotes)}

_WS = r"[\x20\x09-\x0D]"
_RULES = " ".join(f"+ CASE WHEN {test} THEN {1 << i} ELSE 0 END" for i, (_, test) in enumerate(quality.RULES))
_PATTERNS = "|".join(f"(?:{r.pattern})" for r in urls.PATTERN_RULES)
_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

ORACLES = {
    "op2_quality": rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, doc_id, t, list_filter(regexp_split_to_array(t, '{_WS}+'), lambda x: x <> '') AS ws,
      list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
p AS (SELECT r, ws, unnest(range(1, len(ws) - 3)) AS i FROM w WHERE len(ws) >= 5),
g AS (SELECT r, i, count(*) OVER (PARTITION BY r, array_to_string(ws[i:i+4], ' ')) AS n FROM p),
c AS (SELECT r, count(DISTINCT k) AS n_repeat_words FROM (SELECT r, unnest(range(i, i + 5)) AS k FROM g WHERE n > 1) GROUP BY r),
m AS (SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(regexp_replace(t, '{_WS}', '', 'g')) AS BIGINT) AS word_chars,
      CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
      CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words, len(ls) AS n_lines
      FROM w LEFT JOIN c USING (r)),
f AS (SELECT *, CAST(0 {_RULES} AS BIGINT) AS failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (failed & 3) <> 0 AS base_failed, failed = 0 AS kept, failed FROM f""",
    "op3_urls": rf"""
WITH p AS (SELECT page_id, url, translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's'), {_LOWER}) AS host,
           regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path, row_number() OVER () AS r FROM pages),
rules(rule, h, q, action) AS (VALUES ('com/', 'com', '/', 'allow'), ('example.com/en/', 'example.com', '/en/', 'block'), ('www.example.com/en/', 'www.example.com', '/en/', 'allow'), ('net/es/', 'net', '/es/', 'block'), ('net/fr/', 'net', '/fr/', 'block')),
b AS (SELECT r, arg_max(rule, length(rule)) AS rule, arg_max(action, length(rule)) AS action FROM p JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, q) GROUP BY r)
SELECT page_id, host, path, rule, CASE WHEN rule IS NOT NULL THEN action WHEN contains(coalesce(url, ''), '://') AND regexp_matches(lower(url), '{_PATTERNS}') THEN 'block' ELSE 'allow' END AS verdict
FROM p LEFT JOIN b USING (r)""",
    "op6_vectors": """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
n AS (SELECT vec_id, e, sqrt(list_dot_product(e, e)) AS norm FROM v),
l AS (SELECT a.vec_id AS x, b.vec_id AS y FROM n a JOIN n b ON a.vec_id <> b.vec_id AND list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.9),
reach AS (SELECT vec_id AS x, vec_id AS y FROM v UNION SELECT reach.x, l.y FROM reach JOIN l ON reach.y = l.x),
c AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x), k AS (SELECT x, count(*) AS n FROM l GROUP BY x)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, vec_id = component_id AS kept FROM v JOIN c ON c.x = vec_id LEFT JOIN k ON k.x = vec_id""",
    "op7_jaccard": rf"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), {_LOWER}), '{_WS}+'), lambda x: x <> '') AS ws FROM documents),
i AS (SELECT doc_id, ws, unnest(CASE WHEN len(ws) >= 5 THEN range(1, len(ws) - 3) WHEN len(ws) > 0 THEN [1] ELSE [] END) AS k FROM w),
s AS (SELECT DISTINCT doc_id, array_to_string(ws[k:k+4], ' ') AS g FROM i),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS o FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y FROM o JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * o >= 80 * (a.n + b.n - o)),
reach AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT reach.x, l.y FROM reach JOIN l ON reach.y = l.x),
c AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id FROM documents d JOIN c ON c.x = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id""",
    "op8_lines": rf"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
i AS (SELECT doc_id, unnest(ls) AS line, unnest(range(1, len(ls) + 1)) AS pos FROM d),
k AS (SELECT doc_id, line, pos, translate(regexp_replace(regexp_replace(line, '^{_WS}+', ''), '{_WS}+$', ''), {_LOWER}) AS key FROM i),
h AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
j AS (SELECT k.*, h.keeper IS NOT NULL AND h.keeper <> doc_id AS gone FROM k LEFT JOIN h USING (key))
SELECT doc_id, count(*) AS n_lines, CAST(count_if(gone) AS BIGINT) AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256 FROM j GROUP BY doc_id""",
}
