"""The registered queries of the operators, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspan.llm import decontamination, exact_dedup, html_extraction, jaccard_join, line_dedup, packing, pii, suffix_dedup, toxicity, warc

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
#: Rows with at least this score are toxic.
TOXIC_SCORE = 0.3


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.line_dedup(table(spark, sf_dir, "documents"))
    return found.withColumn("kept_sha256", F.sha2("text", 256)).drop("text")


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = packing.tokenised(table(spark, sf_dir, "documents"), TOKENIZER)
    return packing.pack(tokens, with_ids=False).withColumnRenamed("id", "doc_id")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.withColumn("predicted", (F.col("score") >= TOXIC_SCORE).cast("int"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The key is for tests; a deployment sets its own in spark.larkspan.pii.key."""
    key = spark.conf.get("spark.larkspan.pii.key", "larkspan test key")
    return pii.pseudonymised(table(spark, sf_dir, "documents"), key)


def op7_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents"))


def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.read_packages(warc.write_packages(table(spark, sf_dir, "pages")), with_payload=False).withColumnRenamed("id", "page_id")


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extraction.extract(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def op10_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.suffix_dedup(table(spark, sf_dir, "documents")).withColumn("n_spans", F.size("spans").cast("long")).drop("spans")


OP2_SQL = r"""
WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS h FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY h) AS keep_id, count(*) OVER (PARTITION BY h) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY h) AS kept, h AS text_sha256,
       min(doc_id) OVER (PARTITION BY h) <= (SELECT (min(doc_id) + max(doc_id)) // 2 FROM documents) AS in_history
FROM d
"""

OP4_SQL = """
WITH p AS (SELECT page_id, url, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
     m AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS first FROM p)
SELECT page_id, coalesce(nullif(url, ''), 'urn:page:' || page_id) AS url, octet_length(encode(html)) AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         ((('0x' || substr(h, CAST((i // 4) * 5 + 1 AS BIGINT), 5))::INT >> (15 - 5 * (i % 4))::INT) & 31) + 1, 1)), '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM m
"""

OP1_SQL = r"""
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS raw, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents),
     k AS (SELECT doc_id, i, raw, trim(regexp_replace(raw, '[\x20\x09-\x0D]+', ' ', 'g')) AS key FROM l),
     w AS (SELECT doc_id, i, n, key AS k1, lead(key, 1) OVER d AS k2, lead(key, 2) OVER d AS k3, n + lead(n, 1) OVER d AS n2
           FROM (SELECT *, CASE WHEN key = '' THEN 0 ELSE len(string_split(key, ' ')) END AS n FROM k) WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
     r AS (SELECT doc_id, i, 3 AS length, row_number() OVER (PARTITION BY k1, k2, k3 ORDER BY doc_id, i) AS turn FROM w WHERE k3 IS NOT NULL
           UNION ALL SELECT doc_id, i, 2, row_number() OVER (PARTITION BY k1, k2 ORDER BY doc_id, i) FROM w WHERE n2 >= 50
           UNION ALL SELECT doc_id, i, 1, row_number() OVER (PARTITION BY k1 ORDER BY doc_id, i) FROM w WHERE n >= 50),
     gone AS (SELECT DISTINCT doc_id, i + unnest(range(length)) AS i FROM r WHERE turn > 1),
     m AS (SELECT k.doc_id, k.i, k.raw, gone.i IS NOT NULL AS off, lag(gone.i IS NOT NULL, 1, false) OVER (PARTITION BY k.doc_id ORDER BY k.i) AS before
           FROM k LEFT JOIN gone ON k.doc_id = gone.doc_id AND k.i = gone.i)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (off) AS n_removed, count(*) FILTER (off AND NOT before) AS n_runs,
       sha256(coalesce(string_agg(raw, chr(10) ORDER BY i) FILTER (NOT off), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""

OP7_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
     s AS (SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
                  ELSE list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))) END AS sh FROM w),
     e AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS h FROM s),
     l AS (SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.h = b.h AND a.doc_id <> b.doc_id GROUP BY ALL HAVING 100 * count(*) >= 80 * (any_value(a.n) + any_value(b.n) - count(*))),
     r AS (SELECT doc_id AS node, doc_id AS top FROM s UNION SELECT r.node, l.b FROM r JOIN l ON l.a = r.top)
SELECT node AS doc_id, any_value(len(sh)) AS n_shingles, min(top) AS component_id FROM r JOIN s ON s.doc_id = r.node GROUP BY node
"""
