"""Queries over the given tables, one per operator, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import (
    chat_format, decontamination, hard_negatives, html_extraction, language_id, license_scan, near_dedup, packing, prefix_trie,
    quality_rules, secret_scan, sharding, warc,
)
from tidemark.llm.workers import let_workers_import


def public_tokenizer(name: str = "word_bpe_49k.json") -> str:
    """Place of a public vocabulary file; it is never copied."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    let_workers_import(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    pages = _table(spark, folder, "pages").select("page_id", "url", "html")
    return html_extraction.extract_main_text(pages)


def op2_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan.scan_licenses(_table(spark, folder, "documents"))


def op3_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.archive_pages(_table(spark, folder, "pages"), min_revisit_bytes=0)


def op4_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    ratios = secret_scan.train(secret_scan.labelled_samples(spark))
    return secret_scan.span_digest(secret_scan.scan_secrets(docs, ratios))


def op5_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(_table(spark, folder, "documents"), public_tokenizer())


def op6_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard_documents(_table(spark, folder, "documents"), 24)[0]


def op7_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.near_duplicates(_table(spark, folder, "documents"))


def op8_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    leaks = decontamination.find_leaks(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))
    return leaks.withColumn("coverage", F.round("coverage", 6))


def op9_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    convs = chat_format.conversations(_table(spark, folder, "conversations"))
    return chat_format.format_preferences(chat_format.with_cut_answer(convs)).select(
        "conv_id", "n_shared", "prompt", "chosen", "rejected", "chosen_mask", "rejected_mask"
    )


def op10_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.quality_rules(_table(spark, folder, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "n_lines", "n_removed", F.round("kept_share", 6).alias("kept_share"),
    )


def op11_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    turns, convs = prefix_trie.splice(prefix_trie.number_turns(_table(spark, folder, "conversations")))
    return prefix_trie.prefix_trie(turns, convs)


def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    rows = hard_negatives.scaled(_table(spark, folder, "embeddings"))
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine_hard_negatives(rows.withColumn("label", moved), "vec_id % 100 = 0")


def op13_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").withColumn("held_out", language_id.held_out(F.col("doc_id")))
    # an id that is null has no remainder, and none that is 1: its row is learned from, and not held out
    profiles = language_id.learn_profiles(docs.where("not held_out").select("text", "lang"))
    return language_id.identify(docs, profiles, carry=["doc_id", "held_out"])


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_html_extraction, op2_license_scan, op3_warc, op4_secret_scan, op5_packing, op6_sharding, op7_near_dedup,
        op8_decontamination, op9_chat_format, op10_quality_rules, op11_prefix_trie,
        op12_hard_negatives, op13_language_id,
    )
}

_CHAT = """
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn, coalesce(role, ''), coalesce(text, '')) - 1 AS pos
  FROM conversations
),
sides AS (
  SELECT t.conv_id, t.role, t.pos, t.text AS chosen,
    CASE WHEN t.pos = l.last
      THEN array_to_string(string_split(t.text, ' ')[1:CAST(floor(len(string_split(t.text, ' ')) / 2) AS INTEGER)], ' ')
      ELSE t.text END AS rejected
  FROM turns t JOIN (
    SELECT conv_id, max(CASE WHEN role = 'assistant' THEN pos END) AS last FROM turns GROUP BY conv_id
  ) l ON l.conv_id IS NOT DISTINCT FROM t.conv_id
),
shared AS (
  SELECT conv_id, coalesce(min(pos) FILTER (chosen <> rejected), count(*)) AS n_shared FROM sides GROUP BY conv_id
),
rendered AS (
  SELECT s.conv_id, s.role, s.pos, n.n_shared,
    '<|im_start|>' || s.role || chr(10) || s.chosen || '<|im_end|>' || chr(10) AS chosen,
    '<|im_start|>' || s.role || chr(10) || s.rejected || '<|im_end|>' || chr(10) AS rejected
  FROM sides s JOIN shared n ON n.conv_id IS NOT DISTINCT FROM s.conv_id
),
placed AS (
  SELECT *,
    coalesce(sum(length(chosen)) FILTER (pos >= n_shared) OVER before, 0) AS chosen_at,
    coalesce(sum(length(rejected)) FILTER (pos >= n_shared) OVER before, 0) AS rejected_at
  FROM rendered
  WINDOW before AS (PARTITION BY conv_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
)
SELECT conv_id, CAST(max(n_shared) AS INTEGER) AS n_shared,
  coalesce(string_agg(chosen, '' ORDER BY pos) FILTER (pos < n_shared), '') AS prompt,
  coalesce(string_agg(chosen, '' ORDER BY pos) FILTER (pos >= n_shared), '') AS chosen,
  coalesce(string_agg(rejected, '' ORDER BY pos) FILTER (pos >= n_shared), '') AS rejected,
  coalesce(string_agg(
    CAST(CAST(chosen_at + 13 + length(role) AS BIGINT) AS VARCHAR) || ':'
      || CAST(CAST(chosen_at + length(chosen) - 1 AS BIGINT) AS VARCHAR), ',' ORDER BY pos)
    FILTER (pos >= n_shared AND role = 'assistant'), '') AS chosen_mask,
  coalesce(string_agg(
    CAST(CAST(rejected_at + 13 + length(role) AS BIGINT) AS VARCHAR) || ':'
      || CAST(CAST(rejected_at + length(rejected) - 1 AS BIGINT) AS VARCHAR), ',' ORDER BY pos)
    FILTER (pos >= n_shared AND role = 'assistant'), '') AS rejected_mask
FROM placed GROUP BY conv_id"""

_NEGATIVES = """
WITH fit AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS code
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF coalesce(isfinite(x), false)]) = len(embedding)
),
scores AS (
  SELECT a.vec_id AS anchor_id, x.vec_id AS vec_id, a.label = x.label AS same,
    CAST(list_inner_product(a.code, x.code) AS BIGINT) AS score
  FROM fit a JOIN fit x ON a.vec_id % 100 = 0
),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same AND vec_id <> anchor_id
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, p.positive_id,
  CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.vec_id) AS INTEGER) AS rank,
  n.vec_id AS negative_id, p.positive_score, n.score AS negative_score
FROM positives p JOIN scores n
  ON n.anchor_id = p.anchor_id AND NOT n.same
  AND 80 * p.positive_score <= 100 * n.score AND n.score <= p.positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.vec_id) <= 5"""

_TRIE = """
WITH RECURSIVE turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (
      PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS pos
  FROM conversations WHERE conv_id IS NOT NULL
),
crc_step AS (
  SELECT i AS byte, 0 AS k, CAST(i AS BIGINT) AS v FROM range(256) r(i)
  UNION ALL
  SELECT byte, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, CAST(3988292384 AS BIGINT)) ELSE v >> 1 END
  FROM crc_step WHERE k < 8
),
digits AS (SELECT DISTINCT conv_id, CAST(conv_id AS VARCHAR) AS word FROM turns),
crc AS (
  SELECT conv_id, word, 1 AS k, CAST(4294967295 AS BIGINT) AS v FROM digits
  UNION ALL
  SELECT c.conv_id, c.word, c.k + 1, xor(c.v >> 8, t.v)
  FROM crc c JOIN crc_step t ON t.k = 8 AND t.byte = xor(c.v, CAST(ascii(substr(c.word, c.k, 1)) AS BIGINT)) & 255
  WHERE c.k <= length(c.word)
),
convs AS (
  SELECT c.conv_id, c.conv_id - c.conv_id % 5 AS base, xor(c.v, CAST(4294967295 AS BIGINT)) % 9 AS h,
    (SELECT count(*) FROM turns t WHERE t.conv_id = c.conv_id - c.conv_id % 5) AS n_base
  FROM crc c WHERE c.k = length(c.word) + 1
),
rebuilt AS (
  SELECT c.conv_id, t.pos, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.base AND t.pos < c.h
  UNION ALL
  SELECT c.conv_id, t.pos - c.h + least(c.h, c.n_base), t.role, t.text
  FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.pos >= c.h
),
steps AS (
  SELECT conv_id, pos + 1 AS depth, strlen(text) AS n_bytes,
    string_agg(sha256(length(role) || ':' || role || text), '') OVER (
      PARTITION BY conv_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS path,
    pos + 1 = count(*) OVER (PARTITION BY conv_id) AS is_last
  FROM rebuilt
  UNION ALL
  SELECT conv_id, 0, 0, '', conv_id NOT IN (SELECT conv_id FROM rebuilt) FROM convs
),
nodes AS (
  SELECT path, any_value(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
    (count(*) - 1) * any_value(n_bytes) AS saved,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (is_last), '')) AS ends_sha256
  FROM steps GROUP BY path
),
kids AS (SELECT left(path, 64 * (depth - 1)) AS path, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1),
sums AS (
  SELECT left(n.path, 64 * a.up) AS path, sum(n.saved) AS saved, count(*) FILTER (k.n IS NULL) AS leaves
  FROM (SELECT *, unnest(range(CAST(depth + 1 AS BIGINT))) AS up FROM nodes) a
    JOIN nodes n ON n.path = a.path LEFT JOIN kids k ON k.path = n.path
  GROUP BY 1
)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, n.n_convs,
  CAST(coalesce(k.n, 0) AS BIGINT) AS n_children, CAST(s.leaves AS BIGINT) AS n_leaves,
  CAST(s.saved AS BIGINT) AS saved_tokens, n.ends_sha256
FROM nodes n JOIN sums s ON s.path = n.path
  LEFT JOIN kids k ON k.path = n.path
  LEFT JOIN nodes p ON n.depth > 0 AND p.path = left(n.path, 64 * (n.depth - 1))"""

ORACLE: dict[str, str] = {"op9_chat_format": _CHAT, "op11_prefix_trie": _TRIE, "op12_hard_negatives": _NEGATIVES}
