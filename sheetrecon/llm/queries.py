"""Registered queries of the operators: each applies its operator with
production parameters to the whole table and returns the whole result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (byte_bpe, fuzzy_lines, html_tree, id_files, importance, merkle, ppm, quality, signature_trees, simhash,
               suffixes, superkmers, warc)
from .common import table


def op1_warc_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(table(spark, sf_dir, "pages"))


def op2_fuzzy_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fuzzy_lines.dedup_lines(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("text_sha256"))


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(table(spark, sf_dir, "documents"))


def op4_byte_level_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.token_digests(table(spark, sf_dir, "documents"))


def op5_ppm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm.scores(table(spark, sf_dir, "documents"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(table(spark, sf_dir, "documents"))


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_token_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return id_files.id_files(table(spark, sf_dir, "documents"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = superkmers.dedup_substrings(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_tree.extract(table(spark, sf_dir, "pages"))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_signature_tree_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signature_trees.jaccard_groups(table(spark, sf_dir, "documents"))


def tampered_text():
    """The text without its line breaks where 2 divides the crc32 of the decimal doc_id."""
    odd = F.crc32(F.col("`doc_id`").cast("string").cast("binary")) % 2
    return F.when(odd == 0, F.replace(F.col("`text`"), F.lit("\n"), F.lit(""))).otherwise(F.col("`text`"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verified(table(spark, sf_dir, "documents"), tampered_text())


QUERIES = {
    "op1_warc_bundles": op1_warc_bundles,
    "op2_fuzzy_line_dedup": op2_fuzzy_line_dedup,
    "op3_simhash_near_dedup": op3_simhash_near_dedup,
    "op4_byte_level_bpe": op4_byte_level_bpe,
    "op5_ppm_scoring": op5_ppm_scoring,
    "op6_quality_rules": op6_quality_rules,
    "op7_benchmark_decontamination": op7_benchmark_decontamination,
    "op8_token_id_files": op8_token_id_files,
    "op9_html_extraction": op9_html_extraction,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_importance_resampling": op11_importance_resampling,
    "op12_signature_tree_join": op12_signature_tree_join,
    "op13_merkle_manifest": op13_merkle_manifest,
}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_ITEM_WORDS = f"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), " \
              r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

#: DuckDB SQL of the queries that SQL can express; the others are tested against
#: brute force, the libraries themselves, round trips or held-out texts.
ORACLE: dict[str, str] = {
    "op1_warc_bundles": """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
q AS (SELECT page_id, h, octet_length(encode(h)) AS n, max(page_id) OVER (PARTITION BY h) AS holder FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, sha1(h) AS payload_digest,
  CASE WHEN n >= 1000 AND page_id <> holder THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 1000 AND page_id <> holder THEN holder END AS refers_to FROM q""",
    "op7_benchmark_decontamination": f"""
WITH d AS (SELECT doc_id, {_ITEM_WORDS} AS w FROM documents),
b AS (SELECT row_number() OVER () AS nth, CAST(item_id AS VARCHAR) AS item, {_ITEM_WORDS} AS w FROM benchmark),
bw AS (SELECT nth, item, k, i AS b_i, array_to_string(w[i:i + k - 1], ' ') AS win FROM (
  SELECT nth, item, w, least(13, len(w)) AS k, unnest(generate_series(1, len(w) - least(13, len(w)) + 1)) AS i
  FROM b WHERE len(w) > 0)),
dw AS (SELECT doc_id, i, k, array_to_string(w[i:i + k - 1], ' ') AS win FROM (
  SELECT doc_id, w, k, unnest(generate_series(1, len(w) - k + 1)) AS i
  FROM d, (SELECT DISTINCT k FROM bw) WHERE len(w) >= k)),
m AS (SELECT doc_id, i, dw.k, nth, item, b_i FROM dw JOIN bw ON dw.k = bw.k AND dw.win = bw.win),
r AS (SELECT doc_id, item, min(i) AS i, min(b_i) AS b_i, count(*) + k - 1 AS n FROM (
  SELECT *, i - row_number() OVER (PARTITION BY doc_id, nth, i - b_i ORDER BY i) AS g FROM m)
  GROUP BY doc_id, nth, item, k, i - b_i, g),
l AS (SELECT doc_id, item AS longest_item, i - 1 AS longest_word, b_i - 1 AS longest_item_word, n FROM r
  QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, item, i, b_i) = 1),
h AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (
  SELECT doc_id, unnest(generate_series(i, i + k - 1)) AS pos FROM m) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS digest
  FROM (SELECT DISTINCT doc_id, item FROM m) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  coalesce(digest, sha256('')) AS items_sha256,
  coalesce(n_hit > 0 AND 20 * n_hit >= len(w), false) AS contaminated,
  CAST(coalesce(n, 0) AS BIGINT) AS longest_words, longest_item, longest_word, longest_item_word
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id) LEFT JOIN l USING (doc_id)""",
    "op10_substring_dedup": r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS win FROM (
  SELECT doc_id, w, unnest(generate_series(1, len(w) - 19)) AS i FROM d WHERE len(w) >= 20)),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY win ORDER BY doc_id, i) AS n
  FROM s) WHERE n > 1),
g AS (SELECT doc_id, list(DISTINCT pos) AS gone FROM (
  SELECT doc_id, unnest(generate_series(i, i + 19)) AS pos FROM r) GROUP BY doc_id),
k AS (SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS kept FROM (
  SELECT d.doc_id, unnest(w) AS word, unnest(generate_series(1, len(w))) AS pos FROM d) p
  WHERE NOT EXISTS (SELECT 1 FROM (SELECT doc_id, unnest(gone) AS pos FROM g) z
                    WHERE z.doc_id = p.doc_id AND z.pos = p.pos) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN g USING (doc_id) LEFT JOIN k USING (doc_id)""",
}
