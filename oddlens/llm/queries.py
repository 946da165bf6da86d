"""One registered query per corpus operator, applied to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from oddlens.llm.alignment import aligned
from oddlens.llm.common import ship
from oddlens.llm.decontamination import contaminated
from oddlens.llm.exact_dedup import exact_groups
from oddlens.llm.language_model import language_scores
from oddlens.llm.line_rules import LEAST_SHARE, LEAST_WORDS, LIMIT, judged
from oddlens.llm.merkle import merkle_proofs
from oddlens.llm.mixing import mixing_rates
from oddlens.llm.near_dedup import near_groups
from oddlens.llm.pieces import piece_digests
from oddlens.llm.quality import quality_scores
from oddlens.llm.token_files import token_file_rows
from oddlens.llm.toxicity import toxicity_scores
from oddlens.llm.url_filter import judged_pages

PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")
WORD_MODEL = public_tokenizers.path("word_bpe_49k.json")
BYTE_MODEL = public_tokenizers.path("byte_bpe_50k.json")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents")


def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity_scores(documents(spark, folder), table(spark, folder, "labels"))


def op2_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality_scores(documents(spark, folder), table(spark, folder, "labels"))


def op3_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    return piece_digests(documents(spark, folder), PIECE_MODEL)


def op4_line_rules(spark: SparkSession, folder: str) -> DataFrame:
    return judged(documents(spark, folder))


def op5_token_files(spark: SparkSession, folder: str) -> DataFrame:
    return token_file_rows(documents(spark, folder), WORD_MODEL, end_id=2)


def op6_language_model(spark: SparkSession, folder: str) -> DataFrame:
    return language_scores(documents(spark, folder))


def op7_minhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_groups(documents(spark, folder)).drop("text_hash")


def op8_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return judged_pages(table(spark, folder, "pages"))


def op9_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_groups(documents(spark, folder)).drop("text_hash")


def op10_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing_rates(documents(spark, folder), table(spark, folder, "labels"), {"high": 0.85, "low": 0.12, "toxic": 0.03})


def op11_merkle_proofs(spark: SparkSession, folder: str) -> DataFrame:
    return merkle_proofs(documents(spark, folder))


def op12_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = contaminated(documents(spark, folder), table(spark, folder, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op13_tokenizer_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return aligned(documents(spark, folder), BYTE_MODEL, PIECE_MODEL)


OP9_SQL = r"""
WITH texts AS (
  SELECT doc_id, length(coalesce(text, '')) AS n_points,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS content
  FROM documents
), ranked AS (
  SELECT doc_id, content,
         first_value(doc_id) OVER (PARTITION BY content ORDER BY n_points DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY content) AS group_size
  FROM texts
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(content) AS text_sha256
FROM ranked
"""

OP4_SQL = rf"""
WITH texts AS (
  SELECT doc_id, source, coalesce(text, '') AS t FROM documents
), split AS (
  SELECT doc_id, source, t,
         list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM texts
), windows AS (
  SELECT doc_id, i, array_to_string(words[i:i+2], ' ') AS w
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM split)
), again AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w) AS n FROM windows) WHERE n > 1
), covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM again) GROUP BY doc_id
), counts AS (
  SELECT doc_id, source, t, len(words)::BIGINT AS n_words,
         length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM split LEFT JOIN covered USING (doc_id)
), plain AS (
  SELECT doc_id, source, t, list_filter(string_split(regexp_replace(translate(line,
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789', 'abcdefghijklmnopqrstuvwxyz0000000000'), '[\x09-\x0D]', ' ', 'g'), ' '), lambda w: w <> '') AS ws
  FROM (SELECT doc_id, source, t, unnest(string_split(t, chr(10))) AS line FROM texts)
), lined AS (
  SELECT doc_id, source, t, array_to_string(ws, ' ') AS line, len(ws) AS n FROM plain WHERE len(ws) > 0
), frequent AS (
  SELECT source, line FROM lined GROUP BY source, line HAVING count(DISTINCT t) > {LIMIT}
), lost AS (
  SELECT doc_id, sum(n)::BIGINT AS removed_words
  FROM lined JOIN frequent ON lined.line = frequent.line AND lined.source IS NOT DISTINCT FROM frequent.source GROUP BY doc_id
), judged AS (
  SELECT *, n_words < {LEAST_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed, coalesce(lost.removed_words, 0) AS removed
  FROM counts LEFT JOIN lost USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, removed AS removed_words,
       NOT base_failed AND n_words - removed >= {LEAST_WORDS} AND n_words - removed >= {LEAST_SHARE} * n_words AS kept
FROM judged
"""

QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_quality": op2_quality,
    "op3_sentencepiece": op3_sentencepiece,
    "op4_line_rules": op4_line_rules,
    "op5_token_files": op5_token_files,
    "op6_language_model": op6_language_model,
    "op7_minhash_dedup": op7_minhash_dedup,
    "op8_url_filter": op8_url_filter,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_mixing": op10_mixing,
    "op11_merkle_proofs": op11_merkle_proofs,
    "op12_decontamination": op12_decontamination,
    "op13_tokenizer_alignment": op13_tokenizer_alignment,
}
CHECKS = {"op4_line_rules": OP4_SQL, "op9_exact_dedup": OP9_SQL}
