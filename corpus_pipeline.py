"""A training-corpus pipeline: toxicity, exact copies, near copies, mixing, encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as
Parquet and reads it again as the next stage's documents. All stages but the last return
the columns of the documents they got. A stage deletes what the operators of earlier stages
wrote for themselves, since it reads only its written documents. Rows are told apart by
doc_id and text:

- toxicity: rows with a toxicity score of 0.3 or more go.
- exact_dedup: of texts that are equal without white space the longest stays, then the
  one with the smallest doc_id; of wholly equal (doc_id, text) rows one stays.
- near_dedup: of each near-duplicate group the document with the smallest doc_id stays; rows with
  that doc_id and other texts stay or go by their own groups.
- mixing: low-quality text is thinned to half of its tokens; no row is repeated and the
  high-quality domain keeps its weight.
- encoding: ids of each remaining text, as digests, and its decoded text's digest.

Nulls count as empty texts; an empty table passes through every stage; extra columns are
kept until the last stage.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from oddlens.llm.common import ship, stage_tables, written
from oddlens.llm.exact_dedup import exact_groups
from oddlens.llm.mixing import mixed
from oddlens.llm.near_dedup import near_groups
from oddlens.llm.pieces import piece_digests
from oddlens.llm.toxicity import THRESHOLD, fit_toxicity, with_toxicity

PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")
#: Words of a near-duplicate shingle (the rule of stages; op7's own contract has four).
NEAR_WORDS = 5
#: Tokens of each domain after mixing, against before: factors of the input, no target weights.
#: Shares like op10's (85 % high) would need rows of high text repeated, or, with rates of at
#: most 1, most other text dropped from an input that has little high text.
FACTORS = {"high": 1.0, "low": 0.5, "toxic": 0.5}


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = fit_toxicity(docs, _labels(spark, sf_dir))
    scored = with_toxicity(docs, model, "__toxicity")
    return scored.where(F.col("__toxicity") < THRESHOLD).select(*(F.col(f"`{c}`") for c in docs.columns))


#: Stands for a null doc_id in keys, so that joins and windows share one partitioning.
_NO_ID = -(1 << 63)


def _keys(doc_id: str, text_hash: Column) -> tuple[Column, Column]:
    return F.coalesce(F.col(doc_id).cast("long"), F.lit(_NO_ID)).alias("__id"), text_hash.alias("__hash")


def _with_verdicts(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """Rows of ``docs``, with their keys, whose (doc_id, xxhash64 of the text) is in ``kept``."""
    keyed = docs.select("*", *_keys("doc_id", F.xxhash64(F.col("text").cast("string"))))
    return keyed.join(written(kept.select(*_keys("doc_id", F.col("text_hash"))), "kept"), ["__id", "__hash"], "left_semi")


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    rows = _with_verdicts(docs, exact_groups(docs).where("kept"))
    # Equal (doc_id, text) rows are one document; which of them stays follows their other columns.
    # The join has dealt the rows by the same keys, so this moves nothing.
    whole = Window.partitionBy("__id", "__hash").orderBy(F.xxhash64(*(F.col(f"`{c}`") for c in docs.columns)))
    return rows.withColumn("__at", F.row_number().over(whole)).where("__at = 1").select(*(F.col(f"`{c}`") for c in docs.columns))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return _with_verdicts(docs, near_groups(docs, NEAR_WORDS).where("kept")).select(*(F.col(f"`{c}`") for c in docs.columns))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixed(docs, _labels(spark, sf_dir), FACTORS, max_rate=1.0)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return piece_digests(docs, PIECE_MODEL)


def _tidy(stage: Callable) -> Callable:
    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        with stage_tables(docs):
            return stage(spark, docs, sf_dir)

    return run_stage


STAGES = [
    ("toxicity", _tidy(toxicity)),
    ("exact dedup", _tidy(exact_dedup)),
    ("near dedup", _tidy(near_dedup)),
    ("mixing", _tidy(mixing)),
    ("sentencepiece", _tidy(encoding)),
]

#: A trained classifier, MinHash and a tokenizer are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
