"""The cleaning and packing pipeline over ``documents``.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage before it kept. All but the last return
the columns of ``documents``; the last returns the packed pieces. A stage's result is written as Parquet before the next
one reads it.

Nulls: a null text counts as empty; a null id is kept like any other, except that packing orders it first. Repeated rows
are near duplicates of each other, so one stays; texts without a word are never duplicates. Further columns of ``docs``
pass through, whatever they are called. Empty input gives empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarryline.llm import bpe, jaccard, packing, quality, secrets, toxicity
from quarryline.llm.queries import BYTE_BPE
from quarryline.llm.rows import free_name, small_batches
from quarryline.session import stage


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def _batched(function):
    """Every stage moves texts in small Arrow batches."""

    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        small_batches(spark)
        return function(spark, docs, sf_dir)

    return run_stage


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose Bradley-Terry score reaches the threshold stay."""
    model, name = quality.train(docs, _labels(spark, sf_dir)), free_name(docs, "_score")
    return docs.withColumn(name, quality.score_column(model, F.col("text"))).where(F.col(name) >= quality.KEEP).drop(name)


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are more likely clean than toxic stay."""
    model, name = toxicity.train(docs, _labels(spark, sf_dir)), free_name(docs, "_toxic")
    scored = docs.withColumn(name, toxicity.severity_columns(model, F.col("text")))
    return scored.where(F.col(name)["p_toxic"] < 0.5).drop(name)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id stays."""
    return jaccard.keep_one(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays, with the secrets in its text masked."""
    return secrets.redact(docs, secrets.train(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, bpe.public_file(BYTE_BPE))


STAGES = [
    ("quality_classifier", _batched(quality_filter)),
    ("toxicity", _batched(toxicity_filter)),
    ("ngram_jaccard_join", _batched(one_of_each_group)),
    ("secret_scans", _batched(redact_secrets)),
    ("best_fit_packing", _batched(pack)),
]
# Learned models and automata have no SQL form; tests/llm/test_pipeline.py has a brute-force version of the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, function in STAGES:
        docs = stage(function(spark, docs, sf_dir))
    return docs
