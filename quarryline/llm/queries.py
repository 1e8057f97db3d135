"""The registered queries of this subpackage: each operator, with production parameters, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarryline.llm import bpe, caps, jaccard, licenses, merkle, mixing, oracles, packing, periods, quality, repair, secrets, topk, toxicity
from quarryline.llm.rows import documents

Query = Callable[[SparkSession, str], DataFrame]
BYTE_BPE, WORD_BPE = "byte_bpe_50k.json", "word_bpe_49k.json"


def op1(spark: SparkSession, sf: str) -> DataFrame:
    return repair.round_trip(documents(spark, sf), bpe.public_file(WORD_BPE))


def op2(spark: SparkSession, sf: str) -> DataFrame:
    return topk.search(spark.read.parquet(f"{sf}/embeddings.parquet"), F.col("vec_id") % 100 == 0)


def op3(spark: SparkSession, sf: str) -> DataFrame:
    docs = documents(spark, sf)
    return secrets.scan(docs, secrets.train(docs))


def op4(spark: SparkSession, sf: str) -> DataFrame:
    return jaccard.join(documents(spark, sf)).select("doc_id", "class_id", "n_links", "kept")


def op5(spark: SparkSession, sf: str) -> DataFrame:
    return licenses.scan(documents(spark, sf))


def op6(spark: SparkSession, sf: str) -> DataFrame:
    return caps.near_duplicates(spark.read.parquet(f"{sf}/embeddings.parquet"))


def op7(spark: SparkSession, sf: str) -> DataFrame:
    return bpe.digests(documents(spark, sf), bpe.public_file(BYTE_BPE))


def op8(spark: SparkSession, sf: str) -> DataFrame:
    docs = documents(spark, sf)
    return toxicity.score_documents(docs, toxicity.train(docs, spark.read.parquet(f"{sf}/labels.parquet")))


def op9(spark: SparkSession, sf: str) -> DataFrame:
    docs = documents(spark, sf)
    return quality.score_documents(docs, quality.train(docs, spark.read.parquet(f"{sf}/labels.parquet")))


def op10(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf), bpe.public_file(BYTE_BPE))


def op11(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mix_documents(documents(spark, sf))


def op12(spark: SparkSession, sf: str) -> DataFrame:
    return merkle.document_manifest(documents(spark, sf))


def op13(spark: SparkSession, sf: str) -> DataFrame:
    return periods.document_runs(documents(spark, sf))


QUERIES: dict[str, Query] = {
    "op1_repair_ids": op1, "op2_topk": op2, "op3_secrets": op3, "op4_jaccard_join": op4, "op5_licenses": op5, "op6_caps": op6,
    "op7_bpe": op7, "op8_toxicity": op8, "op9_quality": op9, "op10_packing": op10,
    "op11_mixing": op11, "op12_merkle": op12, "op13_periods": op13,
}


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return oracles.oracle_sql()
