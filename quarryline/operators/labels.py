"""Relevance labels: clean, check and join them to hits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarryline.functions.text import gold_query_id, graded_relevance
from quarryline.operators.scale import first_per_key

KEYS = ["query_id", "chunk_id"]


def nearest_hits(hits: DataFrame) -> DataFrame:
    """The hit with the lowest distance per (query, chunk); on ties the lower parameter value, then rank."""
    order = [F.col("dist").isNull(), F.col("dist"), F.col("param_value"), F.col("rank")]
    return first_per_key(hits, KEYS, order)


def truth_labels(labelled: DataFrame) -> DataFrame:
    """Highest readable relevance per (query, chunk); unreadable labels are 0, rows without a key are dropped."""
    clean = labelled.select(*KEYS, graded_relevance(F.col("relevance")).alias("relevance")).dropna(subset=KEYS)
    return clean.groupBy(*KEYS).agg(F.max("relevance").alias("relevance"))


def label_hits(hits: DataFrame, truth: DataFrame) -> DataFrame:
    """Left join on (gold query id, chunk id): adds ``gold_query_id``, ``query_id_truth``, ``relevance`` (0 if unjudged).

    Repeated truth keys count once, with their highest relevance. Neither side is hinted: Spark broadcasts the truth when its known size allows, and otherwise splits skewed
    partitions of the hits at run time.
    """
    judged = truth.groupBy(F.col("query_id").alias("query_id_truth"), F.col("chunk_id").alias("_chunk_id")).agg(
        F.max("relevance").alias("_rel")
    )
    known = hits.drop("relevance").withColumn("gold_query_id", gold_query_id(F.col("query_id")))
    match = (F.col("gold_query_id") == F.col("query_id_truth")) & (F.col("chunk_id") == F.col("_chunk_id"))
    joined = known.join(judged, match, "left")
    return joined.withColumn("relevance", F.coalesce("_rel", F.lit(0))).drop("_chunk_id", "_rel")
