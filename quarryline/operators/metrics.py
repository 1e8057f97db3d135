"""Precision, average precision and (n)DCG at k over ranked, graded hits.

Scores only need the first ``k`` rows of a query and a histogram of its grades. Both come from one de-duplicated
aggregate, so a query with very many hits never gathers in one task; ``ranked_list`` is the full list when it is
wanted itself. All functions take ``keys`` so that many runs are scored in one job.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarryline.operators.scale import number_rows, top_k

QUERY = ("query_id",)
RELEVANT_ABOVE = 1  # fixed value: grades 2 and 3 count as relevant


def _distinct_hits(hits: DataFrame, keys: Sequence[str], rank_col: str) -> DataFrame:
    """One row per (keys, chunk): the best rank, ties by the lower grade; null grades are 0."""
    grade = F.coalesce(F.col("relevance").cast("int"), F.lit(0))
    place = F.struct(F.col(rank_col).isNull().alias("last"), F.col(rank_col).alias("rank"), grade.alias("relevance"))
    best = hits.groupBy(*keys, "chunk_id").agg(F.min(place).alias("place"))
    return best.select(*keys, "chunk_id", F.col("place.rank").alias("rank"), F.col("place.relevance").alias("relevance"))


def _rank_order() -> list[Column]:
    return [F.asc_nulls_last("rank"), F.col("chunk_id")]


def ranked_list(
    hits: DataFrame, keys: Sequence[str] = QUERY, rank_col: str = "rank", rows_per_query: int | None = None
) -> DataFrame:
    """De-duplicated hits with contiguous ranks from 1: (keys, chunk_id, relevance, rank)."""
    distinct = _distinct_hits(hits, keys, rank_col)
    return number_rows(distinct, list(keys), _rank_order(), "_rank", rows_per_query).select(
        *keys, "chunk_id", "relevance", F.col("_rank").alias("rank")
    )


def _gain(relevance: Column, position: Column) -> Column:
    return (F.pow(F.lit(2.0), relevance) - 1) / F.log2(position + 1)


def query_scores(
    hits: DataFrame, k: int, keys: Sequence[str] = QUERY, rank_col: str = "rank", ideal: bool = True
) -> DataFrame:
    """(keys, dcg_value, ndcg_value, precision_at_k, average_precision), one row per query; no ndcg without ``ideal``.

    The ideal order is that of the retrieved rows of the query. Precision divides by ``k``; average precision by the
    relevant rows among the first ``k``. Rows without a key are dropped.
    """
    keys = list(keys)
    distinct = _distinct_hits(hits.dropna(subset=keys), keys, rank_col)
    top = top_k(distinct, keys, _rank_order(), k, "position", spread="chunk_id")
    relevant = (F.col("relevance") > RELEVANT_ABOVE).cast("int")
    so_far = Window.partitionBy(*keys).orderBy("position").rowsBetween(Window.unboundedPreceding, 0)
    top = top.withColumn("relevant", relevant).withColumn("found", F.sum("relevant").over(so_far))
    found = F.sum("relevant")
    precision_sum = F.sum(F.when(F.col("relevant") == 1, F.col("found") / F.col("position")).otherwise(F.lit(0.0)))
    actual = top.groupBy(*keys).agg(
        F.sum(_gain(F.col("relevance"), F.col("position"))).alias("dcg_value"),
        (found / F.lit(k)).alias("precision_at_k"),
        F.when(found > 0, F.try_divide(precision_sum, found)).otherwise(F.lit(0.0)).alias("average_precision"),
    )

    if not ideal:
        return actual
    # Ideal list: the grades of the query in descending order, so each grade fills a run of positions.
    grades = distinct.groupBy(*keys, "relevance").agg(F.count("*").alias("n"))
    above = Window.partitionBy(*keys).orderBy(F.desc("relevance")).rowsBetween(Window.unboundedPreceding, 0)
    runs = grades.withColumn("last", F.least(F.sum("n").over(above), F.lit(k)))
    runs = runs.withColumn("first", F.sum("n").over(above) - F.col("n") + 1).where(F.col("first") <= k)
    discount = F.aggregate(
        F.sequence(F.col("first"), F.col("last")), F.lit(0.0), lambda acc, i: acc + F.lit(1.0) / F.log2(i + 1)
    )
    run_gain = (F.pow(F.lit(2.0), F.col("relevance")) - 1) * discount
    best = runs.groupBy(*keys).agg(F.sum(run_gain).alias("ideal_dcg"))

    ndcg = F.when(F.col("ideal_dcg") > 0, F.try_divide("dcg_value", "ideal_dcg")).otherwise(F.lit(0.0))
    return actual.join(best, keys).select(
        *keys, "dcg_value", ndcg.alias("ndcg_value"), "precision_at_k", "average_precision"
    )


def dcg(hits: DataFrame, k: int, keys: Sequence[str] = QUERY, rank_col: str = "rank") -> DataFrame:
    return query_scores(hits, k, keys, rank_col, ideal=False).select(*keys, "dcg_value")


def ndcg(hits: DataFrame, k: int, keys: Sequence[str] = QUERY, rank_col: str = "rank") -> DataFrame:
    return query_scores(hits, k, keys, rank_col).select(*keys, "ndcg_value", "dcg_value")


def precision(hits: DataFrame, k: int, keys: Sequence[str] = QUERY, rank_col: str = "rank") -> DataFrame:
    return query_scores(hits, k, keys, rank_col, ideal=False).select(*keys, "precision_at_k")


def average_precision(hits: DataFrame, k: int, keys: Sequence[str] = QUERY, rank_col: str = "rank") -> DataFrame:
    return query_scores(hits, k, keys, rank_col, ideal=False).select(*keys, "average_precision")


def precision_scores(hits: DataFrame, k: int, keys: Sequence[str] = QUERY, rank_col: str = "rank") -> DataFrame:
    return query_scores(hits, k, keys, rank_col, ideal=False).select(*keys, "precision_at_k", "average_precision")


def summarize(hits: DataFrame, k: int, run_col: str = "run", rank_col: str = "rank") -> DataFrame:
    """Means over the queries of each run: (run, p_at_k, map_at_k, ndcg_at_k, dcg_at_k)."""
    scores = query_scores(hits, k, (run_col, *QUERY), rank_col)
    return scores.groupBy(run_col).agg(
        F.avg("precision_at_k").alias("p_at_k"),
        F.avg("average_precision").alias("map_at_k"),
        F.avg("ndcg_value").alias("ndcg_at_k"),
        F.avg("dcg_value").alias("dcg_at_k"),
    )


SUMMARY = ("p_at_k", "map_at_k", "ndcg_at_k", "dcg_at_k")


def compare_runs(*summaries: DataFrame, decimals: int = 4) -> DataFrame:
    """Stack run summaries into one table, rounded for display."""
    stacked = reduce(DataFrame.unionByName, summaries)
    return stacked.select("run", *[F.round(m, decimals).alias(m) for m in SUMMARY])


def run_delta(summary: DataFrame, run: str, baseline: str, decimals: int = 4) -> DataFrame:
    """One row: metrics of ``run`` minus those of ``baseline``; empty unless both runs are there."""
    sign = F.when(F.col("run") == run, 1).when(F.col("run") == baseline, -1)
    both = summary.where(F.col("run").isin(run, baseline))
    delta = both.agg(F.count("*").alias("_n"), *[F.sum(sign * F.col(m)).alias(m) for m in SUMMARY])
    return delta.where(F.col("_n") == 2).select(
        F.lit(f"{run} - {baseline}").alias("run"), *[F.round(m, decimals).alias(m) for m in SUMMARY]
    )
