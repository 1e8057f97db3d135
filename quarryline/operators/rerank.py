"""Reranking of hits, and the text block handed to a query rewriter."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarryline.functions.text import tokens
from quarryline.operators.scale import small_join, top_k
from quarryline.session import stage

Scorer = Callable[[Column, Column], Column]


def term_coverage(query_text: Column, chunk_text: Column) -> Column:
    """Share of the distinct query terms that the chunk contains; 0 for a query without terms."""
    terms = F.array_distinct(tokens(query_text))
    shared = F.size(F.array_intersect(terms, tokens(chunk_text)))
    return F.when(F.size(terms) > 0, shared / F.size(terms)).otherwise(F.lit(0.0))


def rerank(hits: DataFrame, scorer: Scorer = term_coverage, k: int = 10, queries: DataFrame | None = None) -> DataFrame:
    """Score each (query_text, chunk_text), keep the best ``k`` per query; adds ``rerank_score``, ``rank_reranked``.

    ``scorer`` builds a Column from the two texts: an expression, or a Pandas UDF around a model. Every row of a
    query is scored with one text: that of ``queries`` (query_id, query_text), which costs no pass over the hits, or
    else that of its best-ranked row, for which the hits are staged. Equal scores keep the old order.
    """
    if queries is None:
        hits = stage(hits)
        first = F.struct(F.col("rank").isNull(), F.col("rank"), F.col("chunk_id"))
        asked = hits.groupBy("query_id").agg(F.min_by("query_text", first).alias("_asked"))
    else:
        asked = queries.select(F.col("query_id").cast("string").alias("query_id"), F.col("query_text").alias("_asked"))
    named = small_join(hits, asked, ["query_id"], spread="chunk_id")
    scored = named.withColumn("rerank_score", scorer(F.col("_asked"), F.col("chunk_text")))
    order = [F.desc(F.round("rerank_score", 9)), F.asc_nulls_last("rank"), F.col("chunk_id")]
    return top_k(scored.drop("_asked"), ["query_id"], order, k, "rank_reranked", spread="chunk_id")


def retrieved_context(hits: DataFrame, k: int = 3) -> DataFrame:
    """(query_id, context): ``Chunk i:`` and its text for the ``k`` best-ranked rows, numbered by position."""
    best = top_k(hits, ["query_id"], [F.asc_nulls_last("rank"), F.col("chunk_id")], k, "position", spread="chunk_id")
    text = F.concat(F.lit("Chunk "), F.col("position").cast("string"), F.lit(":\n"), F.col("chunk_text"))
    ordered = F.array_sort(F.collect_list(F.struct("position", text.alias("text"))))  # at most k entries
    joined = F.array_join(F.transform(ordered, lambda x: x["text"]), "\n\n")
    return best.groupBy("query_id").agg(joined.alias("context"))
