"""Weighted reciprocal rank fusion and hybrid search."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarryline.operators.keyword import KeywordIndex, bm25_top_k
from quarryline.operators.scale import first_per_key, number_rows
from quarryline.operators.vector import CellIndex, cell_top_k, exact_sweep

KEYS = ["query_id", "query_text", "chunk_id", "chunk_text"]


def reciprocal_rank_fusion(
    vector: DataFrame,
    keyword: DataFrame,
    rrf_k: int = 60,
    a: float = 0.5,
    b: float = 0.5,
    rows_per_query: int | None = None,
) -> DataFrame:
    """Sum ``weight / (rrf_k + rank)`` over both hit tables and rank the chunks of each query.

    An unreadable rank adds nothing; rows with a null key are dropped. If a (query, chunk) pair occurs with several
    texts, the lowest (query_text, chunk_text) is kept with its own score. ``rows_per_query`` is a bound the caller
    knows; without one, ranking does not rely on a query fitting into one task.
    """

    def weighed(hits: DataFrame, weight: float) -> DataFrame:
        rank = F.col("rank").cast("string").try_cast("double")
        return hits.select(*KEYS, F.try_divide(F.lit(float(weight)), F.lit(rrf_k) + rank).alias("part")).dropna(subset=KEYS)

    parts = weighed(vector, a).unionByName(weighed(keyword, b))
    fused = parts.groupBy(*KEYS).agg(F.coalesce(F.sum(F.when(~F.isnan("part"), F.col("part"))), F.lit(0.0)).alias("score"))
    kept = first_per_key(fused, ["query_id", "chunk_id"], [F.col("query_text"), F.col("chunk_text")])
    order = [F.desc(F.round("score", 9)), F.col("query_text"), F.col("chunk_id")]
    return number_rows(kept, ["query_id"], order, "rank", rows_per_query).select(*KEYS, "score", "rank")


def hybrid_search(
    chunks: DataFrame,
    queries: DataFrame,
    index: KeywordIndex,
    params: Sequence[int],
    k: int = 15,
    rrf_k: int = 60,
    a: float = 0.5,
    b: float = 0.5,
    source: str | None = None,
    cells: CellIndex | None = None,
) -> DataFrame:
    """Vector hits of every parameter value and keyword hits, fused; a side without hits adds nothing.

    With ``cells`` the parameter is the number of probed cells, otherwise the vector search is exact.
    """
    if cells is None:
        vector = exact_sweep(chunks, queries, params, k, source)
    else:
        vector = cell_top_k(cells, queries, params, k, source)
    keyword = bm25_top_k(index, chunks, queries, k, source)
    return reciprocal_rank_fusion(vector, keyword, rrf_k, a, b, rows_per_query=k * (len(params) + 1))
