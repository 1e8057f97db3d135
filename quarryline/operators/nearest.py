"""Best rows per query inside a task, and their merge: what both searches (vector and keyword) have in common.

A task holds a block of queries and sees its chunks in batches; it keeps the ``k`` lowest costs per query and returns
slim rows without any text. Rows of all tasks are merged in two rounds, first within groups of tasks. The text of the
winners is looked up last.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarryline.operators.scale import small_join, top_k
from quarryline.session import stage

FOUND = "query_id string, param_value int, cost double, chunk_id string, source string"
_SCHEMA = pa.schema(
    [("query_id", pa.string()), ("param_value", pa.int32()), ("cost", pa.float64()), ("chunk_id", pa.string()), ("source", pa.string())]
)
_TASK_GROUPS = 256


class Best:
    """The ``k`` cheapest rows per query (a number) seen so far, ordered by (cost, chunk id, source)."""

    def __init__(self, n_queries: int, k: int) -> None:
        self.k = k
        self.limit = np.full(n_queries, np.inf)
        self.rows = pd.DataFrame({"q": np.zeros(0, int), "cost": np.zeros(0), "chunk_id": [], "source": []})

    def add(self, cost: np.ndarray, queries: np.ndarray, ids: pa.Array, sources: pa.Array) -> None:
        """``cost`` has a row per chunk and a column per entry of ``queries``; infinite costs are no hits."""
        limit = self.limit[queries]
        if len(cost) > self.k:
            limit = np.minimum(limit, np.partition(cost, self.k - 1, axis=0)[self.k - 1])
        row, col = np.nonzero((cost <= limit) & np.isfinite(cost))  # equal costs stay in until ids decide
        if not len(row):
            return
        at = pa.array(row)
        new = pd.DataFrame({"q": queries[col], "cost": cost[row, col], "chunk_id": ids.take(at).to_pandas(), "source": sources.take(at).to_pandas()})
        both = pd.concat([self.rows, new]) if len(self.rows) else new
        ordered = both.sort_values(["q", "cost", "chunk_id", "source"])
        self.rows = ordered[ordered.groupby("q").cumcount() < self.k]
        full = self.rows.groupby("q")["cost"].agg(["size", "max"])
        full = full[full["size"] == self.k]
        self.limit[full.index.to_numpy(dtype=int)] = full["max"].to_numpy()

    def table(self, query_id: list[str], param_value: list[int]) -> pa.Table:
        q = self.rows["q"].to_numpy(dtype=int)
        columns = [
            pa.array(query_id, pa.string()).take(pa.array(q)), pa.array(param_value, pa.int32()).take(pa.array(q)),
            pa.array(self.rows["cost"].to_numpy(dtype=float)), pa.array(self.rows["chunk_id"], pa.string(), from_pandas=True),
            pa.array(self.rows["source"], pa.string(), from_pandas=True),
        ]
        return pa.Table.from_arrays(columns, schema=_SCHEMA)


def in_blocks(scans: Iterable[DataFrame], blocks: int, spark: SparkSession) -> DataFrame:
    """The rows found by the scans of all blocks of queries. With several blocks each is staged before the next one is
    fetched, so the driver holds one block at a time, and the broadcast of a staged one is free to be cleaned up."""
    found = []
    for scan in scans:
        if blocks == 1:
            return scan
        found.append(stage(scan))
    return reduce(DataFrame.unionByName, found) if found else spark.createDataFrame([], FOUND)


def slim(chunks: DataFrame) -> DataFrame:
    """Adds a text ``chunk_id`` and a ``source`` (null where chunks have none): together they name a chunk."""
    source = F.col("source").cast("string") if "source" in chunks.columns else F.lit(None).cast("string")
    return chunks.withColumn("chunk_id", F.col("chunk_id").cast("string")).withColumn("source", source)


def merge(partial: DataFrame, k: int) -> DataFrame:
    """The ``k`` cheapest of all tasks per (query_id, param_value), with ``rank``; staged, so the search runs once."""
    keys, order = ["query_id", "param_value"], [F.col("cost"), F.col("chunk_id"), F.col("source")]
    grouped = partial.withColumn("_tasks", F.pmod(F.spark_partition_id(), F.lit(_TASK_GROUPS)))
    first = top_k(grouped, [*keys, "_tasks"], order, k, "_n").drop("_n", "_tasks")
    return stage(top_k(first, keys, order, k))


def with_texts(best: DataFrame, chunks: DataFrame, queries: DataFrame) -> DataFrame:
    """Adds ``chunk_text`` and ``query_text`` to the winners: (query_id, query_text, param_value, rank, cost, chunk_id, chunk_text).

    Only the winners' texts are read on: their names are measured, then broadcast or met by a shuffle.
    """
    none = F.coalesce("source", F.lit(""))
    winners = best.withColumn("_source", none).withColumnRenamed("chunk_id", "_id")
    names = winners.select("_id", "_source").distinct()
    texts = slim(chunks).select(F.col("chunk_id").alias("_id"), none.alias("_source"), "chunk_text")
    wanted = small_join(texts, names, ["_id", "_source"], "left_semi")
    # Rows that repeat a name are one chunk.
    wanted = wanted.groupBy("_id", "_source").agg(F.min("chunk_text").alias("chunk_text"))
    asked = queries.select(F.col("query_id").cast("string").alias("query_id"), F.col("query_text").cast("string").alias("query_text"))
    full = winners.join(wanted, ["_id", "_source"]).join(asked, "query_id")
    return full.select("query_id", "query_text", "param_value", "rank", "cost", F.col("_id").alias("chunk_id"), "chunk_text")
