"""Search, label and score several versions of a query set in one job."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarryline.operators.labels import label_hits
from quarryline.operators.metrics import summarize

_GLUE = "\x1f"  # joins run and query id while both versions of a query are in one search


def rewrite_experiment(
    query_sets: dict[str, DataFrame],
    search: Callable[[DataFrame], DataFrame],
    embed: Callable[[DataFrame], DataFrame],
    truth: DataFrame,
    k: int = 10,
) -> DataFrame:
    """One summary row per query set; ``search`` maps embedded queries to hits and runs once for all sets."""
    tagged = [
        queries.select(F.concat(F.lit(run + _GLUE), F.col("query_id").cast("string")).alias("query_id"), "query_text")
        for run, queries in query_sets.items()
    ]
    hits = search(embed(reduce(DataFrame.unionByName, tagged)))
    parts = F.split("query_id", _GLUE)
    named = hits.withColumn("run", parts[0]).withColumn("query_id", parts[1])
    return summarize(label_hits(named, truth), k)
