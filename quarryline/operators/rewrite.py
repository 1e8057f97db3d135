"""Query rewriting around a user-supplied text model: prompts in, validated queries out."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarryline.functions.model_output import parsed_query

NO_CHUNKS = "(none)"  # fixed value
REPAIR_PREFIX = "Return ONLY valid JSON. No prose. No markdown.\n\n"  # fixed value
_PLACEHOLDER = re.compile(r"\{(user_query|retrieved_chunks)\}|\{\{|\}\}")


def prompt(template: str, user_query: Column, retrieved_chunks: Column | None = None) -> Column:
    """Fill ``{user_query}`` and ``{retrieved_chunks}``; ``{{`` and ``}}`` are braces.

    Only the template is scanned, so braces or placeholders inside the inserted texts stay as they are.
    """
    chunks = F.lit(NO_CHUNKS)
    if retrieved_chunks is not None:
        chunks = F.coalesce(F.nullif(retrieved_chunks, F.lit("")), chunks)
    parts: list[Column] = []
    at = 0
    for found in _PLACEHOLDER.finditer(template):
        parts.append(F.lit(template[at : found.start()]))
        name = found.group(1)
        parts.append(F.lit(found.group(0)[0]) if name is None else user_query if name == "user_query" else chunks)
        at = found.end()
    return F.concat(*parts, F.lit(template[at:]))


def render_prompts(queries: DataFrame, template: str, context: DataFrame | None = None) -> DataFrame:
    """Add ``prompt`` and ``repair_prompt``; ``context`` is (query_id, context), at most one row per query."""
    if context is None:
        filled = queries.withColumn("prompt", prompt(template, F.col("query_text")))
    else:
        joined = queries.join(context.select("query_id", F.col("context").alias("_context")), "query_id", "left")
        filled = joined.withColumn("prompt", prompt(template, F.col("query_text"), F.col("_context"))).drop("_context")
    return filled.withColumn("repair_prompt", F.concat(F.lit(REPAIR_PREFIX), F.col("prompt")))


def validate_output(outputs: DataFrame, raw: str = "raw") -> DataFrame:
    """Add ``parsed`` (null when invalid) and ``valid``."""
    parsed = outputs.withColumn("parsed", parsed_query(F.col(raw)))
    return parsed.withColumn("valid", F.col("parsed").isNotNull())


def choose_attempt(outputs: DataFrame, first: str = "raw1", second: str = "raw2") -> DataFrame:
    """Add ``parsed`` and ``attempt``: the first valid answer (1 or 2), else the original text (0)."""
    kept = F.struct(
        F.col("query_text").alias("refined_query"),
        F.create_map().cast("map<string,string>").alias("filters"),
        F.array().cast("array<string>").alias("must_not"),
        F.lit(None).cast("double").alias("confidence"),
    )
    tried = outputs.withColumn("_one", parsed_query(F.col(first))).withColumn("_two", parsed_query(F.col(second)))
    attempt = F.when(F.col("_one").isNotNull(), 1).when(F.col("_two").isNotNull(), 2).otherwise(0)
    return tried.withColumn("attempt", attempt).withColumn("parsed", F.coalesce("_one", "_two", kept)).drop("_one", "_two")


def substitute(queries: DataFrame) -> DataFrame:
    """Replace ``query_text`` by the refined one; every other field stays."""
    return queries.withColumn("query_text", F.col("parsed.refined_query"))
