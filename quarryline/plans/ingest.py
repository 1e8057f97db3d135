"""Load, chunk, number, de-duplicate, embed and publish a corpus."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarryline.operators.chunking import chunk_corpus
from quarryline.operators.embedding import hash_embed
from quarryline.operators.integrity import add_content_hash
from quarryline.operators.scale import running_sum
from quarryline.session import stage
from quarryline.sources.store import publish, with_stored_vectors

Step = Callable[[DataFrame], DataFrame]


def unique_chunks(staged: DataFrame) -> DataFrame:
    """The first chunk of every content per source, with its ``chunk_index`` among all chunks of the source.

    Chunks of a source are numbered from 0 in document order, before duplicates go; documents of a source that share an
    id share their numbers. A source, or the copies of one content, may be most of the corpus: only document sizes are
    sorted and summed, and copies are reduced to their first (document, position) in the map tasks. Texts take part in
    one join, by a number of the row (``_chunk``, written with the table so that every reader sees the same).
    """
    if "_chunk" not in staged.columns:
        staged = stage(numbered_rows(staged))
    sizes = staged.groupBy("source", "doc_id").agg((F.max("doc_chunk_index") + 1).alias("size"))
    starts = running_sum(sizes, ["source"], [F.col("doc_id")], F.col("size"), "start")
    starts = starts.select(F.col("source").alias("_source"), F.col("doc_id").alias("_doc_id"), "start")
    place = F.min(F.struct("doc_id", "doc_chunk_index", "_chunk")).alias("at")
    first = staged.groupBy("source", "content_hash").agg(place).select("source", "at.*")
    owner = F.col("source").eqNullSafe(F.col("_source")) & F.col("doc_id").eqNullSafe(F.col("_doc_id"))
    indexed = first.join(starts, owner).select("_chunk", (F.col("start") + F.col("doc_chunk_index")).alias("chunk_index"))
    return staged.join(indexed, "_chunk").drop("_chunk")


def numbered_rows(chunks: DataFrame) -> DataFrame:
    return chunks.withColumn("_chunk", F.monotonically_increasing_id())


def ingest(
    docs: DataFrame,
    root: str,
    dim: int,
    chunker: Step = chunk_corpus,
    embedder: Step | None = None,
    title: str | None = None,
    embedding_model: str | None = None,
    extra: dict[str, str] | None = None,
    sources: DataFrame | None = None,
    reuse: bool = False,
) -> DataFrame:
    """Replace the stored chunks of every source in ``docs`` (or in ``sources``, which may be without documents).

    Duplicates go before embedding, which stores the same rows and saves model calls. With ``reuse`` the vectors of contents
    that the published version has already, by the same model, are carried over, and only what has changed is embedded.
    """
    embed = embedder or (lambda df: hash_embed(df, "content", dim))
    chunks = stage(numbered_rows(add_content_hash(chunker(docs))))
    counts = chunks.groupBy("source").agg(F.count("*").alias("n_chunks"))
    wanted = docs.select("source") if sources is None else sources
    unique = unique_chunks(chunks)
    embedded = with_stored_vectors(unique, root, dim, embed, embedding_model) if reuse else embed(unique)
    return publish(embedded, wanted, root, dim, title, embedding_model, extra, counts)
