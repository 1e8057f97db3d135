"""Content hashes, duplicate removal and integrity checks of chunk tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarryline.functions.text import content_hash
from quarryline.operators.scale import first_per_key


def add_content_hash(chunks: DataFrame, content: str = "content") -> DataFrame:
    return chunks.withColumn("content_hash", content_hash(F.col(content)))


def backfill_hash(chunks: DataFrame, content: str = "content") -> DataFrame:
    """Hash only the rows that have none yet."""
    return chunks.withColumn("content_hash", F.coalesce("content_hash", content_hash(F.col(content))))


def drop_duplicates(
    chunks: DataFrame, tie: str = "id", keys: Sequence[str] = ("document_id", "content_hash"), nulls: bool = True
) -> DataFrame:
    """Keep the lowest ``chunk_index`` (then ``tie``) per key; rows without a hash are all kept.

    ``nulls=False`` says that no hash is null and saves the second pass over the input.
    """
    hashed = chunks.where(F.col("content_hash").isNotNull()) if nulls else chunks
    kept = first_per_key(hashed, list(keys), [F.col("chunk_index"), F.col(tie)])
    return kept.unionByName(chunks.where(F.col("content_hash").isNull())) if nulls else kept


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where(F.col("n") > 1)


def require_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    if not repeated_keys(df, keys).isEmpty():
        raise ValueError(f"repeated keys {tuple(keys)}")
    return df


def integrity_report(chunks: DataFrame, documents: DataFrame) -> DataFrame:
    """(check_name, key, n): null columns, repeated unique keys, chunks without a document.

    One pass over the chunks: all counts are grouping sets of one aggregate. Unique keys with a null in them never collide. Orphans are counted per document first, so a document that
    owns much of the table is one row in the join.
    """
    required, col = ("id", "document_id", "chunk_index", "content", "embedding"), F.col
    # Texts and vectors stay where they are: only whether they are there is counted.
    slim = chunks.select(
        "document_id", "chunk_index", "content_hash", *[col(c).isNull().cast("bigint").alias(f"_no_{c}") for c in required]
    )
    sets = [["document_id", "chunk_index"], ["document_id", "content_hash"], ["document_id"], []]
    counted = slim.groupingSets([[col(c) for c in one] for one in sets], "document_id", "chunk_index", "content_hash").agg(
        F.count("*").alias("n"), F.grouping_id().alias("_set"), *[F.sum(f"_no_{c}").alias(f"_no_{c}") for c in required]
    )

    def finding(when: Column, name: str, key: Column, n: Column, owner: Column | None = None) -> Column:
        owner = F.lit(None) if owner is None else owner
        row = F.struct(F.lit(name).alias("check_name"), key.alias("key"), n.alias("n"), owner.cast("string").alias("owner"))
        return F.when(when, row)

    def pair(second: str) -> Column:
        return F.concat_ws("|", *[col(c).cast("string") for c in ("document_id", second)])

    # The number of a grouping has a bit for each column that it leaves out.
    by_index, by_hash, by_document, whole = (col("_set") == n for n in (0b001, 0b010, 0b011, 0b111))
    known, repeated = col("document_id").isNotNull(), col("n") > 1
    found = F.array_compact(
        F.array(
            finding(by_index & known & col("chunk_index").isNotNull() & repeated, "repeated_index", pair("chunk_index"), col("n")),
            finding(by_hash & known & col("content_hash").isNotNull() & repeated, "repeated_hash", pair("content_hash"), col("n")),
            finding(by_document & known, "orphan", col("document_id").cast("string"), col("n"), col("document_id")),
            *[finding(whole & (col(f"_no_{c}") > 0), "null", F.lit(c), col(f"_no_{c}")) for c in required],
        )
    )
    rows = counted.select(F.explode(found).alias("f")).select("f.*")
    # Only what might be an orphan can meet a document; the other findings spread by their own keys.
    owners = documents.select(col("id").cast("string").alias("_key")).distinct().withColumn("_known", F.lit(True))
    met = rows.withColumn("_key", F.coalesce("owner", F.concat_ws("|", "check_name", "key"))).join(owners, "_key", "left")
    return met.where(col("owner").isNull() | col("_known").isNull()).select("check_name", "key", "n")


def _sound(dim: int, embedding: str) -> Column:
    return F.col(embedding).isNotNull() & (F.size(embedding) == dim)


def embedding_faults(chunks: DataFrame, dim: int, embedding: str = "embedding") -> DataFrame:
    """Rows whose embedding is missing or has the wrong width."""
    return chunks.where(~F.coalesce(_sound(dim, embedding), F.lit(False)))


def checked_embedding(dim: int, embedding: str = "embedding") -> Column:
    """The embedding, or a failed job when it is missing or has the wrong width; needs no pass of its own."""
    message = F.lit(f"missing embedding, or its width is not {dim}")
    return F.when(_sound(dim, embedding), F.col(embedding)).otherwise(F.raise_error(message))
