"""Small helpers that every operator of this subpackage uses."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, with underscores in front until no column of ``df`` is called so (names are not case-sensitive)."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted


def texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) and nothing else: other columns never travel and cannot clash. A null text is empty."""
    return df.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Texts are long: Spark's default of 10,000 rows in an Arrow batch would hold tens of MB several times over in every
    task. Sets the session's batch size; results do not depend on it."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def documents(spark: SparkSession, sf: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf}/documents.parquet")


def bucket_of(key: Column, buckets: int) -> Column:
    """crc32 of the key as text, modulo ``buckets``; a null key counts as the empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % buckets


def slices(batches: Iterable[pa.RecordBatch], column: str, most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Cut batches so that ``column`` (string or binary) holds about ``most`` bytes in each; a longer row stands alone."""
    for batch in batches:
        rows = max(1, most * batch.num_rows // max(batch.column(column).nbytes, 1))
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)
