"""Readers and writers of files: corpora, query sets, labelled hits and results."""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarryline import schemas
from quarryline.session import bound_batches, file_system

_TASKS_PER_CORE, _PARTS_PER_TASK = 16, 64  # a corpus is read by more tasks than the first only where each has the second
# Folder names of the text sink.
_NO_FOLDER = "__HIVE_DEFAULT_PARTITION__"
_NOT_IN_FOLDER = re.compile("[\x01-\x1f\x7f\"#%'*/:=?\\\\{\\[\\]^]")
_SCHEME = re.compile("^[A-Za-z][A-Za-z0-9+.-]*:")
TEXT_EXTENSIONS = (".md", ".txt")  # fixed values
# Quotes inside quotes are doubled, line breaks and outer blanks are kept, and an empty text stays empty.
_CSV = {"header": True, "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def load_corpus(
    spark: SparkSession,
    root: str,
    source: str,
    extensions: Sequence[str] | None = None,
    recursive: bool = True,
) -> DataFrame:
    """One row per text file below ``root`` (an absolute path or URI): (doc_id, source, relative_path, text).

    Spark counts a file as 4 MB at least, so a million small ones would be hundred thousands of tasks; a task reads the files of
    several of Spark's partitions one after another.
    """
    files, relative = _text_files(spark, root, extensions, recursive, wholetext=True)
    cores = spark.sparkContext.defaultParallelism
    files = files.coalesce(max(_TASKS_PER_CORE * cores, files.rdd.getNumPartitions() // _PARTS_PER_TASK))
    return files.select(
        F.concat(F.lit(f"{source}::"), relative).alias("doc_id"),
        F.lit(source).alias("source"),
        relative.alias("relative_path"),
        F.col("value").alias("text"),
    )


def write_corpus(docs: DataFrame, root: str) -> None:
    """Each row of (source, no, text) as a text file in a folder ``source=...`` below ``root``; it ends with a line feed, as those of
    the text sink do. ``no`` numbers the rows.

    On a mounted path Hadoop starts two processes for every file that the sink creates, and the driver renames all of them; there
    the tasks write the files themselves. A file is named by its row, so a task that runs twice writes the same files again.
    """
    spark = docs.sparkSession
    path, system = file_system(spark, root)
    if system.getUri().getScheme() != "file":
        docs.select("source", "text").write.option("maxRecordsPerFile", 1).partitionBy("source").text(root)
        return
    base = path.toUri().getPath()
    os.makedirs(base, exist_ok=True)  # also where there is no row

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for source, no, text in zip(*(batch.column(c).to_pylist() for c in ("source", "no", "text"))):
                folder = f"{base}/source={_NOT_IN_FOLDER.sub(lambda m: f'%{ord(m[0]):02X}', source) if source else _NO_FOLDER}"
                begun = f"{folder}/.{no}-{uuid.uuid4().hex}"
                os.makedirs(folder, exist_ok=True)
                with open(begun, "wb") as file:
                    file.write((text or "").encode() + b"\n")
                os.replace(begun, f"{folder}/{no}.txt")
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], names=["n"])

    bound_batches(spark)
    docs.select("source", "no", "text").mapInArrow(put, "n long").agg(F.sum("n")).collect()


def load_lines(
    spark: SparkSession,
    root: str,
    source: str,
    extensions: Sequence[str] | None = None,
    recursive: bool = True,
) -> DataFrame:
    """One row per line of the text files below ``root``, for files that are too long for one task:
    (doc_id, source, relative_path, doc, place, line).

    A large file is read by several tasks; ``place`` orders the lines of a file by the split they come from, and
    inside it as they were read.
    """
    files, relative = _text_files(spark, root, extensions, recursive, lineSep="\n")
    return files.select(
        F.concat(F.lit(f"{source}::"), relative).alias("doc_id"),
        F.lit(source).alias("source"),
        relative.alias("relative_path"),
        relative.alias("doc"),
        F.struct(F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("row")).alias("place"),
        F.col("value").alias("line"),
    )


def _text_files(
    spark: SparkSession, root: str, extensions: Sequence[str] | None, recursive: bool, **options: object
) -> tuple[DataFrame, Column]:
    """Rows of the text files, and the path of a row's file below ``root``."""
    if not root.startswith("/") and not _SCHEME.match(root):
        raise ValueError("root must be an absolute path or a URI")
    endings = ",".join(e.lstrip(".") for e in (extensions or TEXT_EXTENSIONS))
    reader = spark.read.option("pathGlobFilter", f"*.{{{endings}}}")
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    files = reader.text(root, **options)
    # file_path is URI-encoded; a plus sign stands for itself there.
    path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    below = "/" + _SCHEME.sub("", root).strip("/") + "/"
    return files, F.substring(path, F.instr(path, below) + len(below), F.length(path))


def read_queries(spark: SparkSession, path: str) -> DataFrame:
    """Query JSON lines; blank lines are skipped, unknown fields ignored, missing tags are empty.

    A line that is not JSON, or lacks a required field, fails the job that reads it.
    """
    schema = T.StructType(schemas.QUERY.fields + [T.StructField("_broken", T.StringType())])
    rows = spark.read.schema(schema).option("columnNameOfCorruptRecord", "_broken").json(path)
    complete = F.col("_broken").isNull()
    for name in schemas.QUERY_REQUIRED:
        complete = complete & F.col(name).isNotNull()
    message = F.concat(F.lit("invalid query line: "), F.coalesce("_broken", F.col("id"), F.lit("")))
    checked = F.when(complete, F.col("id")).otherwise(F.raise_error(message))
    return rows.withColumn("id", checked).withColumn("tags", F.coalesce("tags", F.array())).drop("_broken")


def export_for_labelling(hits: DataFrame, path: str) -> None:
    """Hits with an empty ``relevance`` column as CSV; without hits there is still a header."""
    rows = hits.withColumn("relevance", F.lit(""))
    rows.write.mode("overwrite").options(**_CSV, emptyValue="").csv(path)


def read_labelled(spark: SparkSession, path: str, layout: str = "vector") -> DataFrame:
    """A labelled CSV: ``vector``, ``keyword``, ``fused`` or ``reranked`` hits, or ``truth`` (see ``schemas.LABELLED``).

    ``relevance`` of hits stays text until ``truth_labels`` cleans it. A file whose header has other columns, or the
    same in another order, fails the job that reads it.
    """
    return spark.read.schema(schemas.LABELLED[layout]).options(**_CSV, multiLine=True, enforceSchema=False).csv(path)


def write_result(table: DataFrame, path: str, form: str = "parquet") -> None:
    """A result table as Parquet or CSV, without an index column."""
    writer = table.write.mode("overwrite")
    if form == "csv":
        writer.options(**_CSV).csv(path)
    else:
        writer.format(form).save(path)
