"""Chunk store with replace-by-source publishing.

``documents`` and ``chunks`` are Parquet, partitioned by (source, version); a manifest says which sources a version
replaces. A version counts from the moment that a numbered commit file names it. Commit files are put only where there is none of
that number, so writers need no lock: whoever finds a number taken tries the next. Readers take the version of the last
commit of each source, so both tables switch together, an unfinished publish is invisible, the sources of two publishes never
mix, and publishing nothing for a source empties it. ``sweep`` removes what no reader can need any more.

Commit files need a file system with an atomic rename that does not overwrite (HDFS and its like), or a local one.
"""

from __future__ import annotations

import json
import os
import time
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarryline import schemas
from quarryline.operators.integrity import add_content_hash, checked_embedding, drop_duplicates
from quarryline.operators.scale import small_join
from quarryline.session import file_system, stage

_PLACE = [T.StructField("source", T.StringType()), T.StructField("version", T.LongType())]


def _table(spark: SparkSession, root: str, name: str, schema: T.StructType) -> DataFrame:
    reader = spark.read.schema(T.StructType(schema.fields + _PLACE))
    try:
        return reader.parquet(f"{root}/{name}")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], T.StructType(schema.fields + _PLACE))  # nothing published yet


class PublishConflict(RuntimeError):
    """Somebody else has published one of the sources since the state that a publish was based on."""


@dataclass(frozen=True)
class Pending:
    """A version that is written but not committed, and so seen by nobody."""

    root: str
    version: int


def _put_if_absent(spark: SparkSession, path: str, content: str) -> bool:
    """Make a file with its whole content, or return False where it exists."""
    target, system = file_system(spark, path)
    if system.getUri().getScheme() == "file":
        own = f"{target.toUri().getPath()}.{uuid.uuid4().hex}"
        with open(own, "w", encoding="utf-8") as file:
            file.write(content)
        try:
            os.link(own, target.toUri().getPath())
        except FileExistsError:
            return False
        finally:
            os.remove(own)
        return True
    jvm = spark._jvm
    own = jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}")
    out = system.create(own, False)
    out.write(content.encode())
    out.close()
    if system.rename(own, target):
        return True
    system.delete(own, False)
    return False


def _commits(spark: SparkSession, root: str) -> list[tuple[int, int, float]]:
    """(number, version, time) of all commits, in order. ``sweep`` keeps them few."""
    folder, system = file_system(spark, f"{root}/commits")
    if not system.exists(folder):
        return []
    names = [f.getPath().getName() for f in system.listStatus(folder)]
    numbers = {int(n.removesuffix(".json")) for n in names if n.endswith(".json")}
    if not numbers:
        return []
    rows = spark.read.schema("number long, version long, time double").json([f"{root}/commits/{n:012}.json" for n in sorted(numbers)]).collect()
    return sorted((r.number, r.version, r.time) for r in rows)


def last_commit(spark: SparkSession, root: str) -> int:
    """Number of the last commit; 0 where nothing is published. A publish may be based on it."""
    return max((number for number, _, _ in _commits(spark, root)), default=0)


def _history(spark: SparkSession, root: str, commits: list[tuple[int, int, float]]) -> DataFrame:
    """(source, version, number, time) of every publish of a source by one of the commits."""
    known = spark.createDataFrame(commits, "number long, version long, time double")
    try:
        log = spark.read.schema(schemas.MANIFEST).parquet(f"{root}/manifest")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        log = spark.createDataFrame([], schemas.MANIFEST)
    return log.select("source", "version").join(known, "version")


def current_versions(spark: SparkSession, root: str) -> DataFrame:
    """(source, version) of the last committed publish of each source."""
    return _history(spark, root, _commits(spark, root)).groupBy("source").agg(F.max_by("version", "number").alias("version"))


def commit(spark: SparkSession, pending: Pending, based_on: int | None = None) -> int:
    """Make a pending version the one that readers see; returns its number.

    Commits are ordered by their numbers, and the last one of a source wins as a whole. With ``based_on`` (see ``last_commit``)
    the commit fails where a later commit has replaced one of its sources; the version stays invisible then.
    """
    root, seen = pending.root, based_on
    folder, system = file_system(spark, f"{root}/commits")
    system.mkdirs(folder)
    while True:
        commits = _commits(spark, root)
        newest = max((number for number, _, _ in commits), default=0)
        if seen is not None and newest > seen:
            log = spark.read.schema(schemas.MANIFEST).parquet(f"{root}/manifest")
            later = [version for number, version, _ in commits if number > seen]
            theirs = log.where(F.col("version").isin(later)).select("source")
            ours = log.where(F.col("version") == pending.version).select("source")
            if both := [r.source for r in ours.intersect(theirs).limit(3).collect()]:
                raise PublishConflict(f"published by another writer since commit {based_on}: {both}")
            seen = newest
        entry = json.dumps({"number": newest + 1, "version": pending.version, "time": time.time()})
        if _put_if_absent(spark, f"{root}/commits/{newest + 1:012}.json", entry):
            return newest + 1


def publish(
    chunks: DataFrame,
    sources: Sequence[str] | DataFrame,
    root: str,
    dim: int,
    title: str | None = None,
    embedding_model: str | None = None,
    extra: dict[str, str] | None = None,
    counts: DataFrame | None = None,
    based_on: int | None = None,
) -> DataFrame:
    """Replace everything stored for ``sources`` by ``chunks``; returns (document_id, source, n_chunks).

    ``prepare`` and ``commit`` in one.

    """
    spark = chunks.sparkSession
    pending = prepare(chunks, sources, root, dim, title, embedding_model, extra, counts)
    commit(spark, pending, based_on)
    stored = _table(spark, root, "documents", schemas.DOCUMENTS).where(F.col("version") == pending.version)
    n_nodes = F.get_json_object("doc_metadata", "$.n_nodes").cast("bigint")
    return stored.select(F.col("id").alias("document_id"), "source", n_nodes.alias("n_chunks"))


def prepare(
    chunks: DataFrame,
    sources: Sequence[str] | DataFrame,
    root: str,
    dim: int,
    title: str | None = None,
    embedding_model: str | None = None,
    extra: dict[str, str] | None = None,
    counts: DataFrame | None = None,
) -> Pending:
    """Write a version of ``sources`` that nobody sees before it is committed.

    ``chunks`` has source, chunk_index, content, embedding, chunk_metadata and, if known, content_hash. Repeated content of a source is stored
    once (lowest chunk_index); ``n_nodes`` in the document metadata and ``n_chunks`` count before that. A chunk
    without a proper embedding fails the write, and nothing becomes visible. ``counts`` (source, n_chunks) says that
    the chunks are already de-duplicated and how many there were before; it saves a shuffle of all vectors.
    """
    spark = chunks.sparkSession
    if not isinstance(sources, DataFrame):
        sources = spark.createDataFrame([(s,) for s in sources], "source string")
    # The clock, for sweep to tell the age of what was never committed, and random digits, as writers share no clock.
    number = time.time_ns() // 1_000_000 * 100_000 + uuid.uuid4().int % 100_000
    version = F.lit(number).cast("bigint")
    now = F.lit(datetime.now(timezone.utc))
    sources = stage(sources.select("source").distinct())

    nodes = chunks.groupBy("source").agg(F.count("*").alias("n_chunks")) if counts is None else counts
    documents = sources.join(nodes, "source", "left").select(
        F.sha2("source", 256).alias("id"),
        F.lit(title).cast("string").alias("title"),
        F.to_json(
            F.struct(
                *[F.lit(v).alias(k) for k, v in (extra or {}).items() if k != "n_nodes"],
                F.coalesce("n_chunks", F.lit(0)).alias("n_nodes"),
            )
        ).alias("doc_metadata"),
        F.lit(embedding_model).cast("string").alias("embedding_model"),
        now.alias("created_at"),
        "source",
        version.alias("version"),
    )
    documents.write.mode("append").partitionBy("source", "version").parquet(f"{root}/documents")

    # Chunks of a source that is not being replaced stay out, as they would have no document row.
    ours = small_join(chunks, sources, ["source"], "left_semi", spread="chunk_index")
    hashed = ours if "content_hash" in ours.columns else add_content_hash(ours)
    rows = hashed.select(
        F.sha2(F.concat_ws("|", "source", "content_hash"), 256).alias("id"),
        F.sha2("source", 256).alias("document_id"),
        F.col("chunk_index").cast("bigint").alias("chunk_index"),
        "content",
        "content_hash",
        checked_embedding(dim).cast("array<float>").alias("embedding"),
        "chunk_metadata",
        now.alias("created_at"),
        "source",
        version.alias("version"),
    )
    kept = drop_duplicates(rows, nulls=False) if counts is None else rows
    # Files of even size whatever a source holds: small sources share a task, a large one is split over many.
    kept = kept.hint("rebalance", F.col("source"))
    kept.write.mode("append").partitionBy("source", "version").parquet(f"{root}/chunks")

    log = sources.select("source", version.alias("version"), F.lit(root).alias("folder"))
    log.coalesce(1).write.mode("append").parquet(f"{root}/manifest")
    return Pending(root, number)


def with_stored_vectors(
    chunks: DataFrame, root: str, dim: int, embed: Callable[[DataFrame], DataFrame], embedding_model: str | None = None
) -> DataFrame:
    """``chunks`` (source, content, content_hash, ...) with ``embedding``: that of the published version where the source
    holds the same content, embedded by the same model with the same width, and otherwise by ``embed``, which is asked for
    nothing else.

    Contents meet by source and hash, so no source gathers in one task. Vectors that do not fit are embedded anew.
    """
    spark = chunks.sparkSession
    model = F.col("embedding_model").eqNullSafe(F.lit(embedding_model).cast("string"))
    same_model = read_documents(spark, root).where(model).select("source")
    sound = F.coalesce(F.size("embedding") == dim, F.lit(False)) & F.col("content_hash").isNotNull()
    stored = small_join(read_chunks(spark, root).where(sound), same_model, ["source"], "left_semi", spread="chunk_index")
    known = stored.groupBy("source", "content_hash").agg(F.min("embedding").alias("embedding"))
    met = stage(chunks.join(known, ["source", "content_hash"], "left").select(*chunks.columns, "embedding"))
    new = embed(met.where(F.col("embedding").isNull()).drop("embedding"))
    return met.where(F.col("embedding").isNotNull()).unionByName(new.withColumn("embedding", F.col("embedding").cast("array<float>")))


def sweep(spark: SparkSession, root: str, keep_seconds: float, now: float | None = None) -> list[str]:
    """Remove the folders of versions that were replaced, or written and never committed, more than ``keep_seconds`` ago.

    A reader that was planned less than ``keep_seconds`` before finds all its files. A publish must not take longer than
    that, else its files count as left over. Returns the folders. Versions are told by their folders' names; their number,
    not that of chunks, is what passes the driver.
    """
    oldest = (time.time() if now is None else now) - keep_seconds
    commits = _commits(spark, root)  # read once: what is committed from here on is young
    history = _history(spark, root, commits)
    ordered = Window.partitionBy("source").orderBy("number")
    replaced = history.select("source", "version", F.lead("time").over(ordered).alias("replaced"))
    # Needed: current, or replaced a short time ago.
    needed = replaced.where(F.col("replaced").isNull() | (F.col("replaced") > oldest)).select("source", "version")
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString
    keep = {(escape("source", r.source), r.version) for r in needed.toLocalIterator()}
    committed = {version for _, version, _ in commits}
    gone = []
    for table in ("chunks", "documents"):
        folder, system = file_system(spark, f"{root}/{table}")
        if not system.exists(folder):
            continue
        for source in [f.getPath() for f in system.listStatus(folder) if f.isDirectory() and f.getPath().getName().startswith("source=")]:
            for at in [f.getPath() for f in system.listStatus(source)]:
                if not at.getName().startswith("version="):
                    continue
                version = int(at.getName().removeprefix("version="))
                young = version not in committed and version / 100_000_000 > oldest
                if (source.getName(), version) not in keep and not young:
                    system.delete(at, True)
                    gone.append(at.toString())
    return gone


def _current(spark: SparkSession, root: str, name: str, schema: T.StructType, source: str | None) -> DataFrame:
    versions = current_versions(spark, root)
    table = _table(spark, root, name, schema)
    if source is not None:  # prunes partitions at planning time; the join prunes versions at run time
        versions, table = versions.where(F.col("source") == source), table.where(F.col("source") == source)
    return table.join(versions, ["source", "version"])


def read_documents(spark: SparkSession, root: str, source: str | None = None) -> DataFrame:
    return _current(spark, root, "documents", schemas.DOCUMENTS, source)


def read_chunks(spark: SparkSession, root: str, source: str | None = None) -> DataFrame:
    return _current(spark, root, "chunks", schemas.CHUNKS, source)


def search_snapshot(chunks: DataFrame, documents: DataFrame, source: str | None = None) -> DataFrame:
    """Chunks whose document exists and has a source: (chunk_id, chunk_text, embedding, source).

    A null source never matches. There is one document row per source, and the planner's size estimate or the
    run-time skew split decides how the join runs.
    """
    owners = documents.where(F.col("source").isNotNull()).select(F.col("id").alias("document_id"), "source")
    if source is not None:
        owners = owners.where(F.col("source") == source)
        if "source" in chunks.columns:
            chunks = chunks.where(F.col("source") == source)
    if "source" in chunks.columns:
        chunks = chunks.drop("source")
    return chunks.join(owners, "document_id").select(
        F.col("id").alias("chunk_id"), F.col("content").alias("chunk_text"), "embedding", "source"
    )
