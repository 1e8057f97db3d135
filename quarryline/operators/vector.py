"""Cosine top-k, exact and approximate, for whole sets of queries.

Chunks are never paired with queries row by row and never shuffled: each task multiplies its Arrow batches with the
query matrix and keeps its own best ``k`` rows per query (see ``nearest``). A query set above a bound is cut into
blocks of queries, and each block scans the chunks once. Ids identify chunks within a source.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import Normalizer
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarryline.operators.integrity import require_unique
from quarryline.operators.nearest import FOUND, Best, in_blocks, merge, slim, with_texts
from quarryline.operators.scale import BROADCAST_BYTES, measure
from quarryline.session import stage

_CELLS_AT_ONCE = 4_000_000  # distances held by a task at a time
_SLACK = 1e-8  # distances are rounded, bounds are not
_DECIMALS = 9  # distances are compared and returned rounded, so that ties do not depend on summation order


def _matrix(vectors: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """One row per vector. Vectors of different widths are an error; a null component becomes NaN."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    if not len(vectors):
        return np.zeros((0, 1))
    width = pc.min_max(pc.list_value_length(vectors)).as_py()
    if width["min"] != width["max"]:
        raise ValueError(f"vectors of {width['min']} and of {width['max']} components in one search")
    return vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(vectors), -1)


def _unit(matrix: np.ndarray) -> np.ndarray:
    return matrix / np.linalg.norm(matrix, axis=1, keepdims=True)


def _usable(rows: pa.RecordBatch | pa.Table) -> pa.RecordBatch | pa.Table:
    """Rows with an embedding that is not all zeros and has no missing or infinite component."""
    rows = rows.filter(pc.is_valid(rows.column("embedding")))
    if not rows.num_rows:
        return rows
    matrix = _matrix(rows.column("embedding"))
    return rows.filter(pa.array(matrix.any(axis=1) & np.isfinite(matrix).all(axis=1)))


@dataclass(frozen=True)
class _Queries:
    """Unit query vectors in row order, and per cell the rows that look into it (cell 0 alone: all rows)."""

    query_id: list[str]
    param_value: list[int]
    unit: np.ndarray
    rows_of_cell: dict[int, np.ndarray]

    @staticmethod
    def of(table: pa.Table) -> _Queries:
        table = _usable(table)
        rows_of_cell: dict[int, list[int]] = {}
        for row, row_cells in enumerate(table.column("cells").to_pylist()):
            for cell in row_cells:
                rows_of_cell.setdefault(cell, []).append(row)
        unit = _unit(_matrix(table.column("embedding")))
        ids, values = (table.column(c).to_pylist() for c in ("query_id", "param_value"))
        return _Queries(ids, values, unit, {c: np.asarray(r) for c, r in rows_of_cell.items()})


def _compare(batch: pa.RecordBatch, queries: _Queries, best: Best) -> None:
    batch = _usable(batch)
    if not batch.num_rows:
        return
    cells = batch.column("cell").to_numpy(zero_copy_only=False)
    matrix = _matrix(batch.column("embedding"))
    if matrix.shape[1] != queries.unit.shape[1]:
        raise ValueError(f"chunk vectors have {matrix.shape[1]} components, query vectors {queries.unit.shape[1]}")
    vectors = _unit(matrix)
    for cell in np.unique(cells):
        asking = queries.rows_of_cell.get(int(cell))
        if asking is None:
            continue
        here = np.flatnonzero(cells == cell)
        step = max(_CELLS_AT_ONCE // len(asking), 1)
        for start in range(0, len(here), step):
            part = here[start : start + step]
            dist = np.round(1.0 - vectors[part] @ queries.unit[asking].T, _DECIMALS)
            at = pa.array(part)
            best.add(dist, asking, batch.column("chunk_id").take(at), batch.column("source").take(at))


def _chunk_side(chunks: DataFrame, source: str | None, cell: Column) -> DataFrame:
    if source is not None:
        chunks = chunks.where(F.col("source") == source)
    # Missing and zero vectors are dropped in the tasks: a filter here would compute lazy embeddings twice.
    return slim(chunks).select("chunk_id", "source", "embedding", cell.alias("cell"))


def _query_side(queries: DataFrame, params: Sequence[int]) -> DataFrame:
    values = F.array(*[F.lit(int(p)) for p in params])
    return queries.select(F.col("query_id").cast("string").alias("query_id"), F.explode(values).alias("param_value"), "embedding")


def _scan(chunks: DataFrame, queries: DataFrame, k: int) -> DataFrame | None:
    """One block of queries, sent to every task; reads only cells that one of them looks into."""
    packed = _Queries.of(queries.select("query_id", "param_value", "embedding", "cells").toArrow())
    if not packed.rows_of_cell:
        return None
    chunks = chunks.where(F.col("cell").isin(list(packed.rows_of_cell)))
    shared = chunks.sparkSession.sparkContext.broadcast(packed)

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = shared.value
        best = Best(len(asked.query_id), k)
        for batch in batches:
            _compare(batch, asked, best)
        yield from best.table(asked.query_id, asked.param_value).to_batches()

    return chunks.mapInArrow(nearest, FOUND)


def _merged(chunks: DataFrame, queries: DataFrame, k: int, query_bytes: int | None) -> DataFrame:
    """(query_id, param_value, rank, cost, chunk_id, source) of the hits, one block of queries after the other."""
    bound = BROADCAST_BYTES if query_bytes is None else query_bytes
    rows, size = measure(queries)
    blocks = max(1, min(-(-size // max(bound, 1)), rows))
    block = F.pmod(F.xxhash64("query_id", "param_value"), F.lit(blocks))
    scans = (s for n in range(blocks) if (s := _scan(chunks, queries.where(block == n), k)) is not None)
    return merge(in_blocks(scans, blocks, chunks.sparkSession), k)


def _search(chunks: DataFrame, texts: DataFrame, queries: DataFrame, asked: DataFrame, k: int, query_bytes: int | None) -> DataFrame:
    return with_texts(_merged(chunks, queries, k, query_bytes), texts, asked).withColumnRenamed("cost", "dist")


def _as_hits(found: DataFrame, run_name: Column) -> DataFrame:
    return found.select(
        "query_id", "query_text", run_name.alias("run_name"), "param_value", "rank", "dist", "chunk_id", "chunk_text"
    )


def _texts(chunks: DataFrame, source: str | None) -> DataFrame:
    names = ["chunk_id", "chunk_text", *(["source"] if "source" in chunks.columns else [])]
    return chunks.select(*names) if source is None else chunks.where(F.col("source") == source).select(*names)


def cosine_top_k(
    chunks: DataFrame, queries: DataFrame, k: int = 15, source: str | None = None, query_bytes: int | None = None
) -> DataFrame:
    """Exact search: chunks (chunk_id, chunk_text, embedding[, source]) × queries (query_id, query_text, embedding).

    Distance is ``1 - cosine``, ties go to the lower chunk id, zero vectors and those with a missing component never
    match. Vectors of different widths and repeated query ids are errors.
    """
    require_unique(queries, ["query_id"])
    side = _query_side(queries, [k]).withColumn("cells", F.array(F.lit(0)))
    found = _search(_chunk_side(chunks, source, F.lit(0)), _texts(chunks, source), side, queries, k, query_bytes)
    return _as_hits(found, F.format_string("exact_k%d", F.lit(k)))


def _sweep_name(k: int) -> Column:
    return F.format_string("hnsw_ef%d_k%d", "param_value", F.lit(k))  # fixed format


def exact_sweep(
    chunks: DataFrame, queries: DataFrame, params: Sequence[int], k: int = 15, source: str | None = None
) -> DataFrame:
    """One run per parameter value over exact search: the search runs once, its rows are repeated per value."""
    values = F.explode(F.array(*[F.lit(int(p)) for p in params]))
    found = cosine_top_k(chunks, queries, k, source).withColumn("param_value", values)
    return _as_hits(found, _sweep_name(k))


@dataclass(frozen=True)
class CellIndex:
    """Chunks with the number of their nearest centroid in ``cell`` and their distance to it in ``away``, and the centroids."""

    chunks: DataFrame
    centroids: np.ndarray

    def write(self, folder: str) -> None:
        """Keep the index as files; a search then reads only the folders of the cells it looks into."""
        spark = self.chunks.sparkSession
        even = self.chunks.hint("rebalance", F.col("cell"))  # splits the files of a cell that holds much of the table
        even.write.mode("overwrite").partitionBy("cell").parquet(f"{folder}/chunks")
        rows = [(i, [float(x) for x in c]) for i, c in enumerate(self.centroids)]
        centroids = spark.createDataFrame(rows, "cell int, centroid array<double>")
        centroids.write.mode("overwrite").parquet(f"{folder}/centroids")

    @staticmethod
    def read(spark: SparkSession, folder: str) -> CellIndex:
        rows = spark.read.parquet(f"{folder}/centroids").orderBy("cell").collect()
        return CellIndex(spark.read.parquet(f"{folder}/chunks"), np.array([r.centroid for r in rows]))

    def bounds(self, source: str | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Chunks of each cell, and its radius (-1 where it is empty): a scan of two narrow columns, one row per cell."""
        chunks = self.chunks if source is None else self.chunks.where(F.col("source") == source)
        count, radius = np.zeros(len(self.centroids), np.int64), np.full(len(self.centroids), -1.0)
        for r in chunks.groupBy("cell").agg(F.count("*").alias("n"), F.max("away").alias("radius")).collect():
            count[r.cell], radius[r.cell] = r.n, r.radius
        return count, radius


def build_cells(chunks: DataFrame, cells: int | None = None, seed: int = 0, centroids: np.ndarray | None = None) -> CellIndex:
    """Cells around ``centroids``, or around ``cells`` k-means centres of all usable unit vectors."""
    if centroids is None:
        usable = F.exists("embedding", lambda x: x != 0) & F.forall("embedding", lambda x: x.isNotNull())
        vectors = chunks.where(usable).select(array_to_vector("embedding").alias("_vector"))
        unit = Normalizer(p=2.0, inputCol="_vector", outputCol="_unit").transform(vectors)
        centroids = np.array(KMeans(k=cells, seed=seed, featuresCol="_unit").fit(unit).clusterCenters())
    shared = chunks.sparkSession.sparkContext.broadcast(np.asarray(centroids, dtype=float))

    @F.pandas_udf("cell int, away double")
    def nearest(vectors: pd.Series) -> pd.DataFrame:
        out = pd.DataFrame({"cell": pd.Series([None] * len(vectors), dtype="Int32"), "away": np.nan})
        batch = _usable(pa.RecordBatch.from_arrays([pa.array(vectors, pa.list_(pa.float64())), pa.array(range(len(vectors)))], names=["embedding", "at"]))
        if batch.num_rows:
            at, cell = batch.column("at").to_pylist(), _away(batch, shared.value).argmin(axis=1)
            out.loc[at, "cell"] = cell
            out.loc[at, "away"] = np.linalg.norm(_unit(_matrix(batch.column("embedding"))) - shared.value[cell], axis=1)
        return out

    names = [c for c in chunks.columns if c not in ("cell", "away")]
    placed = chunks.select(*names, nearest("embedding").alias("_place")).select(*names, "_place.cell", "_place.away")
    return CellIndex(placed.where(F.col("cell").isNotNull()), np.asarray(centroids, dtype=float))


def _away(batch: pa.RecordBatch, centroids: np.ndarray) -> np.ndarray:
    """Squared distances of unit vectors to centroids, less one; equal after rounding means the lower number wins."""
    return np.round((centroids**2).sum(axis=1) - 2.0 * _unit(_matrix(batch.column("embedding"))) @ centroids.T, _DECIMALS)


def _nearest_cells(queries: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``cells``: the ``param_value`` nearest cells of each query."""
    schema = T.StructType(queries.schema.fields + [T.StructField("cells", T.ArrayType(T.IntegerType()))])
    shared = queries.sparkSession.sparkContext.broadcast(centroids)

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = _usable(batch)
            if not batch.num_rows:
                continue
            order = np.argsort(_away(batch, shared.value), axis=1, kind="stable")
            params = batch.column("param_value").to_pylist()
            cells = pa.array([row[:p].tolist() for row, p in zip(order, params)], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns, cells], names=schema.fieldNames())

    return queries.mapInArrow(nearest, schema)


def cell_top_k(
    index: CellIndex,
    queries: DataFrame,
    probes: Sequence[int],
    k: int = 15,
    source: str | None = None,
    query_bytes: int | None = None,
) -> DataFrame:
    """Approximate search in the ``probe`` nearest cells of each query, one run per value of ``probes``.

    The source filter acts before the search, so a query gets ``k`` rows whenever its cells hold that many.
    All values share one scan of the chunks.
    """
    require_unique(queries, ["query_id"])
    side = _nearest_cells(_query_side(queries, probes), index.centroids)
    found = _search(_chunk_side(index.chunks, source, F.col("cell")), _texts(index.chunks, source), side, queries, k, query_bytes)
    return _as_hits(found, _sweep_name(k))


def _cells_within(queries: DataFrame, centroids: np.ndarray, count: np.ndarray, radius: np.ndarray, least: int) -> DataFrame:
    """``cells`` of each query that may hold a chunk no farther than its ``limit`` (a cosine distance).

    Without a limit: the nearest cells that hold ``least`` chunks together. No chunk of a cell is nearer to a query than the
    centroid's distance less the cell's radius, and the cosine distance of unit vectors is half their squared distance.
    """
    schema = T.StructType(queries.schema.fields + [T.StructField("cells", T.ArrayType(T.IntegerType()))])
    shared = queries.sparkSession.sparkContext.broadcast((centroids, count, radius))

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centroids, count, radius = shared.value
        filled = np.flatnonzero(count)
        for batch in batches:
            batch = _usable(batch)
            if not batch.num_rows:
                continue
            unit = _unit(_matrix(batch.column("embedding")))
            out = []
            for u, limit in zip(unit, batch.column("limit").to_pylist()):
                distance = np.linalg.norm(centroids[filled] - u, axis=1)
                if limit is None:
                    order = np.argsort(distance, kind="stable")
                    enough = int(np.searchsorted(np.cumsum(count[filled][order]), least)) + 1
                    out.append(filled[order[:enough]].tolist())
                else:
                    nearest = np.maximum(distance - radius[filled], 0)
                    out.append(filled[nearest**2 / 2 <= limit + _SLACK].tolist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.list_(pa.int32()))], names=schema.fieldNames())

    return queries.mapInArrow(choose, schema)


def cells_to_recall(
    index: CellIndex,
    queries: DataFrame,
    recall: float = 1.0,
    k: int = 15,
    source: str | None = None,
    query_bytes: int | None = None,
) -> DataFrame:
    """Search in as many cells as each query needs for a ``recall`` of its own, with ``cells_read`` besides.

    Of the ``k`` nearest chunks of a query the nearest ``recall * k`` (rounded up) are always found; 1.0 is exact search. A first scan of
    the nearest cells bounds the distance of the last one of these; a second one reads the cells that may hold a nearer
    chunk, by the triangle inequality. How many these are depends on the data: cells that overlap much are all read.
    The guarantee counts chunks by rows of the index: it holds where no name repeats.
    """
    if not 0 < recall <= 1:
        raise ValueError(f"recall {recall} is not in (0, 1]")
    require_unique(queries, ["query_id"])
    sure = int(np.ceil(round(recall * k, _DECIMALS)))
    count, radius = index.bounds(source)
    chunks = _chunk_side(index.chunks, source, F.col("cell"))
    side = _query_side(queries, [round(100 * recall)])
    first = _cells_within(side.withColumn("limit", F.lit(None).cast("double")), index.centroids, count, radius, sure)
    # Fewer hits than asked for: every cell is read.
    last = _merged(chunks, first, sure, query_bytes).groupBy("query_id").agg(F.count("*").alias("n"), F.max("cost").alias("cost"))
    limit = last.select("query_id", F.when(F.col("n") == sure, F.col("cost")).otherwise(F.lit(4.0)).alias("limit"))
    limited = side.join(limit, "query_id", "left").withColumn("limit", F.coalesce("limit", F.lit(4.0))).select(*side.columns, "limit")
    second = stage(_cells_within(limited, index.centroids, count, radius, sure))
    found = _search(chunks, _texts(index.chunks, source), second, queries, k, query_bytes)
    hits = _as_hits(found, F.format_string("cells_r%d_k%d", "param_value", F.lit(k)))
    return hits.join(second.select("query_id", F.size("cells").alias("cells_read")), "query_id")


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """(run_name, param_value, recall): share of the exact hits that an approximate run also has."""
    truth = exact.select("query_id", "chunk_id", F.lit(1).alias("hit"))
    total = truth.agg(F.count("*").alias("n")).select("n").scalar()
    runs = found.select("run_name", "param_value", "query_id", "chunk_id").join(truth, ["query_id", "chunk_id"], "left")
    return runs.groupBy("run_name", "param_value").agg(
        (F.sum(F.coalesce("hit", F.lit(0))) / F.first(total)).alias("recall")
    )
