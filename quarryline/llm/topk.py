"""Exact top-k by inner product with multi-resolution segment statistics.

A vector is summarised by the mean and the deviation of each of its segments, on several levels from one segment to many.
For segments of width w, ``w * (mean_q * mean_x + dev_q * dev_x)`` bounds the inner product from above (equivalently, it
bounds the distance from below). A task goes from coarse to fine: on each level it drops the pairs whose bound is under
the query's k-th best score so far, then scores the survivors exactly. No pair is lost: bounds have a margin for rounding,
and equal scores stay until ids decide.

The stated queries are cut into blocks of at most ``QUERY_BLOCK`` rows, which is what the driver ever holds; a block is
sent to the tasks and meets all candidates in one scan. A task returns at most k rows per query. Nothing is shuffled but
these.

Vectors that are null or hold null or non-finite components, and rows without an id, take no part; vectors of another width
than the query's are no candidates. Components become ``floor(1024 * x)``. Ties go to the smaller id; repeated rows are
candidates of their own, but a repeated query id is asked once, with its smallest vector. No queries or no candidates give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarryline.operators.scale import top_k

K, LEVELS = 10, (1, 4, 16)
QUERY_BLOCK = 4096
_CELLS = 4_000_000  # pairs that a task looks at in one go


def whole_numbers(embedding: Column) -> Column:
    return F.transform(embedding, lambda x: F.floor(F.lit(1024.0) * x.cast("double")).cast("long"))


def _usable(vectors: DataFrame) -> DataFrame:
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    fit = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where(F.col("vec_id").isNotNull() & fit).select("vec_id", whole_numbers(F.col("embedding")).alias("v"))


def summary(rows: np.ndarray, segments: int) -> np.ndarray:
    """Means and deviations of the segments, scaled so that their inner product is the bound."""
    parts = np.array_split(np.arange(rows.shape[1]), min(segments, max(rows.shape[1], 1)))
    out = []
    for part in parts:
        cut = rows[:, part]
        out += [cut.mean(axis=1) * np.sqrt(len(part)), cut.std(axis=1) * np.sqrt(len(part))]
    return np.stack(out, axis=1)


class Best:
    """The k best candidates so far of each query of one width."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, k: int) -> None:
        self.ids, self.rows, self.k = ids, rows, k
        self.levels = [summary(rows, s) for s in LEVELS] if rows.shape[1] else []
        self.score = np.zeros((len(ids), 0))
        self.found = np.zeros((len(ids), 0), np.int64)
        self.pairs = self.scored = 0

    def add(self, ids: np.ndarray, rows: np.ndarray) -> None:
        step = max(self.k, _CELLS // max(len(self.ids), 1))
        # A few rows come first where there are no scores yet, as bounds have nothing to be compared with till then.
        first = min(step, 16 * self.k) if self.found.shape[1] < self.k else 0
        for start, end in [(0, first), *((a, a + step) for a in range(first, len(ids), step))]:
            if start < min(end, len(ids)):
                self._add(ids[start:end], rows[start:end])

    def _add(self, ids: np.ndarray, rows: np.ndarray) -> None:
        limit = np.full(len(self.ids), -np.inf)
        full = (self.found >= 0).sum(axis=1) >= self.k if self.found.shape[1] else np.zeros(len(self.ids), bool)
        if self.found.shape[1] >= self.k:
            limit[full] = self.score[full, self.k - 1]
        self.pairs += len(ids) * len(self.ids)
        for level, segments in zip(self.levels, LEVELS):
            bound = summary(rows, segments) @ level.T
            kept = (bound + 1e-6 * np.abs(bound) + 1.0 >= limit[None, :]).any(axis=1)
            ids, rows = ids[kept], rows[kept]
            if not len(ids):
                return
        self.scored += len(ids) * len(self.ids)
        score = rows @ self.rows.T  # whole numbers far below 2**53 are exact
        score[ids[:, None] == self.ids[None, :]] = -np.inf
        score = score.T
        # Of the new rows only those that may be among the best, equal scores included.
        if score.shape[1] > self.k:
            least = -np.partition(-score, self.k - 1, axis=1)[:, self.k - 1]
            columns = np.flatnonzero((score >= np.maximum(least, limit)[:, None]).any(axis=0))
            score, ids = score[:, columns], ids[columns]
        found = np.where(np.isneginf(score), -1, ids[None, :])
        score = np.concatenate([self.score, score], axis=1)
        found = np.concatenate([self.found, found], axis=1)
        order = np.lexsort((found, -score), axis=1)[:, : self.k]
        self.score, self.found = np.take_along_axis(score, order, axis=1), np.take_along_axis(found, order, axis=1)

    def table(self) -> list[np.ndarray]:
        query, place = np.nonzero(~np.isneginf(self.score))
        return [self.ids[query], self.found[query, place], self.score[query, place].astype(np.int64)]


def _by_width(batch: pa.RecordBatch | pa.Table) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    ids = batch.column("vec_id").to_numpy()
    vectors = batch.column("v")
    vectors = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    size = np.asarray(vectors.value_lengths())
    flat, ends = vectors.flatten().to_numpy().astype(np.float64), np.cumsum(size)
    for width in np.unique(size).tolist():
        here = np.flatnonzero(size == width)
        at = (ends[here] - width)[:, None] + np.arange(width)[None, :]
        yield width, ids[here], flat[at].reshape(len(here), width)


def search(vectors: DataFrame, is_query: Column, k: int = K, query_block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best rows for every query row, itself left out."""
    rows = _usable(vectors)
    asked = rows.where(is_query).groupBy("vec_id").agg(F.min("v").alias("v"))
    blocks = max(1, -(-asked.count() // (query_block // 2)))  # hashed, so a block stays well below ``query_block``
    block = F.pmod(F.xxhash64("vec_id"), F.lit(blocks))
    spark = vectors.sparkSession

    def scan(number: int) -> DataFrame:
        table = asked.where(block == number).toArrow()
        shared = spark.sparkContext.broadcast([(w, i, r) for w, i, r in _by_width(table)] if table.num_rows else [])

        def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            best = {width: Best(ids, queries, k) for width, ids, queries in shared.value}
            for batch in batches:
                for width, ids, candidates in _by_width(batch):
                    if width in best:
                        best[width].add(ids, candidates)
            for one in best.values():
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in one.table()], names=["query_id", "vec_id", "score"])

        return rows.mapInArrow(nearest, "query_id long, vec_id long, score long")

    partial = reduce(DataFrame.unionByName, [scan(n) for n in range(blocks)])
    return top_k(partial, ["query_id"], [F.desc("score"), F.col("vec_id")], k, spread="vec_id").select("query_id", "rank", "vec_id", "score")
