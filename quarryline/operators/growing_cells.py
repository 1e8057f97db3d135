"""A cell index that grows: chunks come and go, and cells are split or merged by their measured size.

A chunk is always in the cell of its nearest centroid, as if the index had been built around the present centroids. The
driver holds the centroids and one row per cell, as for any cell index; chunks stay in their tasks.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarryline.operators.nearest import slim
from quarryline.operators.scale import small_join
from quarryline.operators.vector import CellIndex, _matrix, _unit, build_cells
from quarryline.session import stage

_DECIMALS = 9
_SLACK = 1e-6  # distances closer than this are compared anew
_ROUNDS = 64  # each round may halve a cell


def delete(index: CellIndex, names: DataFrame) -> CellIndex:
    """The index without the chunks that ``names`` (chunk_id[, source]) names; a null source is a name as well.

    Names may repeat, or name nothing. They are measured, then broadcast or met by a shuffle.
    """
    key = [F.col("chunk_id").alias("_id"), F.coalesce("source", F.lit("")).alias("_source")]
    gone = slim(names).select(*key).distinct()
    kept = slim(index.chunks).withColumns({"_id": key[0], "_source": key[1]})
    rest = small_join(kept, gone, ["_id", "_source"], "left_anti")
    return CellIndex(rest.select(*index.chunks.columns), index.centroids)


def append(index: CellIndex, chunks: DataFrame) -> CellIndex:
    """The index with further chunks, each in the cell of its nearest centroid. A chunk whose name is known is replaced.

    ``chunks`` has the columns the index was built from; those without a usable vector are left out, and with them an
    earlier chunk of that name. Nothing is computed before the index is searched, balanced or written.
    """
    added = build_cells(chunks, centroids=index.centroids).chunks
    return CellIndex(delete(index, chunks).chunks.unionByName(added), index.centroids)


def append_files(folder: str, chunks: DataFrame) -> None:
    """Add chunks with new names to an index that ``CellIndex.write`` left in ``folder``: what is there is not read or moved."""
    centroids = CellIndex.read(chunks.sparkSession, folder).centroids
    added = build_cells(chunks, centroids=centroids).chunks
    added.hint("rebalance", F.col("cell")).write.mode("append").partitionBy("cell").parquet(f"{folder}/chunks")


def balance(index: CellIndex, most: int, least: int = 1, steps: int = 4) -> CellIndex:
    """Cells of fewer than ``least`` chunks go, then cells of more than ``most`` are halved until none is left.

    A cell is halved by 2-means (``steps`` rounds) from its farthest chunk and that one's mirror image at the mean. It stays whole where
    a half would hold fewer than ``least`` chunks, which copies of one vector always do. Only chunks that a new
    centroid may attract are placed anew: by the triangle inequality those farther from their own centroid than half
    its distance to a new one. The result is staged.
    """
    if not 1 <= least <= most:
        raise ValueError(f"cells of {least} to {most} chunks")
    index = CellIndex(stage(index.chunks), index.centroids)
    count, radius = index.bounds()
    thin = np.flatnonzero(count < least)
    if len(thin) == len(count):  # the largest one stays
        thin = np.delete(thin, int(np.argmax(count)))
    if len(thin):
        index = _move(index, {}, thin)
    whole: set[tuple[float, ...]] = set()  # centroids of cells that cannot be halved
    for _ in range(_ROUNDS):
        count, radius = index.bounds()
        wide = [int(c) for c in np.flatnonzero((count > most) & (radius > _SLACK)) if tuple(index.centroids[c]) not in whole]
        if not wide:
            break
        halves = _halves(index, wide, steps)
        good = {c: pair for c, (pair, sizes) in halves.items() if min(sizes) >= least}
        whole |= {tuple(index.centroids[c]) for c in wide if c not in good}
        if good:
            index = _move(index, good, np.zeros(0, int))
    return index


def _sums(chunks: DataFrame, centres: dict[int, np.ndarray]) -> dict[tuple[int, int], tuple[int, np.ndarray]]:
    """(chunks, mean unit vector) by cell and number of the nearest of its ``centres``; a task returns a row per centre."""
    shared = chunks.sparkSession.sparkContext.broadcast(centres)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[int, int], list] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            cells, unit = batch.column("cell").to_numpy(), _unit(_matrix(batch.column("embedding")))
            for cell in np.unique(cells).tolist():
                mine, around = unit[cells == cell], shared.value[cell]
                nearest = np.round((around**2).sum(axis=1) - 2.0 * mine @ around.T, _DECIMALS).argmin(axis=1)
                for half in np.unique(nearest).tolist():
                    so_far = found.setdefault((cell, half), [0, 0.0])
                    so_far[0] += int((nearest == half).sum())
                    so_far[1] = so_far[1] + mine[nearest == half].sum(axis=0)
        keys = list(found)
        columns = [
            pa.array([c for c, _ in keys], pa.int32()), pa.array([h for _, h in keys], pa.int32()),
            pa.array([found[k][0] for k in keys], pa.int64()), pa.array([found[k][1].tolist() for k in keys], pa.list_(pa.float64())),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=["cell", "half", "n", "total"])

    parts = chunks.select("cell", F.col("embedding").cast("array<double>").alias("embedding")).mapInArrow(work, "cell int, half int, n long, total array<double>")
    total = vector_to_array(Summarizer.sum(array_to_vector("total"))).alias("total")
    rows = parts.groupBy("cell", "half").agg(F.sum("n").alias("n"), total)
    return {(r.cell, r.half): (r.n, np.round(np.array(r.total) / r.n, _DECIMALS)) for r in rows.collect()}


def _halves(index: CellIndex, cells: Sequence[int], steps: int) -> dict[int, tuple[np.ndarray, list[int]]]:
    """Two centres for each cell, and how many of its chunks are nearest to either."""
    chunks = slim(index.chunks.where(F.col("cell").isin(list(cells))))
    last = F.max_by("embedding", F.struct("away", "chunk_id", "source")).alias("embedding")
    farthest = {r.cell: _unit(np.array([r.embedding], float))[0] for r in chunks.groupBy("cell").agg(last).collect()}
    centres = {}
    for (cell, _), (_, mean) in _sums(chunks, {c: index.centroids[[c]] for c in cells}).items():
        centres[cell] = np.stack([farthest[cell], 2 * mean - farthest[cell]])
    sizes = {c: [0, 0] for c in cells}
    for _ in range(steps):
        sizes = {c: [0, 0] for c in cells}
        moved = {c: pair.copy() for c, pair in centres.items()}
        for (cell, half), (n, mean) in _sums(chunks, centres).items():
            sizes[cell][half], moved[cell][half] = n, mean
        centres = moved
    return {c: (centres[c], sizes[c]) for c in cells}


def _move(index: CellIndex, halves: dict[int, np.ndarray], gone: np.ndarray) -> CellIndex:
    """The index with some cells halved (the second half gets a new number) and others gone; later cells move up."""
    old = index.centroids
    changed = sorted(halves)
    kept = [c for c in range(len(old)) if c not in set(gone.tolist())]
    now = old.copy()
    for c in changed:
        now[c] = halves[c][0]
    centroids = np.concatenate([now[kept], *[halves[c][1:] for c in changed]])
    fresh = np.concatenate([halves[c] for c in changed]) if changed else np.zeros((0, old.shape[1]))
    rows = []
    for number, c in enumerate(kept):
        gap = 0.0 if c in halves else float(np.linalg.norm(fresh - old[c], axis=1).min()) if len(fresh) else None
        rows.append((c, number, gap))
    rows += [(int(c), None, 0.0) for c in gone]
    # One row per cell, as the centroids themselves.
    moves = index.chunks.sparkSession.createDataFrame(rows, "cell int, _number int, _gap double")
    joined = index.chunks.withColumn("cell", F.col("cell").cast("int")).join(F.broadcast(moves), "cell")
    near = F.coalesce(2 * F.col("away") + F.lit(_SLACK) < F.col("_gap"), F.lit(True))
    names = index.chunks.columns
    stay = joined.where(near).withColumn("cell", F.col("_number")).select(*names)
    again = build_cells(joined.where(~near).select(*names), centroids=centroids).chunks.select(*names)
    return CellIndex(stage(stay.unionByName(again)), centroids)
