"""From hash keys to verified links, link counts and components, without a row per pair.

Items that share a key are candidates. Every item takes the smallest item that it shares a key with as its label; items of one
label are cut into blocks of about ``BLOCK``, and a tile is a pair of blocks that share a key. An item's payload travels once
per tile, and a task verifies all pairs of a tile at once. A pair belongs to one tile, so links are counted once. What a
tile returns is one row per linked item: how many it is linked to, and the smallest item of its local component.

A group of copies of any size is thereby cut into tiles of bounded size that spread over all tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarryline.session import stage

BLOCK = 96
Verify = Callable[[list[bytes], list[bytes]], np.ndarray]


def components(edges: DataFrame) -> DataFrame:
    """(id, component) of every id in ``edges`` (a, b): the smallest id reachable. Self-edges and nulls are ignored.

    Alternating large-star and small-star rounds until every id has one edge, and that to an id without any. Rounds are
    staged, so lineage stays short. Hubs are only ever the key of a partial minimum and one side of a join, which adaptive
    execution splits.
    """
    a, b = F.col("a"), F.col("b")
    now = stage(edges.where(a != b).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct())
    while True:
        repeated = now.groupBy("a").agg(F.count("*").alias("n")).where("n > 1")
        hubs = now.select(b.alias("key")).distinct()
        if repeated.isEmpty() and now.join(hubs, a == F.col("key"), "left_semi").isEmpty():
            return now.select(a.alias("id"), b.alias("component"))
        both = now.unionByName(now.select(b.alias("a"), a.alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(a.alias("key"), F.least("a", "m").alias("m"))
        large = both.where(b > a).join(least, a == F.col("key")).select(b.alias("a"), F.col("m").alias("b")).where(a != b)
        large = stage(large)
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(low.withColumnRenamed("a", "key"), a == F.col("key")).where(b != F.col("m")).select(b.alias("a"), F.col("m").alias("b"))
        now = stage(moved.unionByName(low.select("a", F.col("m").alias("b"))).distinct())


def _tiles(shared: DataFrame, block: int) -> DataFrame:
    """(rep, tiles) from (key, rep, least), where ``least`` is the smallest item of the key: ``tiles`` holds (tile, side) of
    each tile the item travels to."""
    label = shared.groupBy("rep").agg(F.min("least").alias("label"))
    size = label.groupBy("label").agg(F.count("*").alias("size"))
    part = F.pmod(F.xxhash64("rep"), F.ceil(F.col("size") / block))
    placed = stage(label.join(size, "label").select("rep", F.xxhash64("label", part).alias("block")))
    of_key = shared.join(placed, "rep").select("key", "block").distinct()
    left, right = of_key.select("key", F.col("block").alias("x")), of_key.select("key", F.col("block").alias("y"))
    met = left.join(right, "key").where(F.col("x") <= F.col("y")).select("x", "y").distinct()
    tile = F.xxhash64("x", "y")
    ends = F.when(F.col("x") == F.col("y"), F.array(F.struct(F.col("x").alias("block"), F.lit(0).alias("side")))).otherwise(
        F.array(F.struct(F.col("x").alias("block"), F.lit(0).alias("side")), F.struct(F.col("y").alias("block"), F.lit(1).alias("side")))
    )
    sides = met.select(tile.alias("tile"), F.explode(ends).alias("end")).select("end.block", F.struct("tile", F.col("end.side").alias("side")).alias("t"))
    lists = sides.groupBy("block").agg(F.collect_list("t").alias("tiles"))
    return placed.join(lists, "block").select("rep", "tiles")


def _local(linked: np.ndarray) -> np.ndarray:
    """The smallest position reachable from each position of a symmetric boolean matrix."""
    label = np.arange(len(linked))
    while True:
        new = np.minimum(label, np.where(linked, label[None, :], len(label)).min(axis=1))
        new = new[new]
        if (new == label).all():
            return label
        label = new


def link(reps: DataFrame, payload: Callable[[DataFrame], DataFrame], verify: Verify, block: int = BLOCK) -> DataFrame:
    """(rep, n_links, component) of every item that is linked to another.

    ``reps`` has (rep long, copies long, keys array<long>), one row per item. ``payload`` takes the rows of candidates, with
    ``tiles`` in place of the keys, and returns at least (rep, copies, tiles) and ``payload`` binary. ``verify`` says which items of two lists of payloads are linked.
    ``n_links`` counts the partners with their copies.
    """
    keyed = reps.select("rep", F.explode(F.array_distinct("keys")).alias("key"))
    often = keyed.groupBy("key").agg(F.count("*").alias("n"), F.min("rep").alias("least")).where("n > 1").drop("n")
    shared = stage(keyed.join(often, "key"))
    work = reps.drop("keys").join(_tiles(shared, block), "rep")
    rows = payload(work).select(F.explode("tiles").alias("t"), "rep", "copies", "payload").select("t.*", "rep", "copies", "payload")
    dealt = rows.repartition("tile").sortWithinPartitions("tile")

    def check(group: list[tuple[int, int, int, bytes]]) -> Iterator[tuple[int, int, int]]:
        seen = {(side, rep): (copies, data) for side, rep, copies, data in group}  # a repeated row counts once
        left = [(r, *v) for (s, r), v in sorted(seen.items(), key=lambda x: x[0]) if s == 0]
        right = [(r, *v) for (s, r), v in sorted(seen.items(), key=lambda x: x[0]) if s == 1]
        linked = verify([x[2] for x in left], [x[2] for x in right] if right else [x[2] for x in left])
        if right:
            n = len(left) + len(right)
            whole = np.zeros((n, n), bool)
            whole[: len(left), len(left) :] = linked
            whole[len(left) :, : len(left)] = linked.T
        else:
            whole = linked & ~np.eye(len(left), dtype=bool)
        touched = np.flatnonzero(whole.any(axis=1))
        if not len(touched):
            return
        items = left + right
        weight = np.array([x[1] for x in items])
        count, label = whole @ weight, _local(whole)
        names = [x[0] for x in items]
        smallest: dict[int, int] = {}
        for k in touched.tolist():
            root = int(label[k])
            smallest[root] = min(smallest.get(root, names[k]), names[k])
        for k in touched.tolist():
            yield names[k], int(count[k]), smallest[int(label[k])]

    def work_on(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: list[tuple[int, int, int, bytes]] = []
        current, out = None, []

        def packed() -> pa.RecordBatch:
            columns = [pa.array(c, pa.int64()) for c in zip(*out)]
            return pa.RecordBatch.from_arrays(columns, names=["rep", "n", "root"])

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("side", "rep", "copies", "payload")]
            for tile, *row in zip(batch.column("tile").to_pylist(), *columns):
                if tile != current:
                    if len(group) > 1:
                        out += check(group)
                    group, current = [], tile
                group.append(tuple(row))
            if out:
                yield packed()
                out = []
        if len(group) > 1:
            out += check(group)
        if out:
            yield packed()

    verified = stage(dealt.mapInArrow(work_on, "rep long, n long, root long"))
    final = components(verified.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    counts = verified.groupBy("rep").agg(F.sum("n").alias("n_links"))
    joined = counts.join(final.withColumnRenamed("id", "rep"), "rep", "left")
    return joined.select("rep", "n_links", F.coalesce("component", "rep").alias("component"))
