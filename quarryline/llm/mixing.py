"""Mixing overlapping sources to target weights as a min-cost flow.

Documents that belong to the same sources are interchangeable, so Spark aggregates their sizes by membership pattern. The flow
runs from patterns to the sources they belong to, and from sources into their targets. A pattern's words cost nothing the
first time, one more for every further repetition (a convex cost), and are available ``most`` times. The cheapest flow of the
greatest value is exact and integer. It sees patterns, never documents.

What a pattern sends is taken from its documents in a seeded order: all of them as often as the flow covers the whole
pattern, then one more time from the front until the rest is used up, the last one in part.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Hashable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarryline.operators.scale import running_sum, small_join
from quarryline.session import stage

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
SHARE = (3, 2)  # the mix has 3/2 of the words of all documents
MOST = 2  # times that a document, and a source, may be used
SEED = "mix"


@dataclass(frozen=True)
class Target:
    """A source's share of the mix: ``words / parts`` words, and ``quota``, the same as a whole number (halves go up)."""

    words: int
    parts: int

    @property
    def quota(self) -> int:
        return (2 * self.words + self.parts) // (2 * self.parts)

    @property
    def value(self) -> float:
        return self.words / self.parts


def targets(sizes: Sequence[int], weights: Sequence[int], share: tuple[int, int] = SHARE, most: int = MOST) -> list[Target]:
    """``share`` of all sizes by weight. A target stops at ``most`` times its source's size, and what is above goes to the
    others by weight, until none is above. In whole numbers, so that the order of summation does not matter."""
    up, down = share
    budget = up * sum(sizes)  # in units of 1 / down
    out = [Target(0, 1)] * len(sizes)
    left, weight = budget, sum(weights)
    # The smaller the room per weight, the earlier a source is full.
    order = sorted(range(len(sizes)), key=lambda i: most * sizes[i] / weights[i])
    for at, i in enumerate(order):
        if left * weights[i] < most * down * sizes[i] * weight:
            for j in order[at:]:
                out[j] = Target(left * weights[j], down * weight)
            return out
        out[i] = Target(most * sizes[i], 1)
        left, weight = max(left - most * down * sizes[i], 0), weight - weights[i]
    return out


def min_cost_flow(
    supply: Mapping[Hashable, int], edges: Mapping[Hashable, Sequence[Hashable]], quota: Mapping[Hashable, int], most: int = MOST
) -> dict[tuple[Hashable, Hashable], int]:
    """Words from each pattern to each of its sources: as many as the quotas allow, at the least total of repetitions.

    All costs are on the supplies and equal within a repetition, so the supplies that a flow can have form a polymatroid,
    and opening one repetition after the other and augmenting along shortest paths gives the cheapest flow.
    """
    flow: dict[tuple[Hashable, Hashable], int] = {(p, s): 0 for p, sources in edges.items() for s in sources}
    users: dict[Hashable, list[Hashable]] = {}
    for p, sources in edges.items():
        for s in sources:
            users.setdefault(s, []).append(p)
    room, free = dict(quota), dict.fromkeys(supply, 0)
    for _ in range(most):
        for p in supply:
            free[p] += supply[p]
        # Most words need no detour: fill in place first, then move others' words out of the way.
        for p, sources in edges.items():
            for s in sources:
                moved = min(free[p], room.get(s, 0))
                flow[p, s] += moved
                free[p] -= moved
                room[s] = room.get(s, 0) - moved
        while True:
            # One breadth-first search from all patterns with free words: pattern -> source -> pattern that can make room.
            came: dict[tuple[str, Hashable], tuple[str, Hashable] | None] = {("p", p): None for p in supply if free[p] > 0}
            queue, end = deque(came), None
            while queue and end is None:
                kind, at = queue.popleft()
                if kind == "p":
                    for s in edges[at]:
                        if ("s", s) not in came:
                            came["s", s] = (kind, at)
                            if room.get(s, 0) > 0:
                                end = ("s", s)
                                break
                            queue.append(("s", s))
                else:
                    for p in users[at]:
                        if flow[p, at] > 0 and ("p", p) not in came:
                            came["p", p] = (kind, at)
                            queue.append(("p", p))
            if end is None:
                break
            path = [end]
            while came[path[-1]] is not None:
                path.append(came[path[-1]])
            path.reverse()  # pattern, source, pattern, source, ...
            amount = min(free[path[0][1]], room[end[1]])
            for (_, s), (_, p) in zip(path[1::2], path[2::2]):
                amount = min(amount, flow[p, s])
            for (kind, a), (_, b) in zip(path, path[1:]):
                if kind == "p":
                    flow[a, b] += amount
                else:
                    flow[b, a] -= amount
            free[path[0][1]] -= amount
            room[end[1]] -= amount
    return flow


def _weights(sources: Sequence[str | None], weights: Sequence[int]) -> dict[str | None, int]:
    ordered = sorted(sources, key=lambda s: (s is None, s or ""))
    return {s: weights[i % len(weights)] for i, s in enumerate(ordered)}


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def seeded(*parts: Column, seed: str = SEED) -> Column:
    """A reproducible order of documents: the MD5 of the seed and the parts (null parts count as ``-``)."""
    return F.md5(F.concat_ws("|", F.lit(seed), *[F.coalesce(p.cast("string"), F.lit("-")) for p in parts]).cast("binary"))


def mix(
    docs: DataFrame, memberships: Column, size: Column, order: Column, weights: Sequence[int] = WEIGHTS,
    share: tuple[int, int] = SHARE, most: int = MOST,
) -> tuple[DataFrame, DataFrame]:
    """(``docs`` with ``size`` and ``taken``; sources (source, source_size, target, quota, routed)).

    ``memberships`` is the array of sources that a document belongs to; null may be one of them, and an empty or null array
    means none, so that nothing is taken. A source's size is that of all its documents. ``taken`` counts repetitions and is
    at most ``most`` times the size. ``order`` decides which documents are taken once more; rows that are equal in it take
    turns in any order, so it should tell documents apart. Columns of ``docs`` pass through; ``size`` and ``taken`` must be free.

    The driver holds the patterns and the sources: numbers of distinct values, not of documents.
    """
    names = docs.columns
    if clash := [c for c in names if c.lower() in ("size", "taken")]:
        raise ValueError(f"columns {clash} would be overwritten")
    known = F.coalesce(memberships, F.array().cast("array<string>"))
    whole = F.struct(*[F.col(f"`{c}`").alias(c) for c in names])
    rows = stage(
        docs.select(whole.alias("_row"), F.array_sort(F.array_distinct(known)).alias("_pattern"), size.cast("bigint").alias("size"), order.alias("_order"))
    )
    found = rows.groupBy("_pattern").agg(F.sum("size").alias("size")).collect()
    patterns = {tuple(r["_pattern"]): r["size"] for r in found}
    sizes: dict[str | None, int] = {}
    for pattern, n in patterns.items():
        for s in pattern:
            sizes[s] = sizes.get(s, 0) + n
    wanted = _weights(list(sizes), weights)
    goal = dict(zip(sizes, targets(list(sizes.values()), [wanted[s] for s in sizes], share, most)))
    flow = min_cost_flow(patterns, {p: p for p in patterns}, {s: t.quota for s, t in goal.items()}, most)
    sent: dict[tuple, int] = dict.fromkeys(patterns, 0)
    routed = dict.fromkeys(sizes, 0)
    for (p, s), n in flow.items():
        sent[p] += n
        routed[s] += n

    spark = docs.sparkSession
    per_pattern = spark.createDataFrame(
        [(list(p), *divmod(sent[p], n)) if n else (list(p), 0, 0) for p, n in patterns.items()],
        "_pattern array<string>, _times long, _rest long",
    )
    # Only sizes and orders are sorted; where a pattern ends does not depend on how its documents are spread.
    before = running_sum(rows, ["_pattern"], [F.col("_order"), F.col("size")], F.col("size"), "_before")
    placed = small_join(before, per_pattern, ["_pattern"], spread="_order")
    extra = F.greatest(F.lit(0), F.least(F.col("size"), F.col("_rest") - F.col("_before")))
    taken = (F.col("_times") * F.col("size") + extra).cast("bigint")
    out = placed.select(*[F.col("_row")[c].alias(c) for c in names], "size", taken.alias("taken"))
    sources = spark.createDataFrame(
        [(s, sizes[s], goal[s].value, goal[s].quota, routed[s]) for s in sizes],
        T.StructType.fromDDL("source string, source_size long, target double, quota long, routed long"),
    )
    return out, sources


def mix_documents(docs: DataFrame) -> DataFrame:
    """``documents`` mixed by ``source``: (doc_id, source, size, source_size, target, taken), one row per document.

    The size is the number of words (null text: 0). A null source is a source, the last one in the order of weights.
    Repeated rows are documents of their own. Targets are rounded to 6 decimals. No documents give no rows.
    """
    source, text = F.col("source"), F.col("text")
    slim = docs.select("doc_id", source.cast("string").alias("source"), words(text).alias("_n"), F.md5(text.cast("binary")).alias("_text"))
    mixed, sources = mix(slim, F.array("source"), F.col("_n"), seeded(F.col("doc_id"), F.col("_text")))
    named = sources.select(F.col("source").alias("_source"), "source_size", F.round("target", 6).alias("target"))
    full = mixed.join(F.broadcast(named), F.col("source").eqNullSafe(F.col("_source")))  # a row per source, made on the driver
    return full.select("doc_id", "source", "size", "source_size", "target", "taken")
