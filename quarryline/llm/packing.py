"""Best-fit packing with linear grouping.

Documents become pieces of at most ``capacity`` tokens. How they are packed depends on nothing but how many pieces
there are of each length, which is at most ``capacity`` numbers however large the input is, so the plan is made on
the driver from that histogram and never sees a document:

1. Large lengths are split into groups of equal cardinality, each rounded up to its longest piece.
2. Patterns over these few sizes are optimised by column generation (a linear program, knapsack pricing). Whole
   multiples of each pattern are taken.
3. Actual lengths replace the rounded ones, which frees room, tracked for runs of equal sequences.
4. What patterns left over and all small pieces go best-fit, longest first, into the fullest run that has room.

The plan says "pieces number i to i+n of length s stand at this offset of sequences q to q+n". Pieces are numbered
within their length by Spark (no length is gathered in one task) and look their place up in the plan.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarryline.llm import bpe
from quarryline.llm.rows import slices, texts
from quarryline.operators.scale import number_rows
from quarryline.session import stage

GROUPS = 24
SMALL = 3  # pieces up to capacity / SMALL tokens are small: at most two large ones share a sequence


def patterns(sizes: list[int], demand: list[int], capacity: int) -> list[tuple[np.ndarray, float]]:
    """Column generation: (how many of each size, how often) of an optimal fractional packing."""
    m = len(sizes)
    columns = np.diag([capacity // s for s in sizes]).astype(float)
    inverse = np.diag(1.0 / np.diag(columns))
    amount = inverse @ np.array(demand, float)
    for _ in range(60 * m):
        price = inverse.sum(axis=0)
        # Unbounded knapsack over the capacity: best value, and the last size put in.
        value, last = np.zeros(capacity + 1), np.full(capacity + 1, -1)
        order = np.array(sizes)
        for room in range(1, capacity + 1):
            value[room] = value[room - 1]
            fits = np.flatnonzero(order <= room)
            if len(fits):
                gain = value[room - order[fits]] + price[fits]
                best = int(np.argmax(gain))
                if gain[best] > value[room] + 1e-12:
                    value[room], last[room] = gain[best], fits[best]
        if value[capacity] <= 1 + 1e-9:
            break
        column, room = np.zeros(m), capacity
        while room > 0:
            if last[room] < 0:
                room -= 1
            else:
                column[last[room]] += 1
                room -= sizes[last[room]]
        direction = inverse @ column
        ratio = np.where(direction > 1e-9, amount / np.where(direction > 1e-9, direction, 1), np.inf)
        out = int(np.argmin(ratio))
        if not np.isfinite(ratio[out]):
            break
        step = ratio[out]
        amount = np.maximum(amount - step * direction, 0)
        amount[out] = step
        columns[:, out] = column
        pivot = inverse[out] / direction[out]
        inverse = inverse - np.outer(direction, pivot)
        inverse[out] = pivot
    return [(columns[:, k].astype(int), float(amount[k])) for k in range(m) if amount[k] > 1e-9]


def plan(counts: dict[int, int], capacity: int, groups: int = GROUPS) -> tuple[np.ndarray, int]:
    """Rows (length, first piece, pieces, first sequence, offset), sorted, and the number of sequences.

    ``counts`` says how many pieces there are of each length from 1 to ``capacity``.
    """
    entries: list[tuple[int, int, int, int, int]] = []
    taken = dict.fromkeys(counts, 0)
    sequences = 0
    runs: dict[int, list[tuple[int, int]]] = {}  # room left: (first sequence, sequences)

    def put(size: int, n: int, first: int, offset: int) -> None:
        entries.append((size, taken[size], n, first, offset))
        taken[size] += n

    large = sorted((s for s in counts if counts[s] and capacity // SMALL < s), reverse=True)
    total = sum(counts[s] for s in large)
    members: list[list[list[int]]] = []  # of each group: [length, pieces], longest first
    per_group, filled = -(-total // groups) if total else 1, 0
    for s in large:
        left = counts[s]
        while left:
            if not members or filled == per_group:
                members.append([])
                filled = 0
            n = min(left, per_group - filled)
            members[-1].append([s, n])
            left, filled = left - n, filled + n
    # Groups that round up to the same length are one.
    merged: list[list[list[int]]] = []
    for group in members:
        if merged and merged[-1][0][0] == group[0][0]:
            merged[-1] += group
        else:
            merged.append(group)
    if merged:
        sizes = [g[0][0] for g in merged]
        for column, amount in patterns(sizes, [sum(n for _, n in g) for g in merged], capacity):
            # A copy of the pattern takes whole groups' members from the front, slot by slot.
            copies = int(amount + 1e-6)
            for g in np.flatnonzero(column):
                copies = min(copies, sum(n for _, n in merged[g]) // int(column[g]))
            if not copies:
                continue
            now = [(sequences, copies, 0)]  # (first sequence, sequences, used)
            for g in np.repeat(np.arange(len(column)), column):
                after = []
                for first, n, used in now:
                    while n:
                        s, have = merged[g][0]
                        k = min(n, have)
                        put(s, k, first, used)
                        after.append((first, k, used + s))
                        first, n = first + k, n - k
                        merged[g][0][1] -= k
                        if not merged[g][0][1]:
                            merged[g].pop(0)
                now = after
            sequences += copies
            for first, n, used in now:
                runs.setdefault(capacity - used, []).append((first, n))
    for s in sorted(counts, reverse=True):
        left = counts[s] - taken[s]
        while left:
            room = min((r for r in runs if r >= s), default=None)
            if room is None:
                n = -(-left // (capacity // s))
                runs[capacity] = [(sequences, n)]
                sequences += n
                continue
            first, n = runs[room].pop()
            if not runs[room]:
                del runs[room]
            k = min(n, left)
            put(s, k, first, capacity - room)
            left -= k
            if k < n:
                runs.setdefault(room, []).append((first + k, n - k))
            if room > s:
                runs.setdefault(room - s, []).append((first, k))
    table = np.array(sorted(entries), dtype=np.int64).reshape(-1, 5)
    return table, sequences


def pieces(docs: DataFrame, path: str, end_id: int = 0, capacity: int = 2048) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): documents with their end id, cut only where they are too long."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, end = bpe.load(path), np.array([end_id], "<u4")
        for batch in slices(batches, "text", 2 << 20):
            rows: list[tuple[int, int, int, int, int]] = []
            for at, packed in enumerate(tokenizer.encode(batch.column("text").to_pylist())):
                ids = np.concatenate([np.frombuffer(packed, "<u2").astype("<u4"), end])
                first = len(ids) % capacity or capacity
                bounds = [0, *range(first, len(ids) + 1, capacity)]
                rows += [(at, k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(bounds, bounds[1:]))]
            if rows:
                at, piece, start, length, crc = (np.array(x) for x in zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").take(pa.array(at)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                        pa.array(length, pa.int64()), pa.array(crc, pa.int64()),
                    ],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    rows = texts(docs)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(work, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


def pack(cut: DataFrame, capacity: int = 2048, groups: int = GROUPS) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces with a ``length`` from 1 to ``capacity``.

    Ties: pieces of one length are numbered by (doc_id, piece); repeated rows get places of their own; a null doc_id
    is packed like any other; an empty input gives no rows. Each sequence is filled without a gap from 0.
    """
    cut = stage(cut)
    counts = {r.length: r.n for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}  # capacity rows at most
    table, _ = plan(counts, capacity, groups)
    numbered = number_rows(cut, ["length"], [F.col("doc_id"), F.col("piece"), F.col("ids_crc32")], "_number")
    shared = cut.sparkSession.sparkContext.broadcast(table)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        wide = np.int64(1) << 44  # more pieces of one length than there will ever be
        starts = table[:, 0] * wide + table[:, 1]
        for batch in batches:
            length, number = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "_number"))
            at = np.searchsorted(starts, length * wide + number - 1, side="right") - 1
            sequence = table[at, 3] + number - 1 - table[at, 1]
            columns = [batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(sequence), pa.array(table[at, 4])], names=[*names, "sequence_id", "offset"])

    names = cut.columns
    fields = ", ".join(f"`{n}` {t}" for n, t in cut.dtypes)
    return numbered.select(*names, "_number").mapInArrow(place, f"{fields}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, path: str, capacity: int = 2048, end_id: int = 0) -> DataFrame:
    return pack(pieces(docs, path, end_id, capacity), capacity)
