"""Embedding near-duplicates by spherical-cap filters.

A filter is a direction; a vector passes where their inner product reaches ``CAP``. The directions are structured: after a
pseudo-random rotation a vector is cut into two halves, each half has its own random codebook, and every pair of code words
is a direction. A vector is list-decoded to all directions it passes: a half whose best partner cannot lift it to the
cap is left out at once. There are ``ROTATIONS`` such codes. Vectors of one label that pass a common filter are candidates
and are verified by their cosine in double precision, in tiles (see ``links``).

The defaults (268 million filters, for 64 dimensions about 54 passed by a vector) find a pair at the threshold with a
probability above 0.98 (tests measure recall against brute force), and unrelated vectors hardly ever meet. Inner products
grow as vectors get narrower and shrink as they get wider: for every width but ``CAP_WIDTH`` the cap is derived, so that random
vectors pass ``PASSED`` filters on average (``PASSED_NARROW`` below that width, where close pairs share more of them). In few dimensions so many filters
lie so densely that their caps would be smaller than the angle sought: code words are halved until the cap is ``CAP_MOST``. A vector that passes none is compared with all vectors of its label and width,
block by block.

Vectors that are null, empty, zero or hold null or non-finite components, and rows without a label or id, are linked to
nothing. Vectors of different widths never link. Equal vectors of one label are one item with copies.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarryline.llm.links import link
from quarryline.session import stage

THRESHOLD = 0.93
CODE_WORDS, ROTATIONS, CAP = 4096, 16, 0.58
CAP_WIDTH = 64  # CAP is for vectors of this width
PASSED = 150  # filters that a wider vector passes on average: with fewer, recall falls below that of 64 dimensions
PASSED_NARROW = 60  # the same for narrower ones
CAP_MOST = 0.85  # a cap above is too small for both vectors of a pair: there are fewer code words then
BLOCK_BYTES = 32 << 20  # of vectors without filters that a task holds at once


def _words(drawn: np.ndarray) -> np.ndarray:
    """Unit code words; in one dimension there are only two."""
    words = drawn / np.maximum(np.linalg.norm(drawn, axis=1, keepdims=True), 1e-12)
    return np.unique(words, axis=0) if words.shape[1] == 1 else words


class Code:
    """The filters for vectors of one width."""

    def __init__(self, width: int, words: int, rotations: int) -> None:
        rng = np.random.default_rng(width)
        self.turn, self.books = [], []
        for _ in range(rotations):
            self.turn.append(np.linalg.qr(rng.normal(size=(width, width)))[0].astype(np.float32))
            halves = [rng.normal(size=(words, len(h))) for h in np.array_split(np.arange(width), 2)]
            self.books.append([(_words(h) / np.sqrt(2)).astype(np.float32).T for h in halves])

    def usual_cap(self) -> float:
        """The cap that random vectors of this width reach for ``PASSED`` or ``PASSED_NARROW`` filters on average."""
        turn, (left, right) = self.turn[0], self.books[0]
        if len(turn) == CAP_WIDTH:
            return CAP
        wanted = PASSED if len(turn) > CAP_WIDTH else PASSED_NARROW
        turned = _unit(np.random.default_rng(1).normal(size=(256, len(turn)))).astype(np.float32) @ turn
        a, b = turned[:, : left.shape[0]] @ left, np.sort(turned[:, left.shape[0] :] @ right, axis=1)
        low, high = 0.0, 1.0
        for _ in range(20):
            cap = (low + high) / 2
            n = np.mean([b.shape[1] * len(x) - np.searchsorted(y, cap - x).sum() for x, y in zip(a, b)]) * len(self.turn)
            low, high = (cap, high) if n > wanted else (low, cap)
        return low

    def passed(self, unit: np.ndarray, cap: float) -> list[list[int]]:
        """Numbers of the filters that each unit vector passes."""
        out: list[list[int]] = [[] for _ in unit]
        for number, (turn, (left, right)) in enumerate(zip(self.turn, self.books)):
            turned = unit.astype(np.float32) @ turn
            a, b = turned[:, : left.shape[0]] @ left, turned[:, left.shape[0] :] @ right
            best = b.max(axis=1) if b.shape[1] else np.zeros(len(b))
            for k in range(len(unit)):
                x = np.flatnonzero(a[k] >= cap - best[k])
                if not len(x):
                    continue
                y = np.flatnonzero(b[k] >= cap - a[k, x].max())
                i, j = np.nonzero(a[k, x][:, None] + b[k, y][None, :] >= cap)
                out[k] += ((number * a.shape[1] + x[i]) * b.shape[1] + y[j]).tolist()
        return out


@lru_cache(maxsize=8)
def code_of(width: int, words: int = CODE_WORDS, rotations: int = ROTATIONS) -> tuple[Code, float]:
    """The filters for vectors of one width and their cap, made once per worker process."""
    code = Code(width, words, rotations)
    cap = code.usual_cap()
    while cap > CAP_MOST and words > 2:
        words //= 2
        code = Code(width, words, rotations)
        cap = code.usual_cap()
    return code, cap


def _unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def _without_filters(reps: DataFrame, threshold: float) -> DataFrame:
    """``reps``, where each vector without keys has one of its own, which all vectors close to it get as well."""
    alone = reps.where(F.size("keys") == 0).select(F.xxhash64(F.lit("alone"), "rep").alias("key"), "side", "raw")

    def extended(reps: DataFrame, block: list) -> DataFrame:
        sent = reps.sparkSession.sparkContext.broadcast(block)

        def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sides: dict[tuple[int, int], tuple[list, list]] = {}
            for key, side, raw in sent.value:
                keys, raws = sides.setdefault((side, len(raw)), ([], []))
                keys.append(key)
                raws.append(raw)
            ready = {s: (keys, _unit(np.frombuffer(b"".join(raws), np.float64).reshape(len(raws), -1))) for s, (keys, raws) in sides.items()}
            for whole in batches:
                for start in range(0, whole.num_rows, 256):
                    batch = whole.slice(start, 256)
                    columns = batch.to_pydict()
                    found = columns["keys"]
                    at: dict[tuple[int, int], list[int]] = {}
                    for k, (side, raw) in enumerate(zip(columns["side"], columns["raw"])):
                        if (side, len(raw)) in ready:
                            at.setdefault((side, len(raw)), []).append(k)
                    for s, here in at.items():
                        keys, theirs = ready[s]
                        mine = _unit(np.frombuffer(b"".join(columns["raw"][k] for k in here), np.float64).reshape(len(here), -1))
                        for i, j in zip(*np.nonzero(mine @ theirs.T >= threshold - 1e-9)):
                            found[here[i]].append(keys[j])
                    yield batch.set_column(batch.schema.get_field_index("keys"), "keys", pa.array(found, pa.list_(pa.int64())))

        out = stage(reps.mapInArrow(compare, reps.schema))
        sent.unpersist()
        return out

    block: list[tuple[int, int, bytes]] = []
    size = 0
    for r in alone.toLocalIterator():
        block.append((r.key, r.side, bytes(r.raw)))
        size += len(r.raw)
        if size >= BLOCK_BYTES:
            reps, block, size = extended(reps, block), [], 0
    return extended(reps, block) if block else reps


def near_duplicates(
    vectors: DataFrame, threshold: float = THRESHOLD, words: int = CODE_WORDS, rotations: int = ROTATIONS, cap: float | None = None
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of ``vectors`` (vec_id, embedding, label).

    ``component_id`` is the smallest vec_id reachable by links, ``n_links`` the number of other rows linked directly.
    Without ``cap`` each width has its own (``code_of``).
    """
    rows = vectors.select("vec_id", F.col("label"), F.transform("embedding", lambda x: x.cast("double")).alias("v"))
    fit = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    usable = F.coalesce(fit & F.col("label").isNotNull() & F.col("vec_id").isNotNull(), F.lit(False))
    rows = rows.withColumn("rep", F.when(usable, F.xxhash64("label", "v")))
    items = rows.where(F.col("rep").isNotNull()).groupBy("rep").agg(
        F.count("*").alias("copies"), F.min("vec_id").alias("least"), F.first("label").alias("label"), F.first("v").alias("v")
    )

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes: dict[int, tuple[Code, float]] = {}
        for whole in batches:
            for start in range(0, whole.num_rows, 512):
                batch = whole.slice(start, 512)
                vectors = [np.array(v) for v in batch.column("v").to_pylist()]
                widths = np.array([len(v) for v in vectors])
                found: list[list[int]] = [[] for _ in vectors]
                for width in np.unique(widths).tolist():
                    here = np.flatnonzero(widths == width)
                    if width not in codes:
                        codes[width] = code_of(width, words, rotations) if cap is None else (Code(width, words, rotations), cap)
                    code, least = codes[width]
                    for k, numbers in zip(here.tolist(), code.passed(_unit(np.stack([vectors[k] for k in here])), least)):
                        found[k] = numbers
                columns = [batch.column(c) for c in ("rep", "copies", "least", "label")]
                raw = pa.array([v.tobytes() for v in vectors], pa.binary())
                yield pa.RecordBatch.from_arrays([*columns, raw, pa.array(found, pa.list_(pa.int64()))], names=["rep", "copies", "least", "label", "raw", "filters"])

    kinds = dict(items.dtypes)
    reps = stage(items.mapInArrow(decode, f"rep long, copies long, least {kinds['least']}, label {kinds['label']}, raw binary, filters array<long>"))
    keys = F.transform("filters", lambda f: F.xxhash64(f, F.col("label"), F.length("raw")))
    reps = _without_filters(reps.select("rep", "copies", "least", "raw", keys.alias("keys"), F.xxhash64("label", F.length("raw")).alias("side")), threshold)

    def close(left: list[bytes], right: list[bytes]) -> np.ndarray:
        size = len(left[0])
        if any(len(x) != size for x in left + right):
            out = np.zeros((len(left), len(right)), bool)
            for i, a in enumerate(left):
                for j, b in enumerate(right):
                    out[i, j] = len(a) == len(b) and close([a], [b])[0, 0]
            return out
        x, y = (_unit(np.frombuffer(b"".join(s), np.float64).reshape(len(s), -1)) for s in (left, right))
        return x @ y.T >= threshold

    linked = stage(link(reps.select("rep", "copies", "keys", F.col("raw").alias("payload")), lambda work: work, close))
    everyone = reps.select("rep", "copies", "least").join(linked, "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    first = everyone.groupBy("component").agg(F.min("least").alias("component_id"))
    known = everyone.join(first, "component").select("rep", (F.col("copies") - 1 + F.coalesce("n_links", F.lit(0))).alias("n_links"), "component_id")
    out = rows.select("vec_id", "rep").join(known, "rep", "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), component.alias("component_id"), (F.col("vec_id") == component).alias("kept"))
