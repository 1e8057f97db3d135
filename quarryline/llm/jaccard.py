"""Near-duplicate texts: an n-gram Jaccard join by a MinHash LSH forest.

Words are runs of letters and digits, lower-cased; a shingle is five words in a row (a text of one to four words is one
shingle). Texts with equal shingle sets are one item. The forest has ``TREES`` trees; a tree is the sorted prefix trie of
its own MinHash signature. Two texts are candidates where they share a prefix in any tree. The prefix starts at
``DEEPEST`` values and is shortened until a pair at the threshold is found with the target recall. Candidates are
verified exactly on their shingle sets (64-bit hashes), in tiles (see ``links``).

A null text is empty. A text without words has no shingle and is linked to nothing. Rows are numbered and
staged once, so repeated and null ids do no harm, and a lost executor cannot change which row is which.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarryline.llm.links import link
from quarryline.llm.rows import free_name, slices
from quarryline.session import stage

SIZE, THRESHOLD = 5, 0.8
TREES, DEEPEST, RECALL = 25, 8, 0.9995
_WORD = regex.compile(r"[\p{L}\p{N}]+")
_U64 = np.uint64


def prefix_length(trees: int = TREES, deepest: int = DEEPEST, recall: float = RECALL, threshold: float = THRESHOLD) -> int:
    """The longest prefix at which a pair at the threshold shares one in some tree with probability ``recall``."""
    depth = deepest
    while depth > 1 and 1 - (1 - threshold**depth) ** trees < recall:
        depth -= 1
    return depth


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U64(30))) * _U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U64(27))) * _U64(0x94D049BB133111EB)
    return x ^ (x >> _U64(31))


def _tables(depth: int, trees: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Random numbers: of (place, byte) in a word, of a word's place in a shingle, and the hash functions of signatures."""
    rng = np.random.default_rng(7)
    of_byte = rng.integers(0, 1 << 63, (64, 256), dtype=np.uint64)
    of_place = rng.integers(0, 1 << 63, SIZE, dtype=np.uint64) | _U64(1)
    factor = rng.integers(0, 1 << 32, depth * trees, dtype=np.uint32) | np.uint32(1)
    return of_byte, of_place, factor, rng.integers(0, 1 << 32, depth * trees, dtype=np.uint32)


def shingle_hashes(batch: list[str], of_byte: np.ndarray, of_place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles of all texts in a row (with repeats), and how many each text has."""
    found = [_WORD.findall(t.lower()) for t in batch]
    counts = np.fromiter(map(len, found), np.int64, len(found))
    words = [w for words in found for w in words]
    if not words:
        return np.zeros(0, np.uint64), np.zeros(len(batch), np.int64)
    raw = "\n".join(words).encode()
    flat = np.frombuffer(raw, np.uint8)
    ends = np.append(np.flatnonzero(flat == 10), len(flat))
    starts = np.concatenate([[0], ends[:-1] + 1])
    within = np.arange(len(flat)) - np.repeat(starts, np.diff(np.append(starts, len(flat))))
    values = of_byte[within % 64, flat]
    far = np.flatnonzero(within >= 64)  # the table starts again, so each round has a factor of its own
    values[far] *= _mixed((within[far] >> 6).astype(np.uint64)) | _U64(1)
    values[ends[:-1]] = 0
    hashed = _mixed(np.add.reduceat(values, starts))
    wide = np.concatenate([hashed, np.zeros(SIZE, np.uint64)])
    owner = np.repeat(np.arange(len(batch)), counts)
    place = np.arange(len(words)) - np.repeat(np.cumsum(counts) - counts, counts)
    left = np.repeat(counts, counts) - place  # words from here to the end of the text
    total = np.zeros(len(words), np.uint64)
    for k in range(SIZE):
        total += np.where(left > k, wide[k : k + len(words)] * of_place[k], _U64(k + 1))
    keep = (left >= SIZE) | (place == 0)
    return _mixed(total[keep]), np.bincount(owner[keep], minlength=len(batch))


def _signed(docs: DataFrame, trees: int, depth: int) -> DataFrame:
    """(row, doc_id, rep, keys): a hash of the shingle set, and the trie prefixes of all trees; null without words."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_byte, of_place, factor, shift = _tables(depth, trees)
        mark = _U64(0x9E3779B97F4A7C15)
        for batch in slices(batches, "text"):
            hashes, counts = shingle_hashes(batch.column("text").to_pylist(), of_byte, of_place)
            filled = np.flatnonzero(counts)
            starts = (np.cumsum(counts) - counts)[filled]
            short = (hashes >> _U64(32)).astype(np.uint32)
            keys = np.zeros((trees, len(filled)), np.uint64)
            for tree in range(trees):
                for level in range(depth):
                    at = tree * depth + level
                    least = np.minimum.reduceat(short * factor[at] + shift[at], starts) if len(filled) else np.zeros(0, np.uint32)
                    keys[tree] = _mixed((keys[tree] + least) * mark + _U64(tree + 1))
            reps: list[int | None] = [None] * len(counts)
            lists: list[np.ndarray | None] = [None] * len(counts)
            signed = keys.T.astype(np.int64)
            for k, (at, start) in enumerate(zip(filled.tolist(), starts.tolist())):
                whole = np.unique(hashes[start : start + counts[at]])
                reps[at] = int.from_bytes(hashlib.blake2b(whole.tobytes(), digest_size=8).digest(), "little", signed=True)
                lists[at] = signed[k]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("doc_id"), pa.array(reps, pa.int64()), pa.array(lists, pa.list_(pa.int64()))],
                names=["row", "doc_id", "rep", "keys"],
            )

    return docs.mapInArrow(work, f"row long, doc_id {kind}, rep long, keys array<long>")


def _sets(rows: DataFrame) -> DataFrame:
    """Replaces ``text`` by ``payload``: the sorted different shingle hashes."""
    names = [c for c in rows.columns if c != "text"]
    fields = ", ".join(f"{n} {t}" for n, t in rows.dtypes if n != "text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_byte, of_place, _, _ = _tables(1, 1)
        for batch in slices(batches, "text"):
            hashes, counts = shingle_hashes(batch.column("text").to_pylist(), of_byte, of_place)
            parts = np.split(hashes, np.cumsum(counts)[:-1])
            payload = pa.array([np.unique(p).tobytes() for p in parts], pa.binary())
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), payload], names=[*names, "payload"])

    return rows.select(*names, "text").mapInArrow(work, f"{fields}, payload binary")


def similar(left: list[bytes], right: list[bytes]) -> np.ndarray:
    """Which sets of two lists have a Jaccard similarity of 0.8 or more, decided in whole numbers."""
    own = left is right or left == right
    sets = [np.frombuffer(x, np.uint64) for x in (left if own else left + right)]
    size = np.array([len(s) for s in sets])
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), size)
    values, at, often = np.unique(flat, return_inverse=True, return_counts=True)
    common = often[at] > 1
    column = (np.cumsum(often > 1) - 1)[at[common]]
    owner = owner[common]
    n, a = len(sets), len(left)
    inner = np.zeros((a, len(left) if own else n - a))
    width = max(1, (16 << 20) // (4 * n))
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    for start in range(0, int((often > 1).sum()), width):
        lo, hi = np.searchsorted(column, [start, start + width])
        dense = np.zeros((n, min(width, int(column[hi - 1]) - start + 1) if hi > lo else 1), np.float32)
        dense[owner[lo:hi], column[lo:hi] - start] = 1
        inner += dense[:a] @ (dense if own else dense[a:]).T
    sizes = size[:a, None] + (size if own else size[a:])[None, :]
    return np.round(inner).astype(np.int64) * 9 >= sizes * 4


def join(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", trees: int = TREES, recall: float = RECALL, row_col: str | None = None
) -> DataFrame:
    """(row, doc_id, class_id, n_links, kept): one row per row of ``docs``.

    ``class_id`` is the smallest id of the component of links (of the row itself, where it has none), ``n_links`` counts the
    other rows linked directly, ``kept`` marks one row of each component: the smallest id that is not null, then the
    first row. ``row`` is a number given to the rows of ``docs``, or their ``row_col`` (long, unique, in a stored table).
    """
    row = F.monotonically_increasing_id() if row_col is None else F.col(row_col)
    placed = docs.select(row.alias("row"), F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    if row_col is None:
        placed = stage(placed)
    signed = stage(_signed(placed, trees, prefix_length(trees, recall=recall)))
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")
    with_words = signed.where(F.col("rep").isNotNull())
    reps = stage(with_words.groupBy("rep").agg(F.count("*").alias("copies"), F.min(place).alias("best"), F.first("keys").alias("keys")))

    def payload(work: DataFrame) -> DataFrame:
        return _sets(work.join(placed.select("row", "text"), "row").drop("row"))

    linked = stage(link(reps.select("rep", "copies", "keys", "best.row"), payload, similar))
    everyone = reps.select("rep", "copies", "best").join(linked, "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    best = everyone.groupBy("component").agg(F.min("best").alias("first"))
    known = everyone.join(best, "component").select("rep", "copies", F.coalesce("n_links", F.lit(0)).alias("links"), "first")
    rows = signed.select("row", "doc_id", "rep").join(known, "rep", "left")
    return rows.select(
        "row", "doc_id",
        F.when(F.col("rep").isNull(), F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("class_id"),
        F.coalesce(F.col("copies") - 1 + F.col("links"), F.lit(0)).alias("n_links"),
        (F.col("rep").isNull() | (F.col("row") == F.col("first.row"))).alias("kept"),
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows that ``join`` does not keep."""
    name = free_name(docs, "_row")
    numbered = stage(docs.withColumn(name, F.monotonically_increasing_id()))
    kept = join(numbered, row_col=name).where("kept").select(F.col("row").alias(name))
    return numbered.join(kept, name, "left_semi").drop(name)
