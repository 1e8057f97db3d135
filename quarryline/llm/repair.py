"""Token ids in a binary file format, compressed by Re-Pair grammars, with random access to every document.

The file format is a Parquet folder with one row per shard, in ascending document order (``part``, ``shard``):

| column | content |
| --- | --- |
| doc_ids, token_counts, symbol_counts | the shard's documents, how many ids each has, and how many grammar symbols |
| n_tokens | ids in the shard |
| rules | pairs of unsigned 16-bit symbols; rule number r defines symbol ``terminals + r`` |
| rule_lengths | unsigned 32-bit number of ids that each rule expands to |
| symbols | unsigned 16-bit symbols of all documents in a row |

A rule never spans two documents, so a document is decoded from its own symbols alone. Re-Pair runs in rounds: every
pair at least as frequent as the round's threshold becomes a rule, the more frequent pair wins where two overlap, and
the threshold falls from round to round until it is ``LEAST``. Rounds end when no pair stands in ``LEAST`` places, or when
symbols of 16 bits run out. Spark's committed Parquet write makes shards appear whole or not at all.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarryline.llm import bpe
from quarryline.llm.rows import slices, texts
from quarryline.session import shared_folder

SHARD_TOKENS = 1 << 20
LEAST = 16  # a pair that stands in fewer places of a shard gets no rule
FALL = 6  # the threshold falls by this factor from round to round
SYMBOLS = 1 << 16


def compress(ids: np.ndarray, last: np.ndarray, terminals: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(symbols, last, rules) of a sequence of ids below ``terminals``; ``last`` marks the last id of each document.

    At the lowest threshold a round looks only where a pair can still be frequent: pairs of old symbols get rarer, so it is
    places that the round before found frequent and left, and the neighbours of new symbols.
    """
    symbols, last, rules, known = ids.astype(np.uint32), last.copy(), [], terminals
    threshold, look = 0, None
    while known < SYMBOLS and len(symbols) > 1:
        if look is None:
            key = symbols[:-1] << np.uint32(16) | symbols[1:]
            inside, bucket = ~last[:-1], _bucket(key)
            # Exact counts only for pairs whose hash bucket is full enough; a bucket never counts too little.
            full = np.bincount(bucket[inside], minlength=1 << 20)
            threshold = max(LEAST, int(full.max()) // FALL if threshold == 0 else threshold // FALL)
            place = np.flatnonzero(inside & (full >= threshold)[bucket])
            key = key[place]
        else:
            place = np.flatnonzero(look[:-1] & ~last[:-1])
            key = symbols[place] << np.uint32(16) | symbols[place + 1]
        pairs, counts = np.unique(key, return_counts=True)
        pairs, counts = pairs[counts >= threshold], counts[counts >= threshold]
        best = np.argsort(-counts, kind="stable")[: SYMBOLS - known]
        if not len(best):
            if threshold == LEAST:
                break
            continue
        rank = np.full(len(pairs), SYMBOLS, np.int32)
        rank[best] = np.arange(len(best), dtype=np.int32)
        frequent = np.zeros(1 << 20, bool)
        frequent[_bucket(pairs)] = True
        may = frequent[_bucket(key)]
        place, key = place[may], key[may]
        at = np.minimum(np.searchsorted(pairs, key), len(pairs) - 1)
        real = pairs[at] == key
        place, mine = place[real], rank[at[real]]
        found = place
        place, mine = place[mine < SYMBOLS], mine[mine < SYMBOLS]
        over = np.full(len(symbols) + 1, SYMBOLS, np.int32)
        over[place] = mine
        wins = (mine <= over[place - 1]) & (mine <= over[place + 1])  # over[-1] is free
        place, mine = place[wins], mine[wins]
        # Equal pairs that overlap (one symbol repeated): every second one, from the left.
        start = np.maximum.accumulate(np.where(np.diff(place, prepend=-2) != 1, np.arange(len(place)), 0))
        even = (np.arange(len(place)) - start) % 2 == 0
        place, mine = place[even], mine[even]
        rules.append(np.stack([pairs[best] >> np.uint32(16), pairs[best] & np.uint32(0xFFFF)], axis=1))
        symbols[place] = known + mine
        last[place] = last[place + 1]
        keep = np.ones(len(symbols), bool)
        keep[place + 1] = False
        if threshold == LEAST:
            look, fresh = np.zeros((2, len(symbols)), bool)
            look[found] = fresh[place] = True
            look, fresh = (look | fresh)[keep], fresh[keep]
            look[:-1] |= fresh[1:]
        symbols, last, known = symbols[keep], last[keep], known + len(best)
    made = np.concatenate(rules) if rules else np.zeros((0, 2), np.uint32)
    return symbols.astype(np.uint16), last, made.astype(np.uint16)


def _bucket(pair: np.ndarray) -> np.ndarray:
    return (pair * np.uint32(0x9E3779B1)) >> np.uint32(12)


def expand(symbols: np.ndarray, rules: np.ndarray, terminals: int) -> np.ndarray:
    """The ids of symbols: what each rule expands to is laid out once, then every symbol copies its part."""
    size = np.ones(terminals + len(rules), np.int64)
    for number, (left, right) in enumerate(rules.tolist()):
        size[terminals + number] = size[left] + size[right]
    start = np.cumsum(size) - size
    flat = np.empty(int(size.sum()), np.uint16)
    flat[:terminals] = np.arange(terminals)
    for number, (left, right) in enumerate(rules.tolist()):
        s, a, b = start[terminals + number], size[left], size[right]
        flat[s : s + a] = flat[start[left] : start[left] + a]
        flat[s + a : s + a + b] = flat[start[right] : start[right] + b]
    length = size[symbols]
    ends = np.cumsum(length)
    within = np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - length, length)
    return flat[np.repeat(start[symbols], length) + within]


def write_ids(docs: DataFrame, path: str, folder: str, end_id: int = 2, shard_tokens: int = SHARD_TOKENS) -> None:
    """Encode (doc_id, text), end each document with ``end_id`` and write the shards to ``folder``.

    A null text is empty, so its document is the end id alone. Rows with a null doc_id come first; rows of equal
    doc_id are ordered by a hash of their text, so that no id, however frequent, has to fit into one task.
    """
    rows = texts(docs).withColumn("_hash", F.xxhash64("text"))
    order = ["doc_id", "_hash"]
    kind = rows.schema["doc_id"].dataType.simpleString()
    sorted_rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, part, shard = bpe.load(path), TaskContext.get().partitionId(), 0
        terminals = len(tokenizer.bytes_of)
        names: list[pa.Array] = []
        held: list[tuple[np.ndarray, np.ndarray]] = []  # ids, and how many each document has
        size = 0

        def flush() -> pa.RecordBatch:
            counts = np.concatenate([c for _, c in held]) + 1  # with the end id
            last = np.zeros(int(counts.sum()), bool)
            last[np.cumsum(counts) - 1] = True
            ids = np.full(len(last), end_id, np.uint16)
            ids[~last] = np.concatenate([x for x, _ in held])
            symbols, closed, rules = compress(ids, last, terminals)
            lengths = np.ones(terminals + len(rules), np.uint32)
            for number, (left, right) in enumerate(rules.tolist()):
                lengths[terminals + number] = lengths[left] + lengths[right]
            symbol_counts = np.diff(np.flatnonzero(closed), prepend=-1)
            doc_ids = pa.concat_arrays(names)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([part], pa.int32()),
                    pa.array([shard], pa.int32()),
                    pa.ListArray.from_arrays(pa.array([0, len(doc_ids)], pa.int32()), doc_ids),
                    pa.array([counts], pa.list_(pa.int64())),
                    pa.array([symbol_counts], pa.list_(pa.int64())),
                    pa.array([len(ids)], pa.int64()),
                    pa.array([terminals], pa.int32()),
                    pa.array([rules.tobytes()], pa.binary()),
                    pa.array([lengths[terminals:].astype("<u4").tobytes()], pa.binary()),
                    pa.array([symbols.tobytes()], pa.binary()),
                ],
                names=["part", "shard", "doc_ids", "token_counts", "symbol_counts", "n_tokens", "terminals", "rules", "rule_lengths", "symbols"],
            )

        for batch in slices(batches, "text", 2 * shard_tokens):
            held.append(tokenizer.encode_column(batch.column("text")))
            names.append(batch.column("doc_id"))
            size += len(held[-1][0]) + batch.num_rows
            if size >= shard_tokens:
                yield flush()
                names, held, size, shard = [], [], 0, shard + 1
        if held:
            yield flush()

    schema = (
        f"part int, shard int, doc_ids array<{kind}>, token_counts array<long>, symbol_counts array<long>, n_tokens long, "
        "terminals int, rules binary, rule_lengths binary, symbols binary"
    )
    sorted_rows.mapInArrow(work, schema).write.option("compression", "zstd").parquet(folder)


def read_ids(spark: SparkSession, folder: str, digest: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids): every document decoded from the shards; ``ids`` is binary, unsigned 32-bit.

    With ``digest`` only the crc32 of these bytes leaves the tasks, as ``ids_crc32``. An empty folder gives no rows.
    """
    shards = spark.read.parquet(folder)
    kind = shards.schema["doc_ids"].dataType.elementType.simpleString()
    out = ("ids_crc32", "long") if digest else ("ids", "binary")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "symbols"):
            for at in range(batch.num_rows):
                row = {n: batch.column(n)[at] for n in batch.schema.names}
                terminals = row["terminals"].as_py()
                rules = np.frombuffer(row["rules"].as_buffer(), "<u2").reshape(-1, 2)
                ids = expand(np.frombuffer(row["symbols"].as_buffer(), "<u2"), rules, terminals).astype("<u4")
                counts = row["token_counts"].values.to_numpy()
                bounds = np.concatenate([[0], np.cumsum(counts)])
                raw = ids.tobytes()
                each = [raw[4 * a : 4 * b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
                found = pa.array([zlib.crc32(x) for x in each], pa.int64()) if digest else pa.array(each, pa.binary())
                n = len(counts)
                yield pa.RecordBatch.from_arrays(
                    [
                        row["doc_ids"].values, pa.array(np.full(n, row["part"].as_py(), np.int32)),
                        pa.array(np.full(n, row["shard"].as_py(), np.int32)), pa.array(bounds[:-1], pa.int64()),
                        pa.array(counts, pa.int64()), found,
                    ],
                    names=["doc_id", "_part", "_shard", "_inside", "n_tokens", out[0]],
                )

    rows = shards.select("part", "shard", "doc_ids", "token_counts", "terminals", "rules", "symbols").mapInArrow(
        work, f"doc_id {kind}, _part int, _shard int, _inside long, n_tokens long, {out[0]} {out[1]}"
    )
    # Ids before each shard: sums inside a part, then over the parts, of which there are as many as writing tasks.
    sizes = shards.select(F.col("part").alias("_part"), F.col("shard").alias("_shard"), "n_tokens")
    before = lambda w: F.coalesce(F.sum("n_tokens").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    inside = sizes.withColumn("_base", before(Window.partitionBy("_part").orderBy("_shard"))).drop("n_tokens")
    parts = sizes.groupBy("_part").agg(F.sum("n_tokens").alias("n_tokens"))
    parts = parts.select("_part", before(Window.orderBy("_part")).alias("_part_base"))
    bases = inside.join(parts, "_part").select("_part", "_shard", (F.col("_base") + F.col("_part_base")).alias("_base"))
    placed = rows.join(bases, ["_part", "_shard"])
    return placed.select("doc_id", (F.col("_base") + F.col("_inside")).alias("start"), "n_tokens", out[0])


def decode_document(row, number: int, first: int = 0, n: int | None = None) -> np.ndarray:
    """Random access: ids ``first`` to ``first + n`` (default: to the end) of document ``number`` of a shard row.

    The stored lengths say which symbols reach into the range; only these are expanded, level by level, so no rule is
    read that the range does not need.
    """
    at, terminals = sum(row["symbol_counts"][:number]), row["terminals"]
    symbols = np.frombuffer(row["symbols"], "<u2")[at : at + row["symbol_counts"][number]].astype(np.int64)
    rules = np.frombuffer(row["rules"], "<u2").reshape(-1, 2)
    rule_lengths = np.frombuffer(row["rule_lengths"], "<u4")

    def lengths(symbols: np.ndarray) -> np.ndarray:
        out = np.ones(len(symbols), np.int64)
        rule = symbols >= terminals
        out[rule] = rule_lengths[symbols[rule] - terminals]
        return out

    size = lengths(symbols)
    start = np.cumsum(size) - size
    stop = int(size.sum()) if n is None else first + n
    while True:
        reach = (start < stop) & (start + size > first)
        symbols, start = symbols[reach], start[reach]
        rule = symbols >= terminals
        if not rule.any():
            return symbols.astype(np.uint16)
        left, right = rules[symbols[rule] - terminals].T.astype(np.int64)
        slot = np.cumsum(1 + rule) - 1  # where the symbol, or the right half of its rule, goes
        wide_symbols, wide_start = np.empty(len(symbols) + len(left), np.int64), np.empty(len(symbols) + len(left), np.int64)
        wide_symbols[slot], wide_start[slot] = symbols, start
        wide_symbols[slot[rule]], wide_start[slot[rule]] = right, start[rule] + lengths(left)
        wide_symbols[slot[rule] - 1], wide_start[slot[rule] - 1] = left, start[rule]
        symbols, start = wide_symbols, wide_start
        size = lengths(symbols)


def round_trip(docs: DataFrame, path: str, end_id: int = 2) -> DataFrame:
    """Write the ids of all documents to a folder of their own and read them back: (doc_id, start, n_tokens, ids_crc32)."""
    folder = shared_folder(docs.sparkSession)
    write_ids(docs, path, folder, end_id)
    return read_ids(docs.sparkSession, folder, digest=True)
