"""Periodic runs of words, found by tiles of doubling scale.

A run is a stretch of consecutive words in which words ``q`` apart are identical (``q`` the smallest such period), that holds
at least ``REPEATS`` periods and ``SHORTEST`` words, and that no neighbouring word extends.

Periods are searched by octave, ``P <= q < 2P``. Boundaries stand every ``2P`` words; a run has so many periods that the ``P``
words after one of its boundaries come again ``q`` words later. Names of all windows of ``P`` words (doubled from those of the
octave before) show that, and from such a boundary Z-values, the lengths of the common extension of two places to the right
and to the left, are found by halving. Each boundary sees only its tile of ``8P`` words, so it yields a fragment of a run,
clipped to the tile: tiles need nothing of each other. Fragments are shuffled by document and period and stitched
where they overlap.

Where a document is short, its tiles are solved in the task that reads it, all documents of a batch at once. The tiles of a
document above ``LONG`` bytes become rows, spread over tasks. Documents without any fragment, which most are, are
finished in the first pass; only the others' texts are read again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarryline.llm.mixing import WORD
from quarryline.llm.rows import slices, texts
from quarryline.session import stage

REPEATS, SHORTEST = 4, 6
LONG = 1 << 20  # bytes of text beyond which a document's tiles are spread
_ROW = 1 << 15  # words that a row of spread tiles holds at least
_CELLS = 1 << 21  # window names compared at a time
_FRAGMENT = "array<struct<period:long,first:long,last:long>>"


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A 64-bit name of the pair; what it finds is compared word by word later."""
    x = a * np.uint64(0x9E3779B97F4A7C15) ^ (b + np.uint64(0x632BE59BD9B4E019)) * np.uint64(0xC2B2AE3D27D4EB4F)
    return x ^ (x >> np.uint64(29))


def _smallest_factors(n: int) -> np.ndarray:
    """Smallest prime factor of every number up to ``n``."""
    out = np.arange(n + 1)
    for p in range(2, int(n**0.5) + 1):
        if out[p] == p:
            rest = out[p * p :: p]
            rest[rest == np.arange(p * p, n + 1, p)] = p
    return out


class Names:
    """Names of the windows of 1, 2, 4, ... words at every place of ``words``."""

    def __init__(self, words: np.ndarray) -> None:
        self.words = words
        self.levels = [_mix(words.astype(np.uint64), np.zeros(len(words), np.uint64))]

    def double(self) -> None:
        size = 1 << (len(self.levels) - 1)
        last = self.levels[-1]
        self.levels.append(_mix(last[:-size], last[size:]) if len(last) > size else last[:0])

    def ahead(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """How many words from ``a`` and from ``b`` on are equal, up to ``most``."""
        return self._common(a, b, most, 1)

    def back(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """How many words before ``a`` and before ``b`` are equal, up to ``most``."""
        return self._common(a, b, most, -1)

    def _common(self, a: np.ndarray, b: np.ndarray, most: np.ndarray, way: int) -> np.ndarray:
        # The longest windows may match several times in a row, each shorter one once.
        done = np.zeros(len(a), np.int64)
        for level in range(len(self.levels) - 1, -1, -1):
            size, names = 1 << level, self.levels[level]
            active = np.flatnonzero(done + size <= most)
            while len(active):
                x, y = a[active] + way * done[active], b[active] + way * done[active]
                if way < 0:
                    x, y = x - size, y - size
                active = active[names[x] == names[y]]
                done[active] += size
                if level < len(self.levels) - 1:
                    break
                active = active[done[active] + size <= most[active]]
        return done


def _solve(names: Names, octave: int, at: np.ndarray, low: np.ndarray, high: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """Fragments (boundary number, period, first, last) around boundaries ``at``, whose documents stand at ``low`` to ``high``.

    ``names`` must hold the windows of ``octave`` words. A fragment is the stretch from ``first`` up to ``last`` in which
    words a period apart are equal, clipped to the tile; whole runs that are too short are left out.
    """
    window, offsets = names.levels[octave.bit_length() - 1], np.arange(octave, 2 * octave)
    out = []
    inside = np.flatnonzero(at + 2 * octave <= high)  # from the others on no window comes again
    at, low, high = at[inside], low[inside], high[inside]
    step = max(_CELLS // octave, 1)
    for start in range(0, len(at), step):
        here = at[start : start + step]
        there = here[:, None] + offsets
        fits = (there + octave <= high[start : start + step, None]) & (REPEATS * offsets <= (high - low)[start : start + step, None])
        there[~fits] = here[0]
        number, q = np.nonzero((window[there] == window[here][:, None]) & fits)
        if not len(number):
            continue
        c, q, number = here[number], q + octave, number + start
        first_word, end_word = np.maximum(low[number], c - 2 * octave), np.minimum(high[number], c + 6 * octave)
        first = c - names.back(c, c + q, c - first_word)
        last = c + names.ahead(c, c + q, end_word - q - c)
        # Whole runs (both ends seen, or those of the document) that are too short.
        open_left = (first == first_word) & (first_word > low[number])
        open_right = (last + q == end_word) & (end_word < high[number])
        keep = open_left | open_right | (last + q - first >= np.maximum(REPEATS * q, SHORTEST))
        number, q, first, last = number[keep], q[keep], first[keep], last[keep]
        # Two periods that also repeat at a part of the period make the whole run do so: it is found with that part.
        simple, rest = np.ones(len(q), bool), np.where(last - first >= q, q, 1)
        while (rest > 1).any():
            prime = factors[rest]
            part = q // np.maximum(prime, 1)
            test = np.flatnonzero(rest > 1)
            length = last[test] + q[test] - first[test] - part[test]
            simple[test] &= names.ahead(first[test], first[test] + part[test], length) < length
            rest = np.where(rest > 1, rest // np.maximum(prime, 1), 1)
        out.append(np.stack([inside[number], q, first, last], axis=1)[simple])
    return np.concatenate(out) if out else np.zeros((0, 4), np.int64)


def _exact(words: np.ndarray, found: np.ndarray) -> bool:
    """Whether the words really agree where their names do."""
    return all(np.array_equal(words[first:last], words[first + q : last + q]) for _, q, first, last in found.tolist())


def _checked(words: np.ndarray, solve) -> np.ndarray:
    """Fragments by names, or, should two names ever collide, by names that are told apart by sorting."""
    found = solve(Names(words))
    return found if _exact(words, found) else solve(_ExactNames(words))


class _ExactNames(Names):
    """Names without collisions: the rank of each pair of halves."""

    def __init__(self, words: np.ndarray) -> None:
        self.words, self.levels = words, [np.unique(words, return_inverse=True)[1].astype(np.int64)]

    def double(self) -> None:
        size, last = 1 << (len(self.levels) - 1), self.levels[-1]
        if len(last) <= size:
            self.levels.append(last[:0])
            return
        pairs = last[:-size] * np.int64(last.max() + 1) + last[size:]
        self.levels.append(np.unique(pairs, return_inverse=True)[1].astype(np.int64))


def fragments(words: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Fragments (document, period, first, last) of documents that stand one after the other in ``words``; the places
    are those inside the document."""
    longest = int((high - low).max(initial=0))
    factors = _smallest_factors(max(longest // 2, 2))

    def solve(names: Names) -> np.ndarray:
        out, octave = [], 1
        while octave * REPEATS <= longest:
            docs = np.flatnonzero(high - low >= REPEATS * octave)
            count = -(-(high[docs] - low[docs]) // (2 * octave))
            of = np.repeat(docs, count)
            nth = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
            found = _solve(names, octave, low[of] + nth * 2 * octave, low[of], high[of], factors)
            found[:, 0] = of[found[:, 0]]
            out.append(found)
            octave *= 2
            names.double()
        return np.concatenate(out) if out else np.zeros((0, 4), np.int64)

    found = _checked(words, solve)
    shift = low[found[:, 0]]
    found[:, 2] -= shift
    found[:, 3] -= shift
    return found


def _coded(lists: Iterable[list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Equal words get equal numbers; documents one after the other, with where each starts and ends."""
    lists = list(lists)
    sizes = np.array([len(x) for x in lists], np.int64)
    flat = pa.array([w for x in lists for w in x], pa.binary())
    codes = flat.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    high = np.cumsum(sizes)
    return codes, high - sizes, high


def split_words(text: str) -> list[bytes]:
    """The stretches without a space, tab, line feed, vertical tab, form feed or carriage return."""
    return text.encode("utf-8", "surrogatepass").split()


def _sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def _lists(fields: list[list[tuple[int, int, int]]]) -> pa.Array:
    rows = [[{"period": q, "first": a, "last": b} for q, a, b in one] for one in fields]
    return pa.array(rows, pa.list_(pa.struct([("period", pa.int64()), ("first", pa.int64()), ("last", pa.int64())])))


def _first_pass(long: int):
    """(_row, doc_id, text, all_sha256, long, fragments): a document without a fragment keeps no text, and its digest is final."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            rows = batch.column("text").to_pylist()
            spread = [len(t.encode("utf-8", "surrogatepass")) > long for t in rows]
            lists = [[] if apart else split_words(t) for t, apart in zip(rows, spread)]
            found = fragments(*_coded(lists))
            of: dict[int, list[tuple[int, int, int]]] = {}
            for document, *place in found.tolist():
                of.setdefault(document, []).append(tuple(place))
            again = [apart or i in of for i, apart in enumerate(spread)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_row"), batch.column("doc_id"), pa.array([t if a else None for t, a in zip(rows, again)], pa.string()),
                    pa.array([None if a else _sha(b" ".join(x)) for x, a in zip(lists, again)], pa.string()), pa.array(spread, pa.bool_()),
                    _lists([of.get(i, []) for i in range(len(lists))]),
                ],
                names=["_row", "doc_id", "text", "all_sha256", "long", "fragments"],
            )

    return work


def _tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(_row, octave, n, first boundary, boundaries, words): tiles of one scale and neighbouring boundaries share a row."""
    names = ["_row", "octave", "n", "start", "boundary", "boundaries", "words"]
    for batch in slices(batches, "text"):
        for row, text in zip(batch.column("_row").to_pylist(), batch.column("text").to_pylist()):
            words, _, high = _coded([split_words(text)])
            n, octave = int(high[0]), 1
            while octave * REPEATS <= n:
                each = max(_ROW // (2 * octave), 1)
                for boundary in range(0, n, 2 * octave * each):
                    count = min(each, -(-(n - boundary) // (2 * octave)))
                    start, end = max(boundary - 2 * octave, 0), min(boundary + 2 * octave * (count - 1) + 6 * octave, n)
                    one = [[row], [octave], [n], [start], [boundary], [count]]
                    yield pa.RecordBatch.from_arrays(
                        [*[pa.array(x, pa.int64()) for x in one], pa.array([words[start:end]], pa.list_(pa.int64()))], names=names
                    )
                octave *= 2


def _solve_tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for r in range(batch.num_rows):
            row, octave, n, start, boundary, count = (batch.column(i)[r].as_py() for i in range(6))
            words = batch.column(6)[r].values.to_numpy(zero_copy_only=False)
            at = boundary - start + 2 * octave * np.arange(count)
            low, high = np.full(count, -start), np.full(count, n - start)
            factors = _smallest_factors(2 * octave)

            def solve(names: Names) -> np.ndarray:
                for _ in range(octave.bit_length() - 1):
                    names.double()
                # The tile ends inside the row, or where the document does.
                return _solve(names, octave, at, low, high, factors)

            found = _checked(words, solve)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(found), row), pa.int64()), pa.array(found[:, 1], pa.int64()),
                    pa.array(found[:, 2] + start, pa.int64()), pa.array(found[:, 3] + start, pa.int64()),
                ],
                names=["_row", "period", "first", "last"],
            )


def stitch(pieces: DataFrame) -> DataFrame:
    """Runs (_row, start, length, period) from fragments (_row, period, first, last).

    Fragments of a document and period that overlap or touch are one stretch; a stretch that also has a smaller period is
    the run of that one. A window holds the fragments of one document and period.
    """
    by = Window.partitionBy("_row", "period").orderBy("first", "last")
    so_far = F.max("last").over(by.rowsBetween(Window.unboundedPreceding, -1))
    starts = F.coalesce(F.col("first") > so_far, F.lit(True)).cast("int")
    island = F.sum("_starts").over(by.rowsBetween(Window.unboundedPreceding, 0))
    marked = pieces.withColumn("_starts", starts).withColumn("_island", island)
    whole = marked.groupBy("_row", "period", "_island").agg(F.min("first").alias("start"), F.max("last").alias("last"))
    length = F.col("last") + F.col("period") - F.col("start")
    runs = whole.select("_row", "period", "start", length.alias("length")).where(
        F.col("length") >= F.greatest(F.lit(REPEATS) * F.col("period"), F.lit(SHORTEST))
    )
    return runs.groupBy("_row", "start", "length").agg(F.min("period").alias("period"))


_COLUMNS = "n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"


def _collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that no run contains after its first period."""
    dropped = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        dropped[start + period] += 1
        dropped[start + length] -= 1
    return b" ".join(w for w, d in zip(words, np.cumsum(dropped).tolist()) if not d)


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        out = []
        for text, runs in zip(batch.column("text").to_pylist(), batch.column("runs").to_pylist()):
            runs = sorted((r["start"], r["length"], r["period"]) for r in runs or [])
            runs.sort(key=lambda r: (r[0], r[2]))
            # Double division keeps equal ratios equal and, far below 2 ** 25 words, different ones apart.
            best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
            listed = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
            out.append(
                (len(runs), *(best or (None, None, None)), 1000 * best[1] // best[2] if best else None,
                 _sha(listed.encode()), _sha(_collapse(split_words(text), runs)))
            )
        kinds = [pa.int64()] * 5 + [pa.string()] * 2
        columns = [pa.array([r[i] for r in out], kind) for i, kind in enumerate(kinds)]
        names = ["n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names=["doc_id", *names])


def periodic_runs(docs: DataFrame, long: int = LONG) -> DataFrame:
    """Per document: doc_id, n_runs, the run with the greatest length / period (ties: smallest start, then period; null
    without a run) as start, length, period and exponent_milli, the digest of all runs and that of the collapsed text.

    Words are numbered from 0. The collapsed text has the words that no run contains after its first period, joined by one
    space. A null text is empty; empty and blank texts have no runs. Rows are documents of their own, whatever their
    doc_id; a null doc_id stays null. Other columns are not read. No documents give no rows. ``long`` is the size in bytes
    from which a document's tiles are spread over tasks; results don't depend on it.
    """
    numbered = texts(docs).withColumn("_row", F.monotonically_increasing_id())
    kind = numbered.schema["doc_id"].dataType.simpleString()
    # Staged with its numbers and the texts still needed, so that a lost executor cannot number rows anew.
    first = f"_row long, doc_id {kind}, text string, all_sha256 string, long boolean, fragments {_FRAGMENT}"
    seen = stage(numbered.mapInArrow(_first_pass(long), first))
    tiles = seen.where("long").select("_row", "text").mapInArrow(
        _tiles, "_row long, octave long, n long, start long, boundary long, boundaries long, words array<long>"
    )
    spread = tiles.repartition("_row", "octave", "boundary").mapInArrow(_solve_tiles, "_row long, period long, first long, last long")
    pieces = seen.select("_row", F.explode("fragments").alias("f")).select("_row", "f.*").unionByName(spread)
    runs = stitch(pieces).groupBy("_row").agg(F.collect_list(F.struct("start", "length", "period")).alias("runs"))

    unfinished = seen.where(F.col("all_sha256").isNull()).select("_row", "doc_id", "text").join(runs, "_row", "left")
    finished = unfinished.select("doc_id", "text", "runs").mapInArrow(_finish, f"doc_id {kind}, {_COLUMNS}")
    none = [F.lit(None).cast("long").alias(c) for c in ("start", "length", "period", "exponent_milli")]
    plain = seen.where(F.col("all_sha256").isNotNull()).select(
        "doc_id", F.lit(0).cast("long").alias("n_runs"), *none, F.sha2(F.lit("").cast("binary"), 256).alias("runs_sha256"),
        F.col("all_sha256").alias("collapsed_sha256"),
    )
    return plain.unionByName(finished)


def planted(docs: DataFrame) -> DataFrame:
    """(doc_id, text) with a repeated end in a tenth of the documents, so that there is something to find.

    With h the crc32 of the decimal doc_id (null: of the empty text), g = h div 10 and n words: where 10 divides h and n > 0,
    every word from a = g mod n on becomes word a + (i - a) mod p, with p = 1 + (n - a) div (3 + g mod 8).
    """
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    split = F.regexp_extract_all(F.col("text"), F.lit(WORD), F.lit(0))
    g = F.floor(h / F.lit(10)).cast("long")

    def changed(w: Column) -> Column:
        n = F.size(w).cast("long")
        a = g % n
        p = F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8)).cast("long")
        kept = F.slice(w, F.lit(1), (a + p).cast("int"))
        repeated = F.transform(F.sequence(a + p, n - 1), lambda i: F.get(w, (a + (i - a) % p).cast("int")))
        return F.array_join(F.when(a + p < n, F.concat(kept, repeated)).otherwise(kept), " ")

    # One pass over the words: the list is bound by a transform over a single-element array.
    altered = F.get(F.transform(F.array(split), changed), F.lit(0))
    return texts(docs).select("doc_id", F.when((h % 10 == 0) & F.col("text").rlike(WORD), altered).otherwise(F.col("text")).alias("text"))


def document_runs(docs: DataFrame) -> DataFrame:
    return periodic_runs(planted(docs))
