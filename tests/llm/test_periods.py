import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest

from quarryline.llm import periods


def all_runs(words):
    """Every period tried at every place."""
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            if i + q - start >= max(6, 4 * q):
                found.setdefault((start, i + q), q)
    return sorted((start, end - start, q) for (start, end), q in found.items())


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    runs = sorted(all_runs(words), key=lambda r: (r[0], r[2]))
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None, None, None))
    dropped = {i for start, length, q in runs for i in range(start + q, start + length)}
    return (
        doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
        sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in dropped)),
    )


def words_of(seed, n):
    """Few different words, with repeated stretches of all periods, also inside each other."""
    rng = random.Random(seed)
    out = []
    while len(out) < n:
        part = [rng.choice("abc") for _ in range(rng.randint(1, 12))]
        if rng.random() < 0.3:
            part = part * rng.randint(2, 9)
        if rng.random() < 0.2 and out:
            part = out[-rng.randint(1, min(len(out), 60)) :] * rng.randint(1, 6)
        out += part
    return out[:n]


def fibonacci(n):
    a, b = "a", "ab"
    while len(b) < n:
        a, b = b, b + a
    return list(b[:n])


def rows():
    out = [(i, " ".join(words_of(i, n))) for i, n in enumerate([0, 1, 5, 6, 7, 8, 24, 50, 100, 333, 500, 500, 700, 1000, 64, 65, 128])]
    out += [(100, "a " * 3000), (101, " ".join(fibonacci(2000))), (102, "x" * 50_000 + " y"), (103, "a b " * 2), (104, "a b\n" * 4)]
    out += [(105, None), (106, ""), (107, " \n\t "), (None, "z z z z z z"), (None, "z z z z z"), (12, "é　é é　é é　é é　é é　é é　é")]
    ladder = [f"w{i}" for i in range(300)]
    out += [(108, " ".join(ladder * 5)), (109, " ".join(ladder + ["k", "k"] + ladder * 4 + ["end"])), (110, " ".join(words_of(3, 400) * 6))]
    return out + out[9:11]  # repeated rows


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame([(i, t, 1, "x") for i, t in rows()], "doc_id long, text string, n_runs int, _row string").repartition(3)


def key(row):
    return tuple(str(x) for x in row)


@pytest.mark.parametrize("long", [periods.LONG, 300, 0])
def test_against_brute_force(spark, frame, long):
    """In place, and with tiles of all documents, or of the longer ones, spread."""
    got = periods.periodic_runs(frame, long)
    assert sorted(map(key, got.collect())) == sorted(key(expected(i, t)) for i, t in rows())


def test_small_tile_rows(spark, frame, monkeypatch):
    """The cuts between rows of tiles make no difference."""
    small = [(int(i), t) for i, t in rows() if i is not None and i < 100]
    tiles, solve = periods._tiles, periods._solve_tiles
    monkeypatch.setattr(periods, "_ROW", 8)
    batch = pa.RecordBatch.from_pydict({"_row": list(range(len(small))), "text": [t for _, t in small]})
    found = pa.Table.from_batches(list(solve(tiles(iter([batch])))))
    pieces = spark.createDataFrame(found.to_pandas())
    got = {}
    for r in periods.stitch(pieces).collect():
        got.setdefault(r._row, []).append((r.start, r.length, r.period))
    assert {k: sorted(v) for k, v in got.items()} == {k: v for k, (_, t) in enumerate(small) if (v := all_runs(periods.split_words(t)))}


def test_colliding_names(monkeypatch):
    """Names that collide all the time are noticed, and exact ones used."""
    monkeypatch.setattr(periods, "_mix", lambda a, b: (a + b) % np.uint64(5))
    words = [periods.split_words(t) for _, t in rows()[:17]]
    found = periods.fragments(*periods._coded(words))
    runs = {}
    for d, q, first, last in found.tolist():
        if last + q - first >= max(6, 4 * q):
            runs.setdefault(d, []).append((first, last + q - first, q))
    # Documents of one tile need no stitching.
    for d in range(6):
        assert sorted(runs.get(d, [])) == all_runs(words[d])


def test_few_fragments():
    """A run is found at its own period, not at the multiples of it as well."""
    words = [b"a"] * 20_000
    assert len(periods.fragments(*periods._coded([words]))) <= 20_000


def test_planted(spark):
    texts = [(i, " ".join(f"{i}-{k % 50}" for k in range(i % 90))) for i in range(300)] + [(None, "a b c d e f g h"), (7, None), (8, "")]
    got = periods.planted(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    for (doc_id, text), r in zip(texts, got):
        h = zlib.crc32(("" if doc_id is None else str(doc_id)).encode())
        w = (text or "").split()
        if h % 10 == 0 and w:
            g = h // 10
            a = g % len(w)
            p = 1 + (len(w) - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(len(w))]
        assert (r.doc_id, r.text.split()) == (doc_id, w)
    assert periods.document_runs(spark.createDataFrame([], "doc_id long, text string")).count() == 0
