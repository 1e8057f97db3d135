import math
import random

import numpy as np
from pyspark.sql import functions as F

from quarryline.llm import topk


def brute(rows, k):
    kept = []
    for i, v, _ in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            kept.append((i, [math.floor(1024 * x) for x in v]))
    out = set()
    for q in {i for i, _ in kept if i % 10 == 0}:
        vector = min(v for i, v in kept if i == q)
        scores = sorted((-sum(a * b for a, b in zip(vector, v)), i) for i, v in kept if i != q and len(v) == len(vector))
        out |= {(q, rank, i, -s) for rank, (s, i) in enumerate(scores[:k], 1)}
    return out


def data(n, width=8):
    rng = random.Random(3)
    base = [[rng.gauss(0, 0.4) for _ in range(width)] for _ in range(12)]
    rows = [(i, [x + rng.gauss(0, 0.02) for x in rng.choice(base)], "x") for i in range(n)]
    rows += [(n + i, list(base[0]), "same") for i in range(40)]  # ties
    rows += [(None, base[1], ""), (n + 50, None, ""), (n + 51, [0.1, None], ""), (n + 52, [float("nan")] * width, ""), (n + 53, [0.5, 0.5], "")]
    return rows + [(n + 60, [], "empty"), (n + 70, [0.2, 0.1], "short"), rows[5], rows[7]]


def test_against_brute_force(spark):
    rows = data(400)
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score string").repartition(5)
    for block in (4096, 16):
        got = topk.search(frame, F.col("vec_id") % 10 == 0, 10, block).collect()
        assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got) == sorted(brute(rows, 10))
    assert topk.search(frame.limit(0), F.col("vec_id") % 10 == 0).count() == 0


def test_fewer_than_k(spark):
    frame = spark.createDataFrame([(0, [1.0]), (1, [0.5]), (2, [0.25])], "vec_id long, embedding array<float>")
    got = topk.search(frame, F.col("vec_id") == 0).collect()
    assert [(r.rank, r.vec_id, r.score) for r in sorted(got, key=lambda r: r.rank)] == [(1, 1, 1024 * 512), (2, 2, 1024 * 256)]


def test_bounds_prune():
    rng = np.random.default_rng(0)
    rows = np.floor(1024 * np.repeat(rng.normal(size=(20, 4)), 16, axis=1) + rng.normal(size=(20, 64)) * 20)
    rows = np.concatenate([rows, rows * 0.1, np.repeat(rows, 200, axis=0) * 0.05])
    best = topk.Best(np.arange(20), rows[:20], 10)
    best.add(np.arange(len(rows)), rows)
    assert best.scored < 0.5 * best.pairs
    exact = rows[:20] @ rows.T
    for q in range(20):
        order = sorted((-exact[q, i], i) for i in range(len(rows)) if i != q)[:10]
        assert [(-s, i) for s, i in order] == list(zip(best.score[q], best.found[q]))
