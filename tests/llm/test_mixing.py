import itertools
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from quarryline.llm import mixing


def shared_out(sizes, weights, budget, most):
    """The rule word by word: share by weight, stop at the limit, share the excess again until none is above."""
    goal, full = [Fraction(0)] * len(sizes), set()
    while True:
        left = budget - sum(most * sizes[i] for i in full)
        rest = [i for i in range(len(sizes)) if i not in full]
        for i in rest:
            goal[i] = left * weights[i] / Fraction(sum(weights[j] for j in rest))
        above = [i for i in rest if goal[i] > most * sizes[i]]
        if not above:
            return goal
        for i in above:
            goal[i] = Fraction(most * sizes[i])
        full |= set(above)


@pytest.mark.parametrize("seed", range(20))
def test_targets(seed):
    rng = random.Random(seed)
    sizes = [rng.choice([0, rng.randint(1, 9), rng.randint(1, 10**6)]) for _ in range(rng.randint(1, 12))]
    weights = [(5, 2, 1)[i % 3] for i in range(len(sizes))]
    got = mixing.targets(sizes, weights)
    assert [Fraction(t.words, t.parts) for t in got] == shared_out(sizes, weights, Fraction(3, 2) * sum(sizes), 2)
    assert all(abs(t.quota - t.value) <= 0.5 for t in got)


@pytest.mark.parametrize("seed", range(60))
def test_flow_is_greatest_and_cheapest(seed):
    """With every number of copies the flow reaches the smallest cut, so no repetition could be avoided."""
    rng = random.Random(seed)
    sources = list(range(rng.randint(1, 5)))
    every = [c for k in range(1, len(sources) + 1) for c in itertools.combinations(sources, k)]
    patterns = {p: rng.randint(0, 30) for p in rng.sample(every, rng.randint(1, len(every)))}
    quota = {s: rng.randint(0, 60) for s in sources}
    flow = mixing.min_cost_flow(patterns, {p: p for p in patterns}, quota, 3)
    sent = {p: sum(flow[p, s] for s in p) for p in patterns}
    assert all(n >= 0 for n in flow.values())
    assert all(sum(flow[p, s] for p in patterns if s in p) <= quota[s] for s in sources)
    for copies in (1, 2, 3):
        cut = min(
            sum(quota[s] for s in a) + sum(copies * n for p, n in patterns.items() if not set(p) <= set(a))
            for k in range(len(sources) + 1)
            for a in itertools.combinations(sources, k)
        )
        assert sum(min(sent[p], copies * n) for p, n in patterns.items()) == cut


def test_overlapping_sources(spark):
    rng = random.Random(1)
    kinds = [["a"], ["a", "b"], ["b", "c"], ["c", None], [None], [], None, ["b", "b"]]
    rows = [(i, rng.choice(kinds), rng.randint(0, 50), i) for i in range(600)] + [(7, ["a"], 10, 7)] * 3  # repeated rows
    frame = spark.createDataFrame(rows, "id long, of array<string>, n long, _pattern long").repartition(5)
    mixed, sources = mixing.mix(frame, F.col("of"), F.col("n"), mixing.seeded(F.col("id")))
    got, goal = mixed.collect(), {r.source: r for r in sources.collect()}
    assert len(got) == len(rows) and sorted((r.id, r.n, r._pattern) for r in got) == sorted((i, n, p) for i, _, n, p in rows)
    assert all(0 <= r.taken <= 2 * r["size"] for r in got)
    assert all(r.taken == 0 for r in got if not r.of)
    assert sum(r.taken for r in got) == sum(r.routed for r in goal.values())
    assert all(r.routed <= r.quota for r in goal.values())
    by_size = {s: sum(n for _, of, n, _ in rows if of and s in of) for s in goal}
    assert {s: r.source_size for s, r in goal.items()} == by_size
    # Inside a pattern one document at most is taken in part.
    parts = {}
    for r in got:
        if r["size"] and r.taken % r["size"]:
            parts[tuple(sorted(map(str, set(r.of))))] = parts.get(tuple(sorted(map(str, set(r.of)))), 0) + 1
    assert all(n == 1 for n in parts.values())
    again = mixing.mix(frame.repartition(3), F.col("of"), F.col("n"), mixing.seeded(F.col("id")))[0].collect()
    assert sorted((r.id, r.n, r.taken) for r in got) == sorted((r.id, r.n, r.taken) for r in again)


def test_documents_with_odd_rows(spark):
    long = "word " * 30_000
    rows = [(1, "a b\tc", "s", 5), (1, "a b\tc", "s", 5), (2, None, "s", 1), (3, "", None, 2), (4, " \n ", "t", 3), (None, "x y", None, 4)]
    rows += [(9, long, "t", 0), (10, "　x y z", "u", None), (11, "q", "", 1)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string, taken long")  # a clashing name is not read
    got = mixing.mix_documents(frame).collect()
    assert sorted((r.doc_id or -1, r["size"]) for r in got) == sorted([(1, 3), (1, 3), (2, 0), (3, 0), (4, 0), (-1, 2), (9, 30_000), (10, 2), (11, 1)])
    of = {r.source: r for r in got}
    assert of["t"].source_size == 30_000 and of[None].source_size == 2
    goal = shared_out([1, 6, 30_000, 2, 2], [5, 2, 1, 5, 2], Fraction(3, 2) * 30_011, 2)  # "", s, t, u, null
    assert [of[s].target for s in ("", "s", "t", "u", None)] == [round(float(g), 6) for g in goal]
    for s, g in zip(("", "s", "t", "u", None), goal):
        assert abs(sum(r.taken for r in got if r.source == s) - g) <= 0.5
    assert mixing.mix_documents(frame.limit(0)).count() == 0
    assert [r.taken for r in mixing.mix_documents(frame.where("doc_id = 2")).collect()] == [0]


def test_taken_names_are_refused(spark):
    frame = spark.createDataFrame([(1, 2)], "id long, taken long")
    with pytest.raises(ValueError, match="taken"):
        mixing.mix(frame, F.array(F.lit("a")), F.col("id"), F.col("id"))
