import math
import random
from collections import defaultdict

import pytest

from quarryline.functions.text import gold_query_id
from quarryline.operators import labels, metrics


def test_truth_labels(spark):
    raw = {"2": 2, " 2 ": 2, "2.7": 2, "-1.5": -1, "1e1": 10, "": 0, "abc": 0, None: 0, "NaN": 0}
    rows = [("q", str(i), text) for i, text in enumerate(raw)] + [("q", "two", "1"), ("q", "two", "3"), (None, "x", "1")]
    truth = labels.truth_labels(spark.createDataFrame(rows, "query_id string, chunk_id string, relevance string"))
    found = {r["chunk_id"]: r["relevance"] for r in truth.collect()}
    assert found == {**{str(i): value for i, value in enumerate(raw.values())}, "two": 3}


def test_gold_query_id(spark):
    df = spark.createDataFrame([("parse_eval2_q001_01",), ("eval2_q001",)], "query_id string")
    assert {r[0] for r in df.select(gold_query_id(df.query_id)).collect()} == {"eval2_q001"}


def test_label_join_and_unique_labels(spark):
    hits = spark.createDataFrame([("parse_e_q1_02", "a", 1), ("e_q1", "b", 2)], "query_id string, chunk_id string, rank int")
    truth = spark.createDataFrame([("e_q1", "a", 3)], "query_id string, chunk_id string, relevance int")
    rows = labels.label_hits(hits, truth).orderBy("rank").collect()
    assert [(r["gold_query_id"], r["relevance"], r["query_id_truth"]) for r in rows] == [("e_q1", 3, "e_q1"), ("e_q1", 0, None)]
    assert labels.label_hits(hits, truth.union(truth)).count() == 2


def test_nearest_hits(spark):
    rows = [("q", "a", 0.5, 50, 2), ("q", "a", 0.4, 100, 1), ("q", "b", 0.5, 100, 1), ("q", "b", 0.5, 50, 3)]
    df = spark.createDataFrame(rows, "query_id string, chunk_id string, dist double, param_value int, rank int")
    found = labels.nearest_hits(df).orderBy("chunk_id").collect()
    assert [(r["chunk_id"], r["dist"], r["param_value"]) for r in found] == [("a", 0.4, 100), ("b", 0.5, 50)]


HIT = "query_id string, chunk_id string, rank int, relevance int"


def _scores(spark, grades, k):
    rows = [("q", f"{i:03d}", i + 1, g) for i, g in enumerate(grades)]
    return metrics.query_scores(spark.createDataFrame(rows, HIT), k).first()


def test_score_examples(spark):
    s = _scores(spark, [3, 0, 2, 1], 3)
    assert s["dcg_value"] == pytest.approx(8.5)
    assert s["ndcg_value"] == pytest.approx(8.5 / 9.392789, abs=1e-6)
    assert (s["precision_at_k"], s["average_precision"]) == (pytest.approx(2 / 3), pytest.approx(0.833333, abs=1e-6))
    s = _scores(spark, [0, None, 0], 3)
    assert (s["ndcg_value"], s["precision_at_k"], s["average_precision"]) == (0.0, 0.0, 0.0)
    s = _scores(spark, [2, 2], 10)
    assert (s["precision_at_k"], s["average_precision"]) == (0.2, 1.0)


def _plain_scores(rows, k):
    best = {}
    for q, c, rank, grade in rows:
        key = (rank is None, rank or 0, grade or 0)
        best[q, c] = min(best.get((q, c), key), key)
    lists = defaultdict(list)
    for (q, c), (last, rank, grade) in best.items():
        lists[q].append((last, rank, c, grade))

    def dcg(grades):
        return sum((2**g - 1) / math.log2(i + 2) for i, g in enumerate(grades[:k]))

    out = {}
    for q, items in lists.items():
        grades = [x[3] for x in sorted(items)]
        ideal = dcg(sorted(grades, reverse=True))
        hits = [i for i, g in enumerate(grades[:k]) if g > 1]
        ap = sum((n + 1) / (i + 1) for n, i in enumerate(hits)) / len(hits) if hits else 0.0
        out[q] = (dcg(grades), dcg(grades) / ideal if ideal > 0 else 0.0, len(hits) / k, ap)
    return out


@pytest.mark.parametrize("parts", [1, 7])
def test_scores_equal_a_plain_loop_on_skewed_lists(spark, parts):
    rng = random.Random(4)
    rows = []
    for i in range(2000):
        q = "hot" if i % 3 == 0 else f"q{rng.randint(0, 20)}"
        rows.append((q, f"c{rng.randint(0, 400)}", rng.choice([None, *range(1, 60)]), rng.choice([None, 0, 0, 1, 2, 3])))
    found = metrics.query_scores(spark.createDataFrame(rows, HIT).repartition(parts), 10).collect()
    expected = _plain_scores(rows, 10)
    assert len(found) == len(expected)
    for r in found:
        assert tuple(r)[1:] == pytest.approx(expected[r["query_id"]])
        assert all(-1e-9 <= x <= 1 + 1e-9 for x in tuple(r)[2:])


def test_ranked_list(spark):
    rows = [("q", "a", 5, None), ("q", "b", 2, 1), ("q", "a", 3, 2), ("q", "c", None, 3), ("p", "a", 9, 1)]
    for bound in (None, 10):
        found = metrics.ranked_list(spark.createDataFrame(rows, HIT), rows_per_query=bound).collect()
        assert sorted(map(tuple, found)) == [("p", "a", 1, 1), ("q", "a", 2, 2), ("q", "b", 1, 1), ("q", "c", 3, 3)]


def test_rank_column_decides(spark):
    schema = "query_id string, chunk_id string, rank int, rank_reranked int, relevance int"
    df = spark.createDataFrame([("q", "a", 1, 2, 2), ("q", "b", 2, 1, 0)], schema)
    assert metrics.precision(df, 1).first()["precision_at_k"] == 1.0
    assert metrics.precision(df, 1, rank_col="rank_reranked").first()["precision_at_k"] == 0.0


def test_summary_and_delta(spark):
    rows = [("x", "q1", "a", 1, 2), ("x", "q2", "a", 1, 0), ("y", "q1", "a", 1, 2), ("y", "q2", "a", 1, 3)]
    df = spark.createDataFrame(rows, "run string, " + HIT)
    summary = metrics.summarize(df, 1)
    assert {r["run"]: (r["p_at_k"], r["dcg_at_k"]) for r in summary.collect()} == {"x": (0.5, 1.5), "y": (1.0, 5.0)}
    delta = metrics.run_delta(summary, "y", "x").collect()
    assert [(r["run"], r["p_at_k"], r["dcg_at_k"]) for r in delta] == [("y - x", 0.5, 3.5)]
    assert metrics.run_delta(summary, "y", "absent").isEmpty()
    assert metrics.compare_runs(summary, summary.limit(0)).count() == 2


def test_scores_without_the_ideal(spark):
    rows = spark.createDataFrame([("q", "a", 1, 3), ("q", "b", 2, 0)], HIT)
    plan = metrics.precision(rows, 3)._jdf.queryExecution().optimizedPlan().toString()
    assert "ideal_dcg" not in plan and metrics.dcg(rows, 3).first()["dcg_value"] == 7.0
