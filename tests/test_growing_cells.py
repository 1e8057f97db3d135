import numpy as np
import pytest

from quarryline.operators import growing_cells as G
from quarryline.operators import vector as V

SCHEMA = "chunk_id string, chunk_text string, embedding array<float>, source string"


def _rows(n, dim=8, seed=3, shift=0.0, start=0):
    rng = np.random.default_rng(seed)
    centres = np.random.default_rng(9).normal(size=(12, dim)) + shift
    return [
        (f"c{i:05d}", f"t{i}", [float(x) for x in (centres[i % 12] + rng.normal(0, 0.3, dim)).astype(np.float32)], f"s{i % 2}")
        for i in range(start, start + n)
    ]


def _frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def _cells(index):
    rows = index.chunks.select("source", "chunk_id", "cell", "away").collect()
    assert len({(r.source, r.chunk_id) for r in rows}) == len(rows)
    return {(r.source, r.chunk_id): (r.cell, round(r.away, 6)) for r in rows}


def _sizes(index):
    return np.bincount([c for c, _ in _cells(index).values()], minlength=len(index.centroids))


def _queries(spark, dim=8, n=20):
    rng = np.random.default_rng(17)
    centres = np.random.default_rng(9).normal(size=(12, dim))
    rows = [(f"q{i}", "x", (centres[i % 12] + rng.normal(0, 0.4, dim)).tolist()) for i in range(n)]
    return spark.createDataFrame(rows, "query_id string, query_text string, embedding array<double>")


def test_balanced_cells_are_those_of_their_centroids(spark):
    rows = _rows(1200)
    chunks = _frame(spark, rows)
    index = G.balance(V.build_cells(chunks, centroids=np.array([r[2] for r in rows[:3]])), most=150, least=10)
    assert _sizes(index).max() <= 150 and len(index.centroids) >= 8
    assert _cells(index) == _cells(V.build_cells(chunks, centroids=index.centroids))


def test_small_cells_are_merged(spark):
    rows = _rows(300)
    far = np.eye(8)[0] * -50  # nobody is near it
    given = np.array([r[2] for r in rows[:12]] + [rows[0][2], far.tolist()])
    chunks = _frame(spark, rows)
    index = G.balance(V.build_cells(chunks, centroids=given), most=300, least=10)
    assert len(index.centroids) < 13 and sum(_sizes(index)) == 300
    assert _cells(index) == _cells(V.build_cells(chunks, centroids=index.centroids))
    assert len(G.balance(V.build_cells(chunks, centroids=given), most=1000, least=1000).centroids) == 1


def test_copies_stay_together(spark):
    """A third of the chunks is one vector: its cell is larger than asked, all others are not."""
    rows = _rows(400)
    hot = [(f"h{i}", "t", rows[5][2], "s0") for i in range(200)]
    chunks = _frame(spark, rows + hot)
    index = G.balance(V.build_cells(chunks, centroids=np.array([r[2] for r in rows[:2]])), most=60, least=2)
    cells = _cells(index)
    assert len(cells) == 600 and len({cells["s0", f"h{i}"] for i in range(200)}) == 1
    sizes = _sizes(index)
    assert np.delete(sizes, cells["s0", "h0"][0]).max() <= 60


def test_appends_match_a_rebuild(spark):
    """Ten appends of data that drifts: recall with as many probes is that of an index made anew, within 0.02."""
    parts = [_rows(120, seed=n, shift=0.08 * n, start=120 * n) for n in range(11)]
    index = V.build_cells(_frame(spark, parts[0]), 12)
    for part in parts[1:]:
        index = G.balance(G.append(index, _frame(spark, part)), most=110, least=20)
    everything = _frame(spark, [r for p in parts for r in p])
    assert _cells(index) == _cells(V.build_cells(everything, centroids=index.centroids))
    queries = _queries(spark)
    exact = V.cosine_top_k(everything, queries, 10)
    rebuilt = V.build_cells(everything, len(index.centroids))
    share = [V.recall(V.cell_top_k(i, queries, [4], 10), exact).first().recall for i in (index, rebuilt)]
    assert share[0] >= share[1] - 0.02, share
    found = V.cells_to_recall(index, queries, 1.0, 10).drop("cells_read", "run_name", "param_value")
    assert sorted(found.collect()) == sorted(exact.select(*found.columns).collect())


def test_delete_and_replace(spark):
    rows = _rows(200)
    index = V.build_cells(_frame(spark, rows), 5)
    gone = spark.createDataFrame([("c00002", "s0"), ("c00003", "s0"), ("c00002", "s0"), ("none", None)], "chunk_id string, source string")
    left = _cells(G.delete(index, gone))
    assert set(_cells(index)) - set(left) == {("s0", "c00002")}  # c00003 is of the other source
    new = [("c00004", "new", rows[7][2], "s0"), ("c00006", "new", None, "s0"), ("more", "new", rows[1][2], None)]
    grown = G.append(index, _frame(spark, new))
    cells = _cells(grown)
    assert set(cells) == set(_cells(index)) - {("s0", "c00006")} | {(None, "more")}
    assert cells["s0", "c00004"][0] == _cells(index)["s1", "c00007"][0]
    assert grown.chunks.where("chunk_text = 'new'").count() == 2
    assert set(_cells(G.delete(grown, spark.createDataFrame([("more",)], "chunk_id string")))) == set(cells) - {(None, "more")}


def test_files_are_only_added(spark, tmp_path):
    rows, folder = _rows(300), str(tmp_path)
    V.build_cells(_frame(spark, rows[:200]), 5).write(folder)
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "chunks").rglob("*.parquet")}
    G.append_files(folder, _frame(spark, rows[200:]))
    after = {p: p.stat().st_mtime_ns for p in (tmp_path / "chunks").rglob("*.parquet")}
    assert before.items() < after.items()
    queries = _queries(spark)
    index = G.balance(V.CellIndex.read(spark, folder), most=40)
    assert _sizes(index).sum() == 300
    found = V.cells_to_recall(index, queries, 1.0, 10).select("query_id", "rank", "chunk_id", "dist")
    exact = V.cosine_top_k(_frame(spark, rows), queries, 10).select(*found.columns)
    assert sorted(found.collect()) == sorted(exact.collect())


def test_empty_index(spark):
    rows = _rows(50)
    index = V.build_cells(_frame(spark, []), centroids=np.array([r[2] for r in rows[:4]]))
    assert len(G.balance(index, most=10).centroids) == 1
    assert _sizes(G.balance(G.append(index, _frame(spark, rows)), most=10)).max() <= 10
    with pytest.raises(ValueError):
        G.balance(index, most=5, least=6)
