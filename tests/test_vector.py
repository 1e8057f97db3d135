import numpy as np
import pytest
from pyspark.sql import functions as F

from quarryline.operators import nearest
from quarryline.operators import vector as V


def _tables(spark, n=300, q=7, dim=8, seed=5):
    """Random vectors; a third of the chunks are copies of one vector, some are zero or missing."""
    rng = np.random.default_rng(seed)
    hot = rng.normal(size=dim)
    chunks = []
    for i in range(n):
        v = hot if i % 3 == 0 else rng.normal(size=dim)
        value = None if i == 5 else [0.0] * dim if i == 7 else [float(np.float32(x)) for x in v]
        chunks.append((f"c{i:04d}", f"text {i}", value, "s0" if i % 2 else "s1"))
    queries = [(f"q{j}", f"ask {j}", [float(x) for x in (hot if j == 0 else rng.normal(size=dim))]) for j in range(q)]
    queries.append(("zero", "ask", [0.0] * dim))
    return (
        spark.createDataFrame(chunks, "chunk_id string, chunk_text string, embedding array<float>, source string"),
        spark.createDataFrame(queries, "query_id string, query_text string, embedding array<double>"),
        chunks,
        queries,
    )


def _brute_force(chunks, queries, k, source=None):
    out = {}
    for qid, _, qv in queries:
        found = []
        for cid, _, cv, src in chunks:
            if cv is None or not any(cv) or not any(qv) or (source and src != source):
                continue
            a, b = np.array(qv), np.array(cv)
            found.append((round(1 - a @ b / np.linalg.norm(a) / np.linalg.norm(b), 9), cid))
        for rank, (dist, cid) in enumerate(sorted(found)[:k], 1):
            out[(qid, rank)] = (cid, pytest.approx(dist, abs=2e-9))
    return out


def _found(hits):
    return {(r["query_id"], r["rank"]): (r["chunk_id"], r["dist"]) for r in hits.collect()}


@pytest.mark.parametrize("parts", [1, 6])
@pytest.mark.parametrize("query_bytes", [None, 100, 400])
def test_exact_search_equals_brute_force(spark, parts, query_bytes):
    chunks, queries, rows, asked = _tables(spark)
    hits = V.cosine_top_k(chunks.repartition(parts), queries, 10, query_bytes=query_bytes)
    assert _found(hits) == _brute_force(rows, asked, 10)
    assert hits.where("chunk_text <> concat('text ', cast(cast(substring(chunk_id, 2) as int) as string))").isEmpty()


def test_small_blocks_and_slices(spark, monkeypatch):
    monkeypatch.setattr(V, "_CELLS_AT_ONCE", 16)
    chunks, queries, rows, asked = _tables(spark)
    assert _found(V.cosine_top_k(chunks, queries, 4)) == _brute_force(rows, asked, 4)
    assert _found(V.cosine_top_k(chunks, queries, 4, query_bytes=200)) == _brute_force(rows, asked, 4)


def test_source_filter(spark):
    chunks, queries, rows, asked = _tables(spark)
    assert _found(V.cosine_top_k(chunks, queries, 5, source="s1")) == _brute_force(rows, asked, 5, "s1")
    assert V.cosine_top_k(chunks, queries, 5, source="none").isEmpty()


def test_widths_and_missing_components(spark):
    chunks, queries, _, _ = _tables(spark)
    mixed = spark.createDataFrame([("a", "t", [1.0, 2.0]), ("b", "t", [1.0, 2.0, 3.0])], "chunk_id string, chunk_text string, embedding array<double>")
    for some in (mixed.coalesce(1), mixed.where("chunk_id = 'a'")):
        with pytest.raises(Exception, match="components"):
            V.cosine_top_k(some, queries, 3).collect()
    rows = [("a", "t", [1.0, None]), ("b", "t", [1.0, float("nan")]), ("c", "t", [1.0, 0.5]), ("c", "t", [1.0, 0.5])]
    odd = spark.createDataFrame(rows, "chunk_id string, chunk_text string, embedding array<double>")
    asked = spark.createDataFrame([("q", "x", [1.0, 0.0])], "query_id string, query_text string, embedding array<double>")
    assert {r["chunk_id"] for r in V.cosine_top_k(odd, asked, 3).collect()} == {"c"}
    with pytest.raises(ValueError):
        V.cosine_top_k(odd, asked.union(asked), 3)


def test_given_centroids(spark):
    chunks, queries, rows, asked = _tables(spark)
    index = V.build_cells(chunks, centroids=np.eye(8)[:4])
    cells = {r["chunk_id"]: r["cell"] for r in index.chunks.collect()}
    assert set(cells) == {c for c, _, v, _ in rows if v is not None and any(v)}
    assert all(cells[c] == int(np.argmax(np.array(v)[:4])) for c, _, v, _ in rows if c in cells)
    assert _found(V.cell_top_k(index, queries, [4], 5)) == _brute_force(rows, asked, 5)


def test_no_usable_query(spark):
    chunks, queries, _, _ = _tables(spark)
    assert V.cosine_top_k(chunks, queries.where("query_id = 'zero'"), 5).isEmpty()


def test_sweep_repeats_the_exact_hits(spark):
    chunks, queries, rows, asked = _tables(spark)
    hits = V.exact_sweep(chunks, queries, [40, 80], 3)
    assert {(r["param_value"], r["run_name"]) for r in hits.collect()} == {(40, "hnsw_ef40_k3"), (80, "hnsw_ef80_k3")}
    assert _found(hits.where("param_value = 80")) == _brute_force(rows, asked, 3)


@pytest.mark.parametrize("query_bytes", [None, 300])
def test_cells(spark, query_bytes, tmp_path):
    chunks, queries, rows, asked = _tables(spark)
    index = V.build_cells(chunks, 6)
    index.write(str(tmp_path))
    index = V.CellIndex.read(spark, str(tmp_path))
    hits = V.cell_top_k(index, queries, [1, 6], 5, query_bytes=query_bytes)
    assert _found(hits.where("param_value = 6")) == _brute_force(rows, asked, 5)
    shares = {r["param_value"]: r["recall"] for r in V.recall(hits, V.cosine_top_k(chunks, queries, 5)).collect()}
    assert shares[6] == 1.0 and 0.2 < shares[1] <= 1.0


@pytest.mark.parametrize("query_bytes", [None, 300])
def test_recall_target(spark, query_bytes):
    """Clusters far apart: a query reads its own cell only, and never loses what it was promised."""
    rng = np.random.default_rng(4)
    centres = np.eye(12)[:6]
    rows = [(f"c{i}", f"t{i}", (centres[i % 6] + rng.normal(0, 0.05, 12)).tolist(), f"s{i % 2}") for i in range(600)]
    rows += [("none", "t", None, "s0"), ("zero", "t", [0.0] * 12, "s1"), ("twin", "t", rows[0][2], "s0")]
    chunks = spark.createDataFrame(rows, "chunk_id string, chunk_text string, embedding array<double>, source string").repartition(3)
    asked = [("near", "x", (centres[2] + 0.02).tolist()), ("between", "y", (centres[0] + centres[1]).tolist()), ("far", "z", np.eye(12)[9].tolist())]
    queries = spark.createDataFrame(asked, "query_id string, query_text string, embedding array<double>")
    index = V.build_cells(chunks, centroids=centres)
    for source in (None, "s0"):
        exact = {}
        for r in V.cosine_top_k(chunks, queries, 8, source).collect():
            exact.setdefault(r.query_id, {})[r.rank] = (r.chunk_id, r.dist)
        for target, sure in ((1.0, 8), (0.5, 4), (0.01, 1)):
            found, read = {}, {}
            for r in V.cells_to_recall(index, queries, target, 8, source, query_bytes).collect():
                found.setdefault(r.query_id, {})[r.rank] = (r.chunk_id, r.dist)
                read[r.query_id] = r.cells_read
            assert {q: len(v) for q, v in found.items()} == {q: 8 for q, _, _ in asked}
            assert all(found[q][n] == exact[q][n] for q in exact for n in range(1, sure + 1))
            assert read["near"] == 1 and read["between"] <= 2 and read["far"] <= 6


def test_recall_target_with_few_chunks(spark):
    chunks, queries, rows, asked = _tables(spark)
    index = V.build_cells(chunks, 6)
    n = sum(v is not None and any(v) for _, _, v, _ in rows)
    assert _found(V.cells_to_recall(index, queries, 1.0, n + 5)) == _brute_force(rows, asked, n + 5)
    assert _found(V.cells_to_recall(index, queries, 1.0, 5)) == _brute_force(rows, asked, 5)
    assert V.cells_to_recall(index, queries, 1.0, 5, "no such source").isEmpty()
    with pytest.raises(ValueError):
        V.cells_to_recall(index, queries, 0.0)


def test_only_probed_cells_are_read(spark, tmp_path):
    chunks, queries, _, _ = _tables(spark)
    V.build_cells(chunks, 6).write(str(tmp_path))
    index = V.CellIndex.read(spark, str(tmp_path))
    asked = V._nearest_cells(V._query_side(queries.limit(1), [1]), index.centroids)
    scan = V._scan(V._chunk_side(index.chunks, None, F.col("cell")), asked, 5)
    assert "PartitionFilters: [isnotnull(cell" in scan._jdf.queryExecution().executedPlan().toString()


def test_one_block_of_queries_at_a_time(spark):
    """The next block is fetched only when the one before is staged."""
    alive = []

    def scans():
        for n in range(4):
            assert len(alive) <= 1  # what is not staged yet
            alive.append(n)
            frame = spark.range(1).selectExpr(f"'q{n}' AS query_id", "0 AS param_value", "0D AS cost", "'c' AS chunk_id", "string(null) AS source")
            yield frame
            alive.pop()

    assert sorted(r.query_id for r in nearest.in_blocks(scans(), 4, spark).collect()) == ["q0", "q1", "q2", "q3"]
    assert nearest.in_blocks(iter([]), 3, spark).count() == 0
