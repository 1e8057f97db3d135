import math
import random
import re
import uuid
from collections import Counter, defaultdict

import pytest

from quarryline.operators import fusion, keyword, nearest, rerank


def _tables(spark, chunks, queries):
    return (
        spark.createDataFrame(chunks, "chunk_id string, chunk_text string, source string"),
        spark.createDataFrame(queries, "query_id string, query_text string"),
    )


def test_small_example(spark):
    chunks, queries = _tables(
        spark, [("d1", "cat dog", "s"), ("d2", "Cat cat fish", "s"), ("d3", "bird", "s")], [("q", "cat, fish!"), ("none", "--")]
    )
    rows = keyword.bm25_top_k(keyword.keyword_index(chunks, queries), chunks, queries).collect()
    found = sorted((r["rank"], r["chunk_id"], r["score"], r["chunk_text"]) for r in rows)
    assert found == [(1, "d2", 1.380853, "Cat cat fish"), (2, "d1", 0.470004, "cat dog")]


def _brute_force(chunks, queries, k, source):
    split = {c: re.findall(r"[a-z]+", t.lower()) for c, t, _ in chunks}
    avg = sum(map(len, split.values())) / len(split)
    df = Counter(t for words in split.values() for t in set(words))
    out = {}
    for q, text in queries:
        scores = defaultdict(float)
        for t in set(re.findall(r"[a-z]+", text.lower())):
            for c, _, src in chunks:
                tf = split[c].count(t)
                if tf and (source is None or src == source):
                    idf = math.log(1 + (len(split) - df[t] + 0.5) / (df[t] + 0.5))
                    scores[c] += idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(split[c]) / avg))
        best = sorted(scores.items(), key=lambda x: (-round(x[1], 6), x[0]))[:k]
        out.update({(q, i): (c, pytest.approx(s, abs=2e-6)) for i, (c, s) in enumerate(best, 1)})
    return out


@pytest.mark.parametrize("source", [None, "s1"])
@pytest.mark.parametrize("limit", [None, 0])
@pytest.mark.parametrize("restricted", [True, False])
def test_equals_brute_force(spark, source, limit, restricted):
    """A third of all words are one word; some chunks have no words at all."""
    rng = random.Random(2)
    chunks = []
    for i in range(80):
        words = ["the" if rng.random() < 0.34 else rng.choice("abcdefghijklmnop") * 2 for _ in range(rng.randint(0, 30))]
        chunks.append((f"c{i:03d}", " ".join(words), f"s{i % 3}"))
    queries = [(f"q{i}", " ".join(rng.choices(["the", "aa", "bb", "cc", "zz"], k=4))) for i in range(6)]
    c, q = _tables(spark, chunks, queries)
    index = keyword.keyword_index(c, q if restricted else None)
    options = {} if limit is None else {"limit": limit}
    rows = keyword.bm25_top_k(index, c, q, 9, source, **options).collect()
    assert {(r["query_id"], r["rank"]): (r["chunk_id"], r["score"]) for r in rows} == _brute_force(chunks, queries, 9, source)


def test_saved_index(spark):
    chunks, queries = _tables(spark, [("d1", "cat dog", "s"), ("d2", "cat cat fish", "s")], [("q", "cat fish")])
    name = f"kw_{uuid.uuid4().hex[:8]}"
    keyword.keyword_index(chunks).save(name)
    hits = keyword.bm25_top_k(keyword.KeywordIndex.load(spark, name), chunks, queries)
    assert [r["chunk_id"] for r in hits.orderBy("rank").collect()] == ["d2", "d1"]
    for part in ("entries", "df", "totals"):
        spark.sql(f"DROP TABLE {name}_{part}")


def test_tasks_return_at_most_k_rows_per_query(spark, monkeypatch):
    """Every chunk matches every query, yet a task lets ``k`` rows per query out, in batches of any size."""
    monkeypatch.setattr(keyword, "_CELLS_AT_ONCE", 12)
    chunks, queries = _tables(spark, [(f"c{i:03d}", f"the w{i % 7} the", "s") for i in range(200)], [(f"q{i}", f"the w{i}") for i in range(4)])
    sent = []
    monkeypatch.setattr(keyword, "merge", lambda partial, k: (sent.append(partial.count()), merge(partial, k))[1])
    merge = nearest.merge
    rows = keyword.bm25_top_k(keyword.keyword_index(chunks.repartition(3)), chunks, queries, 5).collect()
    assert 20 <= sent[0] <= 3 * 4 * 5 and len(rows) == 20


def test_ids_name_chunks_within_a_source(spark):
    chunks, queries = _tables(spark, [("a", "cat", "s"), ("a", "cat dog", "t"), ("b", "bird", "s")], [("q", "cat")])
    index = keyword.keyword_index(chunks)
    rows = keyword.bm25_top_k(index, chunks, queries).collect()
    assert sorted((r["rank"], r["chunk_text"]) for r in rows) == [(1, "cat"), (2, "cat dog")] and all(r["score"] > 0 for r in rows)
    assert [r["chunk_text"] for r in keyword.bm25_top_k(index, chunks, queries, source="t").collect()] == ["cat dog"]
    with pytest.raises(ValueError):
        keyword.bm25_top_k(index, chunks, queries.union(queries))


KEYS = "query_id string, query_text string, chunk_id string, chunk_text string"


def _fuse(spark, vector, key, **options):
    v = spark.createDataFrame([("q", "t", c, f"text {c}", r) for c, r in vector], KEYS + ", rank string")
    k = spark.createDataFrame([("q", "t", c, f"text {c}", r) for c, r in key], KEYS + ", rank int")
    rows = fusion.reciprocal_rank_fusion(v, k, **options).orderBy("rank").collect()
    return [(r["chunk_id"], round(r["score"], 6)) for r in rows]


@pytest.mark.parametrize("bound", [None, 10])
def test_fusion_example(spark, bound):
    found = _fuse(spark, [("A", "1"), ("B", "2")], [("A", 3), ("C", 1)], rows_per_query=bound)
    assert found == [("A", 0.016133), ("C", 0.008197), ("B", 0.008065)]


def test_fusion_ignores_unreadable_ranks_and_swaps_evenly(spark):
    assert _fuse(spark, [("A", "x"), ("B", "NaN"), ("A", "2")], []) == [("A", round(0.5 / 62, 6)), ("B", 0.0)]
    one = _fuse(spark, [("A", "1"), ("B", "2")], [("B", 1), ("D", 2)], a=0.9, b=0.1)
    two = _fuse(spark, [("B", "1"), ("D", "2")], [("A", 1), ("B", 2)], a=0.1, b=0.9)
    assert one == two


def test_fusion_keeps_the_lowest_text_of_a_pair(spark):
    v = spark.createDataFrame([("q", "t", "c", "b", 1), ("q", "t", "c", "a", 9), (None, "t", "c", "a", 1)], KEYS + ", rank int")
    rows = fusion.reciprocal_rank_fusion(v, v.where("false")).collect()
    assert [(r["chunk_text"], round(r["score"], 6), r["rank"]) for r in rows] == [("a", round(0.5 / 69, 6), 1)]


def test_rerank_and_context(spark):
    hits = spark.createDataFrame(
        [("q", "red fox", "1", "a dog", 1), ("q", "red fox", "2", "red fox", 2), ("q", "red fox", "3", "a fox", 3)],
        KEYS + ", rank int",
    )
    rows = rerank.rerank(hits, k=2).orderBy("rank_reranked").collect()
    assert [(r["chunk_id"], r["rerank_score"], r["rank"]) for r in rows] == [("2", 1.0, 2), ("3", 0.5, 3)]
    context = rerank.retrieved_context(hits.where("rank > 1"), 3).first()["context"]
    assert context == "Chunk 1:\nred fox\n\nChunk 2:\na fox"
