import pytest
from pyspark.sql import functions as F

from quarryline.functions.text import content_hash
from quarryline.operators import embedding, integrity

SAME = "c8687a08aa5d6ed2044328fa6a697ab8e96dc34291e8c2034ae8c38e6fcc6d65"


def test_hash_ignores_whitespace(spark):
    rows = spark.createDataFrame([("  a \n\t b ",), ("a b",)], "t string").select(content_hash(F.col("t"))).collect()
    assert [r[0] for r in rows] == [SAME, SAME]


def test_backfill_keeps_known_hashes(spark):
    rows = spark.createDataFrame([("a b", None), ("a b", "old")], "content string, content_hash string")
    assert [r["content_hash"] for r in integrity.backfill_hash(rows).collect()] == [SAME, "old"]


def test_first_duplicate_stays(spark):
    rows = [("d", "x", 0), ("d", "x", 3), ("d", "y", 1), ("e", "x", 0), ("d", None, 5), ("d", None, 6)]
    df = spark.createDataFrame(rows, "document_id string, content_hash string, chunk_index int").withColumn("id", F.lit("i"))
    for parts in (1, 4):
        kept = integrity.drop_duplicates(df.repartition(parts)).drop("id").collect()
        assert sorted(map(str, map(tuple, kept))) == sorted(str(r) for r in rows if r != ("d", "x", 3))


def test_report(spark):
    rows = [
        ("1", "d", 0, "t", "h", [1.0]),
        ("2", "d", 0, None, "h", [1.0]),
        ("3", "gone", 1, "t", None, None),
        ("4", "gone", 2, "t", None, [1.0]),
        ("5", None, 1, "t", "h", [1.0]),
    ]
    chunks = spark.createDataFrame(
        rows, "id string, document_id string, chunk_index int, content string, content_hash string, embedding array<double>"
    )
    found = integrity.integrity_report(chunks, spark.createDataFrame([("d",)], "id string")).collect()
    assert sorted(map(tuple, found)) == [
        ("null", "content", 1),
        ("null", "document_id", 1),
        ("null", "embedding", 1),
        ("orphan", "gone", 2),
        ("repeated_hash", "d|h", 2),
        ("repeated_index", "d|0", 2),
    ]


def test_embedding_checks(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0]), (3, None)], "id int, embedding array<double>")
    assert sorted(r["id"] for r in integrity.embedding_faults(df, 2).collect()) == [2, 3]
    with pytest.raises(Exception, match="missing embedding"):
        df.select(integrity.checked_embedding(2)).collect()
    assert len(df.where("id = 1").select(integrity.checked_embedding(2)).collect()) == 1


def test_model_batches_keep_order_and_size(spark):
    def model():
        sizes = []

        def embed(texts):
            sizes.append(len(texts))
            assert len(texts) <= 3
            return [[float(t), float(len(sizes))] for t in texts]

        return embed

    df = spark.range(10).select(F.col("id").cast("string").alias("t")).coalesce(1)
    rows = embedding.embed_with(df, "t", model, batch_size=3).collect()
    assert [r["embedding"][0] for r in rows] == [float(r["t"]) for r in rows]
    assert [r["embedding"][1] for r in rows] == [1, 1, 1, 2, 2, 2, 3, 3, 3, 4]


def test_model_must_return_one_vector_per_text(spark):
    df = spark.createDataFrame([("a",), ("b",)], "t string").coalesce(1)
    with pytest.raises(Exception, match="1 vectors for 2 texts"):
        embedding.embed_with(df, "t", lambda: lambda texts: [[1.0]]).collect()


def test_hash_embedding(spark):
    df = spark.createDataFrame([("Cat cat, dog",), ("--",)], "t string")
    cat_dog, nothing = [r["embedding"] for r in embedding.hash_embed(df, "t", 16).collect()]
    assert sorted(x for x in cat_dog if x) == pytest.approx([1 / 5**0.5, 2 / 5**0.5], abs=1e-6)
    assert not any(nothing) and len(nothing) == 16


def test_repeated_query_ids_are_an_error(spark):
    queries = spark.createDataFrame([("q", "a"), ("q", "b")], "query_id string, query_text string")
    with pytest.raises(ValueError):
        embedding.embed_queries(queries, lambda df: df)


def test_integrity_report_reads_the_chunks_once(spark, tmp_path):
    rows = [("1", "d", 0, "x", "h", [1.0]), ("2", "d", 0, "y", "h", None), ("3", None, 0, "z", "h", [1.0]), ("3", None, 0, None, None, [1.0])]
    schema = "id string, document_id string, chunk_index long, content string, content_hash string, embedding array<double>"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "chunks"))
    report = integrity.integrity_report(spark.read.parquet(str(tmp_path / "chunks")), spark.createDataFrame([("e",)], "id string"))
    assert report._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert sorted(map(tuple, report.collect())) == [
        ("null", "content", 1), ("null", "document_id", 2), ("null", "embedding", 1), ("orphan", "d", 2), ("repeated_hash", "d|h", 2),
        ("repeated_index", "d|0", 2),
    ]
    assert integrity.integrity_report(spark.createDataFrame([], schema), spark.createDataFrame([], "id string")).count() == 0
