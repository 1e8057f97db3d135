import json
import os
import time

import pytest
from pyspark.sql import functions as F

from quarryline.operators import chunking, embedding
from quarryline.plans import ingest
from quarryline.sources import files, store


def test_corpus_scan(spark, tmp_path):
    root = tmp_path / "my docs+x"
    (root / "sub dir").mkdir(parents=True)
    (root / "a.md").write_text("# A\nline\n")
    (root / "sub dir" / "b+c %41.txt").write_text("b")
    (root / "skip.py").write_text("x")
    rows = {r["relative_path"]: r for r in files.load_corpus(spark, str(root), "s").collect()}
    assert set(rows) == {"a.md", "sub dir/b+c %41.txt"}
    assert rows["a.md"]["text"] == "# A\nline\n" and rows["a.md"]["doc_id"] == "s::a.md"
    assert [r["relative_path"] for r in files.load_corpus(spark, str(root), "s", recursive=False).collect()] == ["a.md"]
    assert files.load_corpus(spark, f"file://{root}", "s", [".py"]).first()["relative_path"] == "skip.py"
    with pytest.raises(ValueError):
        files.load_corpus(spark, "relative", "s")


ODD = [("a", "x\n"), ("a", "x\n"), ("a b", ""), ("a/b=c%:[x]", "y"), ("ü {1}^'\"#*?\\\x7f\t", None), ("", "z"), (None, "\r\nü"), ("_h", "v")]


def test_written_corpus_is_that_of_the_text_sink(spark, tmp_path):
    docs = spark.createDataFrame([(s, n, t) for n, (s, t) in enumerate(ODD)], "source string, no long, text string").repartition(3)
    files.write_corpus(docs, f"file://{tmp_path}/some where %41/new")
    docs.select("source", "text").write.option("maxRecordsPerFile", 1).partitionBy("source").text(str(tmp_path / "sink"))
    got, want = (
        sorted((f.parent.name, f.read_bytes()) for f in (tmp_path / top).rglob("*.txt")) for top in ("some where %41/new", "sink")
    )
    assert got == want and len(got) == len(ODD)
    loaded = [files.load_corpus(spark, str(tmp_path / top), "s").select("text").collect() for top in ("some where %41/new", "sink")]
    assert sorted(loaded[0]) == sorted(loaded[1])
    files.write_corpus(docs, str(tmp_path / "some where %41/new"))  # a second try leaves no other files
    assert len([f for f in (tmp_path / "some where %41/new").rglob("*") if f.is_file()]) == len(ODD)
    files.write_corpus(docs.where("false"), str(tmp_path / "none"))
    assert files.load_corpus(spark, str(tmp_path / "none"), "s").isEmpty()


def test_many_small_files_are_few_tasks(spark, tmp_path):
    for i in range(80):
        (tmp_path / f"{i}.md").write_text(str(i))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")
    try:
        docs = files.load_corpus(spark, str(tmp_path), "s")
        tasks, texts = docs.rdd.getNumPartitions(), {r.text for r in docs.collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert tasks <= 16 * 4 and texts == {str(i) for i in range(80)}


def test_queries(spark, tmp_path):
    good = {"id": "q1", "category": "c", "difficulty": 2, "text": "t", "atoms_required": ["x"], "other": 1}
    path = tmp_path / "q.jsonl"
    path.write_text(json.dumps(good) + "\n\n" + json.dumps({**good, "id": "q2", "tags": ["a"], "gold_id": "g"}) + "\n")
    rows = files.read_queries(spark, str(path)).orderBy("id").collect()
    assert [(r["id"], r["tags"], r["gold_id"]) for r in rows] == [("q1", [], None), ("q2", ["a"], "g")]
    for broken in ("not json", json.dumps({**good, "text": None}), json.dumps({"id": "q"})):
        path.write_text(broken + "\n")
        with pytest.raises(Exception, match="invalid query line"):
            files.read_queries(spark, str(path)).collect()


def test_labelling_round_trip(spark, tmp_path):
    hit = ("q", 'say "hi", now', "bm25", 15, 1, 0.25, "c", ' lead\n"quoted" \\ back,slash\n\nend ')
    names = "query_id string, query_text string, run_name string, param_value int, rank int, score double, chunk_id string, chunk_text string"
    hits = spark.createDataFrame([hit], names)
    files.export_for_labelling(hits, str(tmp_path / "out"))
    row = files.read_labelled(spark, str(tmp_path / "out"), "keyword").first()
    assert tuple(row)[:8] == hit and not row["relevance"]
    text = "".join(p.read_text() for p in (tmp_path / "out").glob("*.csv"))
    assert text.startswith("query_id,query_text,run_name,param_value,rank,score,chunk_id,chunk_text,relevance\n")
    files.export_for_labelling(hits.where("false"), str(tmp_path / "none"))
    assert files.read_labelled(spark, str(tmp_path / "none"), "keyword").isEmpty()


CHUNK = "source string, chunk_index long, content string, embedding array<double>, chunk_metadata string"


def _content(spark, root, source=None):
    rows = store.read_chunks(spark, root, source).collect()
    return sorted((r["source"], r["chunk_index"], r["content"]) for r in rows)


def test_publish_replaces_a_source_and_leaves_others(spark, tmp_path):
    root = str(tmp_path)
    first = spark.createDataFrame(
        [("a", 0, "x  y", [1.0, 2.0], "{}"), ("a", 1, "x y", [1.0, 2.0], "{}"), ("b", 0, "x y", [3.0, 4.0], "{}")], CHUNK
    )
    done = store.publish(first, ["a", "b"], root, 2, title="T", extra={"n_nodes": "9", "team": "docs"})
    assert sorted((r["source"], r["n_chunks"]) for r in done.collect()) == [("a", 2), ("b", 1)]
    before = [("a", 0, "x  y"), ("b", 0, "x y")]
    assert _content(spark, root) == before
    metadata = {r["source"]: json.loads(r["doc_metadata"]) for r in store.read_documents(spark, root).collect()}
    assert metadata["a"] == {"team": "docs", "n_nodes": 2}

    store.publish(first, ["a", "b"], root, 2)
    assert _content(spark, root) == before and store.read_documents(spark, root).count() == 2
    ids = {r["id"] for r in store.read_chunks(spark, root).collect()}

    store.publish(spark.createDataFrame([("a", 5, "new", [0.0, 1.0], "{}")], CHUNK), ["a"], root, 2)
    assert _content(spark, root) == [("a", 5, "new"), ("b", 0, "x y")]
    assert {r["id"] for r in store.read_chunks(spark, root, "b").collect()} < ids

    store.publish(first.where("false"), ["a"], root, 2)
    assert _content(spark, root) == [("b", 0, "x y")]
    assert store.read_documents(spark, root, "a").count() == 1
    snapshot = store.search_snapshot(store.read_chunks(spark, root), store.read_documents(spark, root), "b")
    assert [r["chunk_text"] for r in snapshot.collect()] == ["x y"]


def test_a_failed_publish_is_invisible(spark, tmp_path):
    root = str(tmp_path)
    good = spark.createDataFrame([("a", 0, "x", [1.0, 2.0], "{}")], CHUNK)
    store.publish(good, ["a"], root, 2)
    bad = spark.createDataFrame([("a", 0, "y", [1.0], "{}"), ("a", 1, "z", [1.0, 2.0], "{}")], CHUNK)
    with pytest.raises(Exception, match="missing embedding"):
        store.publish(bad, ["a"], root, 2)
    assert _content(spark, root) == [("a", 0, "x")] and store.read_documents(spark, root).count() == 1
    store.publish(good.withColumn("content", F.lit("w")), ["a"], root, 2)
    assert _content(spark, root) == [("a", 0, "w")] and store.read_documents(spark, root).count() == 1


def _one(spark, source, *texts):
    return spark.createDataFrame([(source, i, t, [1.0, float(i)], "{}") for i, t in enumerate(texts)], CHUNK)


def test_two_writers_do_not_mix(spark, tmp_path):
    """Both write at the same time; the later commit wins as a whole, and other sources stay."""
    root = str(tmp_path)
    store.publish(_one(spark, "a", "old").union(_one(spark, "b", "kept")), ["a", "b"], root, 2)
    first = store.prepare(_one(spark, "a", "x", "y"), ["a"], root, 2)
    second = store.prepare(_one(spark, "a", "z"), ["a"], root, 2)
    assert _content(spark, root) == [("a", 0, "old"), ("b", 0, "kept")]
    assert store.commit(spark, second) == 2 and _content(spark, root) == [("a", 0, "z"), ("b", 0, "kept")]
    assert store.commit(spark, first) == 3 and _content(spark, root) == [("a", 0, "x"), ("a", 1, "y"), ("b", 0, "kept")]


def test_a_taken_number_is_tried_again(spark, tmp_path, monkeypatch):
    """Somebody commits between the look at the folder and the own commit file."""
    root = str(tmp_path)
    mine, theirs = (store.prepare(_one(spark, s, s), [s], root, 2) for s in ("mine", "theirs"))
    put, late = store._put_if_absent, []

    def slow(*args):
        if not late:
            late.append(True)
            assert store.commit(spark, theirs) == 1
        return put(*args)

    monkeypatch.setattr(store, "_put_if_absent", slow)
    assert store.commit(spark, mine, based_on=0) == 2
    assert _content(spark, root) == [("mine", 0, "mine"), ("theirs", 0, "theirs")]
    assert not [f for f in os.listdir(tmp_path / "commits") if not f.endswith((".json", ".crc"))]


def test_conflict(spark, tmp_path):
    root = str(tmp_path)
    store.publish(_one(spark, "a", "x"), ["a"], root, 2)
    base = store.last_commit(spark, root)
    mine = store.prepare(_one(spark, "a", "mine"), ["a"], root, 2)
    other = store.prepare(_one(spark, "b", "other"), ["b"], root, 2)
    store.publish(_one(spark, "a", "theirs"), ["a"], root, 2, based_on=base)
    with pytest.raises(store.PublishConflict, match="'a'"):
        store.commit(spark, mine, based_on=base)
    store.commit(spark, other, based_on=base)  # another source is no conflict
    assert _content(spark, root) == [("a", 0, "theirs"), ("b", 0, "other")]


def test_sweep(spark, tmp_path):
    root = str(tmp_path)
    folders = lambda: {(t, *p.parts[-2:]) for t in ("chunks", "documents") for p in (tmp_path / t).glob("source=*/version=*")}
    store.publish(_one(spark, "a/b c", "x").union(_one(spark, "b", "y")), ["a/b c", "b"], root, 2)
    first = folders()
    reader = store.read_chunks(spark, root)  # planned before the next publish
    store.publish(_one(spark, "a/b c", "x2"), ["a/b c"], root, 2)
    lost = store.prepare(_one(spark, "b", "never committed"), ["b"], root, 2)
    every = folders()
    assert store.sweep(spark, root, 3600) == [] and folders() == every
    assert sorted(r.content for r in reader.collect()) == ["x", "y"]
    gone = store.sweep(spark, root, 3600, now=time.time() + 7200)
    current = {f for f in first if f[1] == "source=b"} | {f for f in every - first if not f[2].endswith(str(lost.version))}
    assert len(gone) == 4 and folders() == current
    assert _content(spark, root) == [("a/b c", 0, "x2"), ("b", 0, "y")]
    assert store.read_documents(spark, root).count() == 2


def test_only_changes_are_embedded(spark, tmp_path):
    docs = lambda *rows: spark.createDataFrame([(f"{s}::{p}", s, p, t) for s, p, t in rows], "doc_id string, source string, relative_path string, text string")
    asked = spark.sparkContext.accumulator(0)

    def model():
        def run(texts):
            asked.add(len(texts))
            return [[float(len(t)), 1.0] for t in texts]

        return run

    embed = lambda df: embedding.embed_with(df, "content", model)
    chunker = lambda d: chunking.chunk_corpus(d, inject_context=False)
    go = lambda root, rows, **how: ingest.ingest(docs(*rows), root, 2, chunker, embed, **{"embedding_model": "m", "reuse": True, **how})
    before = [("s", "a", "## H\none\n## G\ntwo"), ("s", "b", "## H\none"), ("t", "a", "## H\none")]
    after = [("s", "a", "## H\none\n## G\nchanged"), ("s", "c", "## H\nthree"), ("t", "a", "## H\none")]
    go(str(tmp_path / "x"), before)
    assert asked.value == 3  # s: one, two; t: one
    go(str(tmp_path / "x"), before)
    assert asked.value == 3
    go(str(tmp_path / "x"), after)
    assert asked.value == 5
    go(str(tmp_path / "y"), after, reuse=False)
    columns = ["id", "document_id", "chunk_index", "content", "content_hash", "embedding", "chunk_metadata", "source"]
    same = [sorted(map(str, store.read_chunks(spark, str(tmp_path / r)).select(columns).collect())) for r in "xy"]
    assert same[0] == same[1]
    count = asked.value
    go(str(tmp_path / "x"), after, embedding_model="other")  # another model's vectors are not reused
    assert asked.value == count + 4


def test_snapshot_needs_a_document_with_a_source(spark):
    chunks = spark.createDataFrame([("1", "d1", "t", [1.0]), ("2", "d2", "t", [1.0]), ("3", "d3", "t", [1.0])],
                                   "id string, document_id string, content string, embedding array<double>")
    documents = spark.createDataFrame([("d1", "s"), ("d2", None)], "id string, source string")
    assert [r["chunk_id"] for r in store.search_snapshot(chunks, documents).collect()] == ["1"]
    assert store.search_snapshot(chunks, documents, "other").isEmpty()


def test_ingest_numbers_over_documents_and_drops_copies(spark, tmp_path):
    docs = spark.createDataFrame(
        [("s::a", "s", "a", "## H\none\n## G\ntwo"), ("s::b", "s", "b", "## H\none\n## K\nthree"), ("t::a", "t", "a", "## H\none")],
        "doc_id string, source string, relative_path string, text string",
    )
    for parts in (1, 3):
        root = str(tmp_path / str(parts))
        ingest.ingest(docs.repartition(parts), root, 8, lambda d: chunking.chunk_corpus(d, inject_context=False))
        assert _content(spark, root) == [("s", 0, "one"), ("s", 1, "two"), ("s", 3, "three"), ("t", 0, "one")]
        counts = {r["source"]: json.loads(r["doc_metadata"])["n_nodes"] for r in store.read_documents(spark, root).collect()}
        assert counts == {"s": 4, "t": 1}
    ingest.ingest(docs.where("source = 's'").limit(0), root, 8, sources=spark.createDataFrame([("s",)], "source string"))
    assert _content(spark, root) == [("t", 0, "one")]


def test_ingest_keeps_equal_ids_of_two_sources_apart(spark, tmp_path):
    docs = spark.createDataFrame(
        [("d", "s", "d", "## H\none"), ("d", "t", "d", "## H\ntwo"), ("d", "s", "e", "## H\nthree"), (None, "s", "f", "## H\nfour")],
        "doc_id string, source string, relative_path string, text string",
    )
    ingest.ingest(docs.repartition(3), str(tmp_path), 8, lambda d: chunking.chunk_corpus(d, inject_context=False))
    stored = store.read_chunks(spark, str(tmp_path)).collect()
    assert sorted((r["source"], r["content"]) for r in stored) == [("s", "four"), ("s", "one"), ("s", "three"), ("t", "two")]


def test_csv_layouts_are_told_apart(spark, tmp_path):
    truth = spark.createDataFrame([("q", "c", 3)], "query_id string, chunk_id string, relevance int")
    files.write_result(truth, str(tmp_path / "truth"), "csv")
    assert files.read_labelled(spark, str(tmp_path / "truth"), "truth").collect() == truth.collect()
    with pytest.raises(Exception, match="(?i)header|schema"):
        files.read_labelled(spark, str(tmp_path / "truth"), "vector").collect()
