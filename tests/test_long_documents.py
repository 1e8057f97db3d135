"""Chunking by lines gives what chunking by documents gives, whatever the ranges are."""

import random

import pytest
from pyspark.sql import functions as F

from quarryline import session
from quarryline.operators import chunking as C
from quarryline.operators import long_documents as L
from quarryline.operators.scale import in_ranges, running
from quarryline.sources import files

RULE = "-" * 30
DOC = "doc_id string, source string, relative_path string, text string"


def prose(seed, n):
    """Headers, rules, fences (some never closed), blank lines and odd line ends in any order."""
    rng = random.Random(seed)
    kinds = ["## H{}", "### T{}", "##", "####no header", RULE, RULE + "-- \t", "```", "~~~ x", "", "  ", "plain {} text", "more {}", "a b c " * 9]
    ends = ["\n"] * 9 + ["\n\n", "\r\n", "\x85", " ", "\r", "\x0b"]
    return "".join(rng.choice(kinds).format(rng.randint(0, 3)) + rng.choice(ends) for _ in range(n))


def both(spark, texts, **options):
    frame = spark.createDataFrame([(f"d{i}", "s", f"{i}.md", t) for i, t in enumerate(texts)], DOC).repartition(3)
    whole = C.chunk_corpus(frame, **options)
    return sorted(map(tuple, whole.collect())), sorted(map(tuple, L.chunk_lines(L.lines_of(frame), **options).collect()))


def test_same_as_by_documents(spark):
    texts = [prose(i, n) for i, n in enumerate([0, 1, 2, 3, 5, 8, 13, 30, 60, 200])]
    texts += ["", None, "x", "\n\n", RULE, f"{RULE}\n{RULE}", f"```\n\n\n{RULE}\nafter", "```\ncode\n\n\n\n", "## A\nx\n## A\ny\n### B\nz\n## A\nw\r\n"]
    want, got = both(spark, texts, size=60, overlap=12)
    assert got == want and len(got) > 100


def test_one_document_spreads_over_tasks(spark):
    """Most of a long document's lines meet no other task's lines; the state before them is carried."""
    text = f"## start\n{prose(1, 3000)}\n```\nfence over the rest\n" + prose(2, 500)
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        frame = spark.createDataFrame([("d", "s", "d.md", text)], DOC)
        marked = L._marked(L.lines_of(frame), L._RULE, C.HEADERS)
        per_task = [r["count"] for r in marked.groupBy("_range").count().collect()]
        want, got = both(spark, [text, "## other\ntext"], size=200, overlap=20)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(per_task) >= 8 and max(per_task) < sum(per_task) / 4
    assert got == want


def test_little_stays_on_disk(spark, tmp_path, monkeypatch):
    """The chunks wait for their reader as pieces; lines, and what was scanned on the way, are gone by then."""
    rng = random.Random(5)
    texts = ["\n".join(f"## {i}" if i % 20 == 0 else "%060x" % rng.getrandbits(240) for i in range(4000)) for _ in range(4)]
    frame = spark.createDataFrame([(f"d{i}", "s", f"{i}.md", t) for i, t in enumerate(texts)], DOC)
    monkeypatch.setattr(session, "_root", lambda _: str(tmp_path))
    chunks = L.chunk_lines(L.lines_of(frame), size=200, overlap=20)
    left = sum(f.stat().st_size for f in tmp_path.rglob("*.parquet"))
    assert left < sum(map(len, texts)) and chunks.count() > 4000


def test_files_are_read_in_splits(spark, tmp_path):
    for i in range(3):
        (tmp_path / f"{i}.md").write_bytes(prose(i, 1500).encode())
    (tmp_path / "empty.md").write_text("")
    want = C.chunk_corpus(files.load_corpus(spark, str(tmp_path), "s"), 200, 20).collect()
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        lines = files.load_lines(spark, str(tmp_path), "s")
        splits = lines.select("doc", "place.split").distinct().count()
        got = L.chunk_lines(lines, 200, 20).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert splits > 6 and sorted(map(tuple, got)) == sorted(map(tuple, want))


@pytest.mark.parametrize("parts", ["1", "7"])
def test_running(spark, parts):
    rng = random.Random(4)
    rows = [(rng.choice(["a", "a", "a", "b", None]), i, rng.choice([None, i])) for i in range(300)]
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        ranged = in_ranges(spark.createDataFrame(rows, "k string, at long, v long"), ["k"], ["at"])
        got = running(ranged, ["k"], ["at"], {"n": F.lit(1)}, {"last": F.col("v")}, {"old": F.struct("v")}).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    seen, want = {}, set()
    for k, at, v in rows:
        n, last, old = seen.get(k, (0, None, None))
        last = v if v is not None else last
        want.add((k, at, v, n + 1, last, old))
        seen[k] = (n + 1, last, (v,))
    assert {(r.k, r.at, r.v, r.n, r["last"], r.old and tuple(r.old)) for r in got} == want
