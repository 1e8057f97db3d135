import random
import re

import pytest
from pyspark.sql import functions as F

from quarryline.functions import text as X
from quarryline.operators import chunking as C

RULE = "-" * 30


def _blocks(spark, text):
    rows = C.split_blocks(spark.createDataFrame([("d", text)], "doc_id string, text string"))
    return [r["block_text"] for r in rows.orderBy("block").collect()]


@pytest.mark.parametrize(
    "text, blocks",
    [
        (f"A\n{RULE}\nB\n{'-' * 29}\nC", ["A", f"B\n{'-' * 29}\nC"]),
        (f"A\r\n{'-' * 40}\r\n\r\nB", ["A", "B"]),
        (f"x{'-' * 40}\ny", [f"x{'-' * 40}\ny"]),
        (f"A {RULE} B", [f"A {RULE} B"]),
        (f"{RULE}\n \n{RULE}", []),
    ],
)
def test_blocks(spark, text, blocks):
    assert _blocks(spark, text) == blocks


@pytest.mark.parametrize(
    "text, topic",
    [
        ("x\n\n" * 11 + "### Button", "Button"),
        ("x\n" * 12 + "### Button", "General"),
        ("#### Deep", "General"),
        ("###   \n### Real", "General"),
        ("  ###  Two words  \nrest", "Two words"),
        ("a\x85### After next line", "After next line"),
    ],
)
def test_topic(spark, text, topic):
    found = spark.createDataFrame([(text,)], "t string").select(C.block_topic(F.col("t")))
    assert found.first()[0] == topic


def _sections(spark, text):
    rows = C.split_sections(spark.createDataFrame([("d", 0, text)], "doc_id string, block int, block_text string"))
    return [(r["h2"], r["h3"], r["section_text"]) for r in rows.orderBy("section_no").collect()]


def test_sections_follow_header_paths(spark):
    text = "intro\n\n## A\none\ntwo\n\nthree\n### B\nx\n## C\ny\n#### not a header\n##nor this"
    assert _sections(spark, text) == [
        (None, None, "intro"),
        ("A", None, "one\ntwo\n\nthree"),
        ("A", "B", "x"),
        ("C", None, "y\n#### not a header\n##nor this"),
    ]


def test_sections_keep_fenced_text_and_merge_equal_paths(spark):
    text = "### T\n```\n## code\n\n  x = 1\n```\nafter\n### E\n### T\nmore"
    assert _sections(spark, text) == [(None, "T", "```\n## code\n\nx = 1\n```\nafter\n\nmore")]


def test_section_label_and_context(spark):
    rows = spark.createDataFrame(
        [(None, "Usage", "Button"), (None, "Button", "Button"), ("Core", None, "x"), ("Core", "", "x"), (None, None, "x")],
        "h2 string, h3 string, topic string",
    )
    label = C.section_label(F.col("h2"), F.col("h3"), F.col("topic"))
    assert [r[0] for r in rows.select(label).collect()] == ["Usage", "Overview", "Core", "Core", "Overview"]
    text = spark.range(1).select(C.with_context(F.lit("T"), F.lit("S"), F.lit("c"))).first()[0]
    assert text == "Topic: T\nSection: S\n\nc"


def test_size_pieces_cover_the_text_in_order():
    rng = random.Random(3)
    for _ in range(300):
        letters = map(chr, range(0x4E00, 0x9FFF))  # every letter once, so that a piece has one place in the text
        words = ["".join(next(letters) for _ in range(rng.randint(1, 30))) for _ in range(rng.randint(0, 60))]
        text = "".join(w + rng.choice([" ", " ", "\n\n", ""]) for w in words)
        size = rng.randint(5, 80)
        overlap = rng.randint(0, size - 1)
        pieces = C.stripped_pieces(text, size, overlap, C.SEPARATORS)
        assert all(0 < len(p) <= size for p in pieces)
        # Every piece occurs in the text, starts do not go back, and nothing but blanks lies between two pieces.
        end = start = 0
        for piece in pieces:
            at = text.find(piece, start)
            assert at >= 0 and text[end:at].strip() == ""
            start, end = at, max(end, at + len(piece))
        assert text[end:].strip() == ""


def test_size_pieces_examples():
    split = C.stripped_pieces
    assert split("short", 10, 2, C.SEPARATORS) == ["short"]
    assert split("aa bb cc dd", 5, 0, C.SEPARATORS) == ["aa bb", "cc dd"]
    assert split("aa bb cc dd", 5, 2, C.SEPARATORS) == ["aa bb", "bb cc", "cc dd"]
    assert split("abcdefgh", 4, 1, C.SEPARATORS) == ["abcd", "defg", "gh"]
    assert split("one\n\nabcdefgh ij", 4, 0, C.SEPARATORS) == ["one", "abcd", "efgh", "ij"]


def test_character_windows(spark):
    for n, pieces in ((3701, 3), (5400, 3), (5401, 4), (416, 1), (0, 1)):
        rows = C.character_windows(spark.createDataFrame([("x" * n,)], "t string"), "t", 2000, 300).collect()
        assert len(rows) == pieces
    rows = C.character_windows(spark.createDataFrame([("0123456789",)], "t string"), "t", 5, 2).orderBy("piece_no")
    assert [r["piece"] for r in rows.collect()] == ["01234", "34567", "6789"]
    rng = random.Random(5)
    for _ in range(8):
        text = "".join(rng.choices("a\n\U0001f600é", k=rng.randint(0, 60)))
        size = rng.randint(1, 12)
        overlap = rng.randint(0, size - 1)
        found = C.character_windows(spark.createDataFrame([(text,)], "t string"), "t", size, overlap).orderBy("piece_no")
        starts = range(0, max(len(text) - overlap, 1), size - overlap)
        assert [r["piece"] for r in found.collect()] == [text[i : i + size] for i in starts]
    with pytest.raises(ValueError):
        C.character_windows(spark.createDataFrame([("x",)], "t string"), "t", 5, 5)


def test_word_windows(spark):
    text = " ".join(str(i) for i in range(10)) + "\n"
    rows = C.word_windows(spark.createDataFrame([(text,), (" ",)], "t string"), "t", 4, 1).orderBy("piece_no").collect()
    assert [r["piece"] for r in rows] == ["0 1 2 3", "3 4 5 6", "6 7 8 9"]


def test_metadata_later_layers_win(spark):
    def layer(**kw):
        return F.create_map(*[F.lit(x) for pair in kw.items() for x in pair])

    merged = C.merge_metadata(layer(a="1", b="1"), layer(b="2", c="2"), layer(c="3"))
    assert spark.range(1).select(merged).first()[0] == {"a": "1", "b": "2", "c": "3"}


DOC = f"## Core\nintro text\n### Button\nUse it.\n\nMore of it.\n{RULE}\n### Input\n### Props\nvalue"


def test_chunk_corpus(spark):
    docs = spark.createDataFrame([("s::a.md", "s", "a.md", DOC)], "doc_id string, source string, relative_path string, text string")
    rows = C.chunk_corpus(docs).orderBy("doc_chunk_index").collect()
    assert [r["chunk_id"] for r in rows] == ["s::a.md::00000", "s::a.md::00001", "s::a.md::00002"]
    assert [r["content"] for r in rows] == [
        "Topic: Button\nSection: Core\n\nintro text",
        "Topic: Button\nSection: Overview\n\nUse it.\n\nMore of it.",
        "Topic: Input\nSection: Props\n\nvalue",
    ]
    assert rows[1]["embed_text"].startswith("source: s\nrelative_path: a.md\ndoc_id: s::a.md\nH2: Core\nH3: Button\n\nTopic:")
    assert '"H3":"Props"' in rows[2]["chunk_metadata"] and '"H2"' not in rows[2]["chunk_metadata"]
    small = C.chunk_corpus(docs, 12, 0, inject_context=False).orderBy("doc_chunk_index")
    assert [r["content"] for r in small.collect()] == ["intro text", "Use it.", "More of it.", "value"]


def test_chunk_corpus_shuffles_the_text_once(spark):
    docs = spark.createDataFrame([("s::a.md", "s", "a.md", DOC)], "doc_id string, source string, relative_path string, text string")
    plan = C.chunk_corpus(docs)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"\+- Exchange", plan)) == 1


def test_chunk_fixed(spark):
    docs = spark.createDataFrame([("s::a.md", "s", "a.md", "a b c d e")], "doc_id string, source string, relative_path string, text string")
    rows = C.chunk_fixed(docs, 3, 1).orderBy("doc_chunk_index").collect()
    assert [(r["chunk_id"], r["content"]) for r in rows] == [("s::a.md::00000", "a b c"), ("s::a.md::00001", "c d e")]


def test_text_rules_match_python(spark):
    blanks = ["\x1c", "\x1f", "\x85", "\xa0", " ", " ", " ", " ", "　", "\t", "\r\n"]
    texts = [f"{a}x{b}{a}y{b}" for a in blanks for b in blanks] + ["​x", "﻿x "]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    found = rows.select("t", X.strip(F.col("t")).alias("s"), X.collapse(F.col("t")).alias("c")).collect()
    for r in found:
        assert r["s"] == r["t"].strip()
        assert r["c"] == re.sub(r"\s+", " ", r["t"]).strip()
    lines = rows.select("t", X.lines(F.col("t")).alias("l")).collect()
    for r in lines:
        assert [x for x in r["l"] if x] == [x for x in r["t"].splitlines() if x]


def test_documents_without_an_id_or_with_equal_ids_stay_apart(spark):
    schema = "doc_id string, source string, relative_path string, text string"
    texts = ["## A\nalpha one\n\nalpha two", "## B\nbeta one\n\nbeta two"]
    pairs = {"no ids": [(None, "s"), (None, "s")], "two sources": [("d", "s"), ("d", "t")], "one source": [("d", "s"), ("d", "s")]}
    for ids in pairs.values():
        docs = spark.createDataFrame([(i, s, "p", t) for (i, s), t in zip(ids, texts)], schema).repartition(2)
        rows = C.chunk_corpus(docs, inject_context=False).collect()
        assert sorted((r["doc_id"] or "", r["source"], r["section"], r["content"]) for r in rows) == sorted(
            (i or "", s, t[3], t[5:]) for (i, s), t in zip(ids, texts)
        )
        assert {r["chunk_id"] for r in rows} == {f"{ids[0][0] or 'doc'}::00000"}


def test_patterns_and_headers_are_parameters(spark):
    docs = spark.createDataFrame([("d", "s", "p", "= Top\none\n****\n== Sub\ntwo")], "doc_id string, source string, relative_path string, text string")
    rows = C.chunk_corpus(docs, inject_context=False, rule=r"(?m)^\*{4}$", topic_line=r"^==\s+(.+)$", headers=("=", "==")).collect()
    assert sorted((r["topic"], r["section"], r["content"]) for r in rows) == [("General", "Top", "one"), ("Sub", "Overview", "two")]


def test_size_split_is_given_few_bytes_at_a_time(spark):
    """3,000 texts of 20,000 characters are 60 MB, fewer rows than an Arrow batch takes."""
    split = C.recursive_pieces(F.col("text"))
    docs = spark.range(0, 3000, 1, 1).select("id", F.repeat(F.lit("word "), F.lit(4000)).alias("text"))
    held = F.pandas_udf(lambda texts: texts.map(len) * 0 + texts.map(len).sum(), "long")
    assert docs.select(held("text").alias("n")).agg(F.max("n")).first()[0] < 8 << 20
    assert docs.select(F.size(split).alias("n")).agg(F.min("n"), F.max("n")).first() == (8, 8)


def test_chunking_a_corpus_bounds_the_batches_too(spark):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.conf.unset(key)
    C.chunk_corpus(spark.createDataFrame([("s::a", "s", "a", "text")], "doc_id string, source string, relative_path string, text string"))
    assert int(spark.conf.get(key)) <= 8 << 20
    spark.conf.set(key, "1m")
    C.recursive_pieces(F.col("text"))
    assert spark.conf.get(key) == "1m"  # a bound that is set already stays
    spark.conf.unset(key)
