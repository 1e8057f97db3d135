"""Structure-aware chunking of documents of any size: a document is rows of lines, and its lines spread over tasks.

Lines are dealt to ranges of (document, place). What a line must know of the lines before it, i.e. its block, whether it
stands in a code fence, its last headers and the number of its section, is carried over the ranges by prefix scans (see
``scale.running``), so no task ever holds a document; the scans read a line's flags, only the last one its text. Only the text of one section is gathered, as the size split
runs through a section from its start. Chunks are numbered by the running sum of the sections' pieces.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarryline.functions import text as X
from quarryline.operators import chunking as C
from quarryline.operators.scale import in_ranges, running, running_sum
from quarryline.session import stage, unstage

_RULE = rf"^-{{30,}}{X.WHITESPACE}*$"  # a rule line by itself
_DOC = ["doc_id", "source", "relative_path"]


def lines_of(docs: DataFrame) -> DataFrame:
    """(doc_id, source, relative_path, doc, place, line) of documents with a ``text``; ``doc`` tells documents apart.

    For files, ``sources.files.load_lines`` gives the same rows without ever reading a file as a whole.
    """
    numbered = docs.select(*_DOC, F.monotonically_increasing_id().cast("string").alias("doc"), "text")
    return numbered.select(*_DOC, "doc", F.posexplode(F.split("text", "\n")).alias("place", "line")).withColumn("place", F.col("place").cast("bigint"))


def _placed(lines: DataFrame, rule: str, headers: tuple[str, str], topic_line: str) -> DataFrame:
    """The lines, staged in ranges with what each says by itself, so that scans carry flags and titles and not the text."""
    col = F.col
    at = ["place", "part"]
    # A line feed ends a line, and so do a few other characters inside it; a carriage return before one belongs to it.
    parts = F.posexplode(X.lines(F.regexp_replace("line", r"\r\z", "")))
    is_rule = col("line").rlike(rule)
    rows = lines.select(*_DOC, "doc", "place", is_rule.alias("is_rule"), parts.alias("part", "raw"))
    # A rule line is one row, whatever stands behind its dashes.
    rows = rows.where(~col("is_rule") | (col("part") == 0)).withColumn("line", X.strip(col("raw")))
    line, outside = col("line"), C.header_level(col("line"), F.lit(False), headers)
    return in_ranges(
        rows.select(
            *_DOC, "doc", *at, "is_rule", "line", (line == "").alias("blank"), C.is_fence(line).alias("fence"), outside.alias("outside"),
            F.when(outside > 0, C.header_title(line, headers)).alias("title"),
            F.when(col("raw").rlike(topic_line), X.strip(F.regexp_extract("raw", topic_line, 1))).alias("topic"),
        ),
        ["doc"], at,
    )


def _scanned(placed: DataFrame) -> DataFrame:
    """One row per line of a block, with its block, and what it needs to know of the lines before it."""
    col = F.col
    at, key = ["place", "part"], ["doc", "block"]
    rows = running(placed, ["doc"], at, sums={"block": col("is_rule").cast("int")}).where(~col("is_rule"))
    rows = running(rows, key, at, sums={"fences": col("fence").cast("int"), "filled": (~col("blank")).cast("int")})
    rows = rows.withColumn("fenced", ((col("fences") % 2) == 1) | col("fence"))
    rows = rows.withColumn("level", F.when(col("fenced"), 0).otherwise(col("outside")))
    header = F.struct("place", "part", "title")
    paragraph_end = (col("level") > 0) | (~col("fenced") & col("blank"))
    return running(
        rows, key, at, sums={"gap": paragraph_end.cast("int")},
        lasts={"last_h2": F.when(col("level") == 2, header), "last_h3": F.when(col("level") == 3, header)},
    )


def _marked(lines: DataFrame, rule: str, headers: tuple[str, str], topic_line: str = X.TOPIC_LINE) -> DataFrame:
    return _scanned(_placed(lines, rule, headers, topic_line))


def _topics(marked: DataFrame, max_lines: int) -> DataFrame:
    """(doc, block, topic): the first topic line among the first lines of a block that are not empty."""
    found = marked.where(~F.col("blank") & (F.col("filled") <= max_lines) & F.col("topic").isNotNull())
    first = found.groupBy("doc", "block").agg(F.min_by("topic", F.struct("place", "part")).alias("topic"))
    return first.select("doc", "block", F.nullif(F.col("topic"), F.lit("")).alias("topic"))


def _sections(marked: DataFrame) -> DataFrame:
    """(doc, block, section_no, h2, h3, at, section_text) and the document's columns, a row for each range that a section runs through."""
    col = F.col
    at, key = ["place", "part"], ["doc", "block"]
    h2, h3 = col("last_h2"), col("last_h3")
    place = lambda h: F.struct(h["place"], h["part"])
    below_h2 = h2.isNull() | (place(h3) > place(h2))
    body = marked.where((col("level") == 0) & (col("fenced") | ~col("blank"))).select(
        *_DOC, "doc", "block", "_range", *at, "line", "gap", h2["title"].alias("h2"), F.when(below_h2, h3["title"]).alias("h3")
    )
    body = running(body, key, at, earlier={"before": F.struct("h2", "h3", "gap")})
    before = col("before")
    starts = before.isNull() | ~before["h2"].eqNullSafe(col("h2")) | ~before["h3"].eqNullSafe(col("h3"))
    glue = F.when(starts, "").when(before["gap"] == col("gap"), "\n").otherwise("\n\n")
    body = body.withColumn("piece", F.concat(glue, "line")).withColumn("starts", starts.cast("int")).drop("before")
    body = running(body, key, at, sums={"section_no": col("starts")})
    return body.groupBy("_range", *key, "section_no").agg(
        *[F.first(c).alias(c) for c in (*_DOC, "h2", "h3")], F.min(F.struct(*at)).alias("at"), _joined(F.struct(*at, "piece"), "piece").alias("section_text")
    )


def _joined(row: Column, text: str) -> Column:
    """The texts of a group's rows, in the order of what stands before them."""
    return F.array_join(F.transform(F.array_sort(F.collect_list(row)), lambda p: p[text]), "")


def _whole(parts: DataFrame) -> DataFrame:
    """(doc, block, section_no, h2, h3, section_text) and the document's columns."""
    return parts.groupBy("doc", "block", "section_no").agg(
        *[F.first(c).alias(c) for c in (*_DOC, "h2", "h3")],
        # Blank lines at the end of a block are no text, even after a fence that nothing closes.
        F.rtrim(_joined(F.struct("at", "section_text"), "section_text"), F.lit("\n")).alias("section_text"),
    )


def chunk_lines(
    lines: DataFrame,
    size: int = 3000,
    overlap: int = 300,
    max_topic_lines: int = 12,
    inject_context: bool = True,
    rule: str = _RULE,
    topic_line: str = X.TOPIC_LINE,
    headers: tuple[str, str] = C.HEADERS,
    separators: Sequence[str] = C.SEPARATORS,
) -> DataFrame:
    """The chunks that ``chunking.chunk_corpus`` makes, from lines (doc_id, source, relative_path, doc, place, line).

    ``doc`` tells documents apart, ``place`` (BIGINT) orders the lines of one; gaps in it do no harm. ``rule`` is matched
    against single lines. The jobs run when this is called. Each step's table on disk goes when the next one
    has been written.
    """
    placed = _placed(lines, rule, headers, topic_line)
    marked = _scanned(placed)
    topic = stage(_topics(marked, max_topic_lines))
    parts = stage(_sections(marked))
    unstage(placed)
    cut = _whole(parts).withColumn("pieces", C.recursive_pieces(F.col("section_text"), size, overlap, separators))
    cut = stage(cut.drop("section_text"))
    unstage(parts)
    sizes = cut.select("doc", "block", "section_no", F.size("pieces").alias("n"))
    starts = running_sum(sizes, ["doc"], [F.col("block"), F.col("section_no")], F.col("n"), "start").drop("n")
    named = cut.join(starts.join(topic, ["doc", "block"], "left"), ["doc", "block", "section_no"])
    rows = named.select(
        *_DOC, "start", F.coalesce("topic", F.lit(C.NO_TOPIC)).alias("topic"), "h2", "h3", F.posexplode("pieces").alias("piece_no", "piece")
    )
    index = (F.col("start") + F.col("piece_no")).cast("int")
    return C._finish(rows.withColumn("doc_chunk_index", index), inject_context)
