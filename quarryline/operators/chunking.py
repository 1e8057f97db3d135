"""Structure-aware and fixed-size chunking of documents.

``chunk_corpus`` shuffles the corpus text once, by a number of the row; every window and grouping after that has it among
its keys and reuses that partitioning. No key is larger than one document, and documents that share an id or have none
stay apart.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarryline.functions import text as X
from quarryline.session import bound_batches

NO_TOPIC, NO_SECTION = "General", "Overview"  # fixed values
HEADERS = ("##", "###")  # fixed values, outer and inner
SEPARATORS = ("\n\n", " ", "")  # fixed values, coarse to fine
# Metadata keys that are stored but not shown to the embedding model.
NOT_EMBEDDED = ("topic", "section", "chunk_id", "chunk_index", "document_id")


def split_blocks(docs: DataFrame, text: str = "text", rule: str = X.RULE_LINE) -> DataFrame:
    """One row per non-empty block between rule lines (30 or more dashes): adds ``block`` and ``block_text``."""
    pieces = F.transform(F.split(F.col(text), rule), X.strip)
    kept = F.filter(pieces, lambda b: b != "")
    others = [c for c in docs.columns if c != text]
    # The outer form keeps Spark from evaluating the split twice just to drop empty arrays.
    exploded = docs.select(*others, F.posexplode_outer(kept).alias("block", "block_text"))
    return exploded.where(F.col("block").isNotNull())


def block_topic(block_text: Column, max_lines: int = 12, topic_line: str = X.TOPIC_LINE) -> Column:
    """Title of the first level-3 header among the first ``max_lines`` non-empty lines."""
    non_empty = F.filter(X.lines(block_text), lambda line: X.strip(line) != "")
    headers = F.filter(F.slice(non_empty, 1, max_lines), lambda line: line.rlike(topic_line))
    title = X.strip(F.regexp_extract(F.get(headers, F.lit(0)), topic_line, 1))
    return F.coalesce(F.nullif(title, F.lit("")), F.lit(NO_TOPIC))


def is_fence(line: Column) -> Column:
    return line.startswith("```") | line.startswith("~~~")


def fenced(line: Column, fences: Column) -> Column:
    """After an odd number of fence lines (``fences`` counts them up to and with this one), or a fence line itself."""
    return ((fences % 2) == 1) | is_fence(line)


def header_level(line: Column, in_fence: Column, headers: tuple[str, str]) -> Column:
    outer, inner = (rf"^{re.escape(mark)}(\s|$)" for mark in headers)
    return F.when(in_fence, 0).when(line.rlike(inner), 3).when(line.rlike(outer), 2).otherwise(0)


def header_title(line: Column, headers: tuple[str, str]) -> Column:
    marks = "^(?:" + "|".join(re.escape(m) for m in sorted(headers, key=len, reverse=True)) + ")"
    return X.strip(F.regexp_replace(line, marks, ""))


def split_sections(
    blocks: DataFrame, keys: Sequence[str] = ("doc_id", "block"), headers: tuple[str, str] = HEADERS
) -> DataFrame:
    """Split blocks at ``##`` and ``###`` headers: adds ``section_no``, ``h2``, ``h3``, ``section_text``.

    Header lines are removed and become the path of the text below them; headers inside code fences are text.
    A level-2 header ends the current level-3 one, neighbouring text with the same path is one section, and
    sections without text vanish. Lines are stripped; paragraphs are joined by one blank line.
    """
    keys = list(keys)
    carried = [c for c in blocks.columns if c not in (*keys, "block_text")]
    in_block = Window.partitionBy(*keys).orderBy("line_no")
    so_far = in_block.rowsBetween(Window.unboundedPreceding, 0)
    col, line = F.col, F.col("line")

    rows = blocks.select(*keys, *carried, F.posexplode(X.lines(col("block_text"))).alias("line_no", "raw"))
    rows = rows.select(*keys, *carried, "line_no", X.strip(col("raw")).alias("line"))
    rows = rows.withColumn("fences", F.sum(is_fence(line).cast("int")).over(so_far))
    rows = rows.withColumn("fenced", fenced(line, col("fences")))
    rows = rows.withColumn("level", header_level(line, col("fenced"), headers))

    header = F.struct("line_no", header_title(line, headers).alias("title"))
    paragraph_end = (col("level") > 0) | (~col("fenced") & (line == ""))
    rows = rows.select(
        "*",
        F.last(F.when(col("level") == 2, header), ignorenulls=True).over(so_far).alias("last_h2"),
        F.last(F.when(col("level") == 3, header), ignorenulls=True).over(so_far).alias("last_h3"),
        F.sum(paragraph_end.cast("int")).over(so_far).alias("gap"),
    )
    below_h2 = col("last_h2").isNull() | (col("last_h3.line_no") > col("last_h2.line_no"))
    body = rows.where((col("level") == 0) & (col("fenced") | (line != ""))).select(
        *keys, *carried, "line_no", "line", "gap",
        col("last_h2.title").alias("h2"), F.when(below_h2, col("last_h3.title")).alias("h3"),
    )
    path = F.struct("h2", "h3")
    body = body.withColumn("before", F.lag(F.struct(path.alias("path"), col("gap").alias("gap"))).over(in_block))
    starts = col("before").isNull() | ~col("before.path").eqNullSafe(path)
    glue = F.when(starts, "").when(col("before.gap") == col("gap"), "\n").otherwise("\n\n")
    body = body.withColumn("section_no", F.sum(starts.cast("int")).over(so_far) - 1).withColumn(
        "piece", F.concat(glue, line)
    )
    ordered = F.array_sort(F.collect_list(F.struct("line_no", "piece")))
    return body.groupBy(*keys, "section_no").agg(
        *[F.first(c).alias(c) for c in (*carried, "h2", "h3")],
        F.array_join(F.transform(ordered, lambda p: p["piece"]), "").alias("section_text"),
    )


def size_pieces(text: str, size: int, overlap: int, separators: Sequence[str]) -> list[str]:
    """Pack the pieces between separators greedily; only a piece above ``size`` goes on to a finer separator.

    A new pack starts with the last pieces of the one before, as many as fit into ``overlap`` characters.
    """
    if len(text) <= size:
        return [text]
    at, sep = next((i, s) for i, s in enumerate(separators) if s in text)
    if sep == "":
        return [text[i : i + size] for i in range(0, max(len(text) - overlap, 1), size - overlap)]
    out: list[str] = []
    pack: deque[str] = deque()
    used = 0  # length of the pack with one separator after each piece
    for piece in text.split(sep):
        need = len(piece)
        if pack and used + need > size:
            out.append(sep.join(pack))
            while pack and (need > size or used - len(sep) > overlap or used + need > size):
                used -= len(pack.popleft()) + len(sep)
        if need > size:
            out += size_pieces(piece, size, overlap, separators[at + 1 :])
        else:
            pack.append(piece)
            used += need + len(sep)
    if pack:
        out.append(sep.join(pack))
    return out


def stripped_pieces(text: str, size: int, overlap: int, separators: Sequence[str]) -> list[str]:
    return [p for p in (x.strip() for x in size_pieces(text, size, overlap, separators)) if p]


def _check_size(size: int, overlap: int, separators: Sequence[str]) -> None:
    if not 0 <= overlap < size:
        raise ValueError("overlap must be at least 0 and below size")
    if separators[-1] != "":
        raise ValueError("the empty separator must be the last resort")


def recursive_pieces(
    text: Column, size: int = 3000, overlap: int = 300, separators: Sequence[str] = SEPARATORS
) -> Column:
    """Size split of a text column into ``array<string>``, in Arrow batches; sequential inside one text only."""
    _check_size(size, overlap, separators)
    bound_batches(SparkSession.active())

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def split(texts: pd.Series) -> pd.Series:
        return texts.map(lambda text: stripped_pieces(text, size, overlap, separators), na_action="ignore")

    return split(text)


def recursive_pieces_of_each(texts: Column, size: int, overlap: int, separators: Sequence[str] = SEPARATORS) -> Column:
    """``recursive_pieces`` of every text of an array: ``array<array<string>>``."""
    _check_size(size, overlap, separators)
    bound_batches(SparkSession.active())

    @F.pandas_udf(T.ArrayType(T.ArrayType(T.StringType())))
    def split(lists: pd.Series) -> pd.Series:
        return lists.map(lambda one: [stripped_pieces(text, size, overlap, separators) for text in one])

    return split(texts)


def character_windows(df: DataFrame, text: str, size: int, overlap: int) -> DataFrame:
    """Fixed character windows: adds ``piece_no`` and ``piece`` in place of the text.

    The text is cut once into steps and a window joins the few steps it covers, which is linear in the text; taking
    substrings of the whole text would walk it from the start for every window.
    """
    starts = X.window_starts(F.length(text), size, overlap)
    step = size - overlap
    steps = F.regexp_extract_all(F.col(text), F.lit(f"(?s).{{1,{step}}}"), F.lit(0))
    others = [c for c in df.columns if c != text]
    cut = df.select(*others, starts.alias("_starts"), steps.alias("_steps"))
    covered = -(-size // step)

    def window(start: Column) -> Column:
        first = (start / step).cast("int") + 1
        return F.substring(F.array_join(F.slice("_steps", first, F.lit(covered)), ""), 1, size)

    return cut.select(*others, F.posexplode_outer(F.transform("_starts", window)).alias("piece_no", "piece")).where(
        F.col("piece_no").isNotNull()
    )


def word_windows(df: DataFrame, text: str, size: int = 500, overlap: int = 80) -> DataFrame:
    """Fixed windows of whitespace words joined by one space: adds ``piece_no``, ``n_words`` and ``piece``."""
    others = [c for c in df.columns if c != text]
    split = df.select(*others, X.words(F.col(text)).alias("_words"))
    windows = F.transform(
        X.window_starts(F.size("_words"), size, overlap), lambda i: F.slice("_words", i + 1, F.lit(size))
    )
    rows = split.select(*others, F.posexplode_outer(windows).alias("piece_no", "_window"))
    return rows.where(F.size("_window") > 0).select(
        *others, "piece_no", F.size("_window").alias("n_words"), F.array_join("_window", " ").alias("piece")
    )


def section_label(h2: Column, h3: Column, topic: Column) -> Column:
    """Level-3 title, else level-2 title, unless it only repeats the topic."""
    empty = F.lit("")
    label = F.coalesce(F.nullif(h3, empty), F.nullif(h2, empty), F.lit(NO_SECTION))
    return F.when(label == topic, NO_SECTION).otherwise(label)


def with_context(topic: Column, section: Column, content: Column) -> Column:
    return F.concat(F.lit("Topic: "), topic, F.lit("\nSection: "), section, F.lit("\n\n"), content)


def chunk_name(doc_id: Column, index: Column) -> Column:
    return F.format_string("%s::%05d", F.coalesce(doc_id, F.lit("doc")), index)


def merge_metadata(*layers: Column) -> Column:
    """Merge string maps; a later layer wins. Needs no change of the session's duplicate-key policy."""

    def over(old: Column, new: Column) -> Column:
        return F.map_concat(F.map_filter(old, lambda key, _: ~F.map_contains_key(new, key)), new)

    return reduce(over, layers)


def embedding_text(content: Column, metadata: dict[str, Column]) -> Column:
    """``key: value`` lines of the metadata shown to the embedding model, a blank line, the content."""
    shown = [
        F.when(value.isNotNull(), F.concat(F.lit(f"{key}: "), value))
        for key, value in metadata.items()
        if key not in NOT_EMBEDDED
    ]
    header = F.concat_ws("\n", *shown)
    return F.when(header == "", content).otherwise(F.concat(header, F.lit("\n\n"), content))


def _finish(pieces: DataFrame, inject_context: bool) -> DataFrame:
    """From (doc_id, source, relative_path, doc_chunk_index, topic, h2, h3, piece) to chunk rows."""
    col = F.col
    rows = pieces.withColumn("section", section_label(col("h2"), col("h3"), col("topic")))
    content = with_context(col("topic"), col("section"), col("piece")) if inject_context else col("piece")
    rows = rows.withColumn("content", content)
    rows = rows.withColumn("chunk_id", chunk_name(col("doc_id"), col("doc_chunk_index")))
    doc = {"source": col("source"), "relative_path": col("relative_path"), "doc_id": col("doc_id")}
    headers = {"H2": col("h2"), "H3": col("h3")}
    ours = {
        "document_id": col("doc_id"),
        "chunk_index": col("doc_chunk_index").cast("string"),
        "chunk_id": col("chunk_id"),
        "topic": col("topic"),
        "section": col("section"),
    }

    def as_map(entries: dict[str, Column]) -> Column:
        return F.create_map(*[x for key, value in entries.items() for x in (F.lit(key), value)])

    present = F.map_filter(as_map(headers), lambda _, value: value.isNotNull())
    return rows.select(
        "doc_id",
        "source",
        "relative_path",
        "doc_chunk_index",
        "chunk_id",
        "topic",
        "section",
        "content",
        embedding_text(col("content"), {**doc, **headers, **ours}).alias("embed_text"),
        F.to_json(merge_metadata(as_map(doc), present, as_map(ours))).alias("chunk_metadata"),
    )


def chunk_corpus(
    docs: DataFrame,
    size: int = 3000,
    overlap: int = 300,
    max_topic_lines: int = 12,
    inject_context: bool = True,
    rule: str = X.RULE_LINE,
    topic_line: str = X.TOPIC_LINE,
    headers: tuple[str, str] = HEADERS,
    separators: Sequence[str] = SEPARATORS,
) -> DataFrame:
    """A document is one row and is chunked in one task; ``long_documents.chunk_lines`` spreads documents of any size.

    Blocks, topics, header sections, size split, labels, ids and metadata for (doc_id, source, relative_path, text).

    ``rule`` and ``topic_line`` are patterns of a rule line and of a topic line (its first group is the title),
    ``headers`` the marks of the outer and the inner header.
    """
    # The number is fixed by the shuffle that follows; nothing is grouped by the user's id.
    numbered = docs.select("doc_id", "source", "relative_path", "text", F.monotonically_increasing_id().alias("_row"))
    blocks = split_blocks(numbered.repartition("_row"), rule=rule)
    blocks = blocks.withColumn("topic", block_topic(F.col("block_text"), max_topic_lines, topic_line))
    sections = split_sections(blocks, ("_row", "block"), headers)
    # One row per document again (it came from one row): the position in its list of pieces numbers the chunks
    # without another shuffle, which a window after the Python step would need.
    part = F.struct("block", "section_no", "topic", "h2", "h3", "section_text")
    whole = sections.groupBy("_row").agg(
        F.first("doc_id").alias("doc_id"),
        F.first("source").alias("source"),
        F.first("relative_path").alias("relative_path"),
        F.array_sort(F.collect_list(part)).alias("parts"),
    )
    texts = F.transform("parts", lambda p: p["section_text"])
    split = whole.withColumn("pieces", recursive_pieces_of_each(texts, size, overlap, separators))

    def named(p: Column, pieces: Column) -> Column:
        return F.transform(pieces, lambda x: F.struct(p["topic"].alias("topic"), p["h2"].alias("h2"), p["h3"].alias("h3"), x.alias("piece")))

    chunks = F.flatten(F.zip_with("parts", "pieces", named))
    rows = split.select("doc_id", "source", "relative_path", F.posexplode_outer(chunks).alias("doc_chunk_index", "chunk"))
    rows = rows.where(F.col("chunk").isNotNull()).select("doc_id", "source", "relative_path", "doc_chunk_index", "chunk.*")
    return _finish(rows, inject_context)


def chunk_fixed(docs: DataFrame, size: int = 500, overlap: int = 80) -> DataFrame:
    """Fixed word windows with the same output columns as ``chunk_corpus``; structure is ignored. Needs no shuffle."""
    none = F.lit(None).cast("string")
    rows = word_windows(docs.select("doc_id", "source", "relative_path", "text"), "text", size, overlap)
    return _finish(
        rows.select(
            "doc_id", "source", "relative_path", F.col("piece_no").alias("doc_chunk_index"),
            F.lit(NO_TOPIC).alias("topic"), none.alias("h2"), none.alias("h3"), "piece",
        ),
        inject_context=False,
    )
