"""Every operator as a query over the given tables; ``oracles`` has the same results in SQL.

Inputs are derived row by row from whole tables: documents and conversations are the corpora, benchmark texts the
queries, labels the judgements, and the mean vector of each label searches the embeddings.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarryline.functions import text as X
from quarryline.operators import (
    chunking,
    embedding,
    fusion,
    growing_cells,
    integrity,
    keyword,
    labels,
    long_documents,
    metrics,
    postings,
    rerank,
    rewrite,
    vector,
)
from quarryline.operators.scale import small_join
from quarryline.plans import ingest
from quarryline.plans.experiment import rewrite_experiment
from quarryline.session import shared_folder, stage
from quarryline.sources import files, store

DIM = 64
K = 15
CUT = 10
PARAMS = (50, 100)
PROBES = (1, 4, 10)
SOURCE = "src0"
RULE = "-" * 30
TEMPLATE = "Return {{JSON}}.\nChunks:\n{retrieved_chunks}\nQuery: '{user_query}'"

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def keep(function: Query) -> Query:
        _QUERIES[name] = function
        return function

    return keep


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


# --- inputs ---------------------------------------------------------------------------------------------------------


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """The rows of a table. Those of fewer files than cores are dealt out, as a file of one row group is read by one task."""
    return _dealt(spark.read.parquet(f"{sf}/{name}.parquet"))


def _dealt(rows: DataFrame) -> DataFrame:
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(cores) if len(rows.inputFiles()) < cores else rows


def markdown(title: Column, text: Column) -> Column:
    """Give flat prose headers, rules, fences and paragraphs: each sentence start decides by its first letter."""
    marks = {"A": "\n## A", "L": "\n### L", "E": f"\n{RULE}\nE", "O": "\n```\nO", "T": "\n\nT", "I": "\n\n### I"}
    for letter, mark in marks.items():
        text = F.replace(text, F.lit(f". {letter}"), F.lit(f".{mark}"))
    return F.concat(F.lit("## "), title, F.lit("\n"), text)


def corpus(spark: SparkSession, sf: str) -> DataFrame:
    """(doc_id, source, relative_path, text) of documents as markdown."""
    path = F.concat(F.col("doc_id").cast("string"), F.lit(".md"))
    return table(spark, sf, "documents").select(
        F.concat(F.col("source"), F.lit("::"), path).alias("doc_id"),
        "source",
        path.alias("relative_path"),
        markdown(F.col("lang"), F.col("text")).alias("text"),
    )


def turns(spark: SparkSession, sf: str) -> DataFrame:
    """Conversation turns as small markdown documents."""
    path = F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string"))
    return table(spark, sf, "conversations").select(
        F.concat(F.col("role"), F.lit("::"), path).alias("doc_id"),
        F.col("role").alias("source"),
        path.alias("relative_path"),
        markdown(F.col("role"), F.col("text")).alias("text"),
    )


def documents_as_chunks(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select(
        F.col("doc_id").cast("string").alias("chunk_id"), F.col("text").alias("chunk_text"), "source"
    )


def benchmark_queries(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "benchmark").select(
        F.concat(F.lit("bench_"), F.col("item_id").cast("string")).alias("query_id"), F.col("text").alias("query_text")
    )


def embedded_chunks(spark: SparkSession, sf: str) -> DataFrame:
    return embedding.hash_embed(documents_as_chunks(spark, sf), "chunk_text", DIM)


def embed_texts(queries: DataFrame) -> DataFrame:
    return embedding.hash_embed(queries, "query_text", DIM)


def embedded_queries(spark: SparkSession, sf: str) -> DataFrame:
    return embedding.embed_queries(benchmark_queries(spark, sf), embed_texts)


def vectors(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "embeddings").select(
        F.col("vec_id").cast("string").alias("chunk_id"), F.col("label").cast("string").alias("chunk_text"), "embedding"
    )


def label_queries(spark: SparkSession, sf: str) -> DataFrame:
    """One query per label: the mean of its vectors (6 decimals)."""
    mean = vector_to_array(Summarizer.mean(array_to_vector("embedding")))
    means = table(spark, sf, "embeddings").groupBy("label").agg(mean.alias("_mean"))
    return means.select(
        F.concat(F.lit("label_"), F.col("label").cast("string")).alias("query_id"),
        F.col("label").cast("string").alias("query_text"),
        F.transform("_mean", lambda x: F.round(x, 6)).alias("embedding"),
    )


def label_hits(spark: SparkSession, sf: str) -> DataFrame:
    """Vectors near each label mean, graded 2 for the same label, 1 for a neighbouring one, else 0."""
    hits = vector.cosine_top_k(vectors(spark, sf), label_queries(spark, sf), K)
    away = F.abs(F.col("query_text").cast("int") - F.col("chunk_text").cast("int"))
    return hits.withColumn("relevance", F.when(away == 0, 2).when(away == 1, 1).otherwise(0)).withColumn(
        "run", F.lit("label_means")
    )


def judged_lists(spark: SparkSession, sf: str) -> DataFrame:
    """All documents of a source, shortest first, with the grade of their label (null where there is none)."""
    docs = table(spark, sf, "documents")
    graded = table(spark, sf, "labels").select(
        "doc_id", (F.col("quality") * 2 + (1 - F.col("toxic"))).cast("int").alias("relevance")
    )
    return docs.join(graded, "doc_id", "left").select(
        F.col("source").alias("query_id"), F.sha2("text", 256).alias("chunk_id"), F.col("n_chars").alias("rank"), "relevance"
    )


def vector_hits(spark: SparkSession, sf: str) -> DataFrame:
    return vector.cosine_top_k(embedded_chunks(spark, sf), embedded_queries(spark, sf), K)


def keyword_hits(spark: SparkSession, sf: str) -> DataFrame:
    chunks, asked = documents_as_chunks(spark, sf), benchmark_queries(spark, sf)
    return keyword.bm25_top_k(keyword.keyword_index(chunks, asked), chunks, asked, K)


def pooled_truth(spark: SparkSession, sf: str, hits: DataFrame) -> DataFrame:
    """Labels of pooled hits, as a person would have graded them."""
    graded = table(spark, sf, "labels").select(
        F.col("doc_id").cast("string").alias("chunk_id"),
        (F.col("quality") * 2 + (1 - F.col("toxic"))).cast("string").alias("relevance"),
    )
    return labels.truth_labels(hits.join(graded, "chunk_id"))


def _hit_columns(hits: DataFrame, value: str) -> DataFrame:
    return hits.select(
        "query_id", "query_text", "run_name", "param_value", "rank", F.round(value, 6).alias(value), "chunk_id", "chunk_text"
    )


# --- sources and sinks ----------------------------------------------------------------------------------------------


@query("s1_load_corpus")
def s1(spark: SparkSession, sf: str) -> DataFrame:
    folder = shared_folder(spark)
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("source", F.monotonically_increasing_id().alias("no"), "text")
    files.write_corpus(_dealt(docs), folder)
    found = files.load_corpus(spark, folder, "corpus")
    # The text sink ends a file with a line feed.
    text = F.regexp_replace("text", r"\n\z", "")
    return found.select(
        F.regexp_extract("relative_path", "^source=([^/]+)/", 1).alias("folder"),
        (F.col("doc_id") == F.concat(F.lit("corpus::"), F.col("relative_path"))).alias("named"),
        F.sha2(text, 256).alias("text_hash"),
    )


@query("s2_read_queries")
def s2(spark: SparkSession, sf: str) -> DataFrame:
    folder = shared_folder(spark)
    asked = table(spark, sf, "benchmark").select(
        F.concat(F.lit("q"), F.col("item_id").cast("string")).alias("id"),
        F.lit("usage").alias("category"),
        F.length("text").alias("difficulty"),
        "text",
        F.lit("ignored").alias("unknown"),
    )
    # Each record is followed by a blank line, as hand-edited files have them.
    asked.select(F.concat(F.to_json(F.struct("*")), F.lit("\n"))).write.text(folder)
    return files.read_queries(spark, folder).select(
        "id", "category", "difficulty", "text", F.size("tags").alias("n_tags")
    )


def _turn_hits(spark: SparkSession, sf: str) -> DataFrame:
    conv = F.col("conv_id").cast("string")
    return table(spark, sf, "conversations").select(
        conv.alias("query_id"),
        F.concat(F.lit('he said "'), F.col("role"), F.lit('", then')).alias("query_text"),
        F.lit("exact_k15").alias("run_name"),
        F.lit(50).alias("param_value"),
        (F.col("turn") + 1).cast("int").alias("rank"),
        (F.col("turn") / 8).alias("dist"),
        F.concat_ws("-", conv, F.col("turn").cast("string")).alias("chunk_id"),
        F.concat(F.lit(' "quoted",\n\n'), F.col("text")).alias("chunk_text"),
    )


@query("s3_read_labelled")
def s3(spark: SparkSession, sf: str) -> DataFrame:
    folder = shared_folder(spark)
    graded = _turn_hits(spark, sf).withColumn("relevance", F.concat(F.col("rank").cast("string"), F.lit(".7")))
    files.write_result(graded, folder, "csv")
    return files.read_labelled(spark, folder).select(
        "query_id", "query_text", "rank", "dist", "chunk_id", "chunk_text", "relevance"
    )


@query("s3_read_fused")
def s3_fused(spark: SparkSession, sf: str) -> DataFrame:
    folder = shared_folder(spark)
    graded = _turn_hits(spark, sf).select(
        "query_id", "query_text", "chunk_id", "chunk_text", F.col("dist").alias("score"), "rank", F.lit(" 2 ").alias("relevance")
    )
    files.write_result(graded, folder, "csv")
    return files.read_labelled(spark, folder, "fused")


@query("s3_read_truth")
def s3_truth(spark: SparkSession, sf: str) -> DataFrame:
    folder = shared_folder(spark)
    files.write_result(labels.truth_labels(_labelled(spark, sf)), folder, "csv")
    return files.read_labelled(spark, folder, "truth")


@query("s4_export_for_labelling")
def s4(spark: SparkSession, sf: str) -> DataFrame:
    folder = shared_folder(spark)
    files.export_for_labelling(_turn_hits(spark, sf), folder)
    return files.read_labelled(spark, folder).select(
        "query_id", "run_name", "param_value", "rank", "chunk_id", "chunk_text",
        F.coalesce("relevance", F.lit("")).alias("relevance"),
    )


@query("s5_result_sink")
def s5(spark: SparkSession, sf: str) -> DataFrame:
    folder = shared_folder(spark)
    files.write_result(labels.truth_labels(_labelled(spark, sf)), folder)
    return spark.read.parquet(folder)


def _document_chunks(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as the chunks of their source, in document order."""
    rows = table(spark, sf, "documents").select(
        "source",
        F.col("doc_id").alias("chunk_index"),
        F.col("text").alias("content"),
        F.to_json(F.struct("lang")).alias("chunk_metadata"),
    )
    return embedding.hash_embed(rows, "content", DIM)


def _published(spark: SparkSession, sf: str) -> str:
    folder = shared_folder(spark)
    chunks = _document_chunks(spark, sf)
    store.publish(chunks, chunks.select("source"), folder, DIM, title="first", extra={"kind": "prose"})
    store.publish(chunks, chunks.select("source"), folder, DIM, title="second", extra={"kind": "prose", "n_nodes": "0"})
    return folder


@query("s6_publish")
def s6(spark: SparkSession, sf: str) -> DataFrame:
    folder = _published(spark, sf)
    owners = store.read_documents(spark, folder).select(
        F.col("id").alias("document_id"), "title", "doc_metadata"
    )
    stored = store.read_chunks(spark, folder).join(owners, "document_id")
    return stored.select(
        "id", "document_id", "source", "chunk_index", "content_hash", "chunk_metadata", "title", "doc_metadata",
        F.size("embedding").alias("dim"),
    )


@query("s6_publish_changes")
def s6_changes(spark: SparkSession, sf: str) -> DataFrame:
    """A first publish without the French documents, and a second of all: ``carried`` tells whose vectors were not made anew.

    The second model's vectors are all alike, which hashed ones of a text with words never are.
    """
    folder = shared_folder(spark)
    rows = table(spark, sf, "documents").select(
        "source", "lang", F.col("doc_id").alias("chunk_index"), F.col("text").alias("content"), F.to_json(F.struct("lang")).alias("chunk_metadata")
    )
    hashed = stage(integrity.add_content_hash(rows))
    first = embedding.hash_embed(hashed.where("lang <> 'fr'").drop("lang"), "content", DIM)
    store.publish(first, rows.select("source"), folder, DIM, embedding_model="m")
    plain = F.array_repeat(F.lit(2.0), DIM)
    known = store.with_stored_vectors(hashed.drop("lang"), folder, DIM, lambda new: new.withColumn("embedding", plain), "m")
    store.publish(known, rows.select("source"), folder, DIM, embedding_model="m")
    return store.read_chunks(spark, folder).select(
        "id", "document_id", "source", "chunk_index", "content_hash", (F.col("embedding")[0] != 2.0).alias("carried")
    )


@query("s7_snapshot")
def s7(spark: SparkSession, sf: str) -> DataFrame:
    folder = shared_folder(spark)
    chunks = _document_chunks(spark, sf)
    store.publish(chunks, chunks.select("source"), folder, DIM)
    snapshot = store.search_snapshot(store.read_chunks(spark, folder), store.read_documents(spark, folder))
    return snapshot.select("chunk_id", "source", "chunk_text")


@query("s7_snapshot_one_source")
def s7_one(spark: SparkSession, sf: str) -> DataFrame:
    folder = shared_folder(spark)
    chunks = _document_chunks(spark, sf)
    store.publish(chunks, chunks.select("source"), folder, DIM)
    snapshot = store.search_snapshot(store.read_chunks(spark, folder, SOURCE), store.read_documents(spark, folder, SOURCE), SOURCE)
    return snapshot.select("chunk_id", "source", "chunk_text")


# --- chunking -------------------------------------------------------------------------------------------------------


@query("c1_blocks")
def c1(spark: SparkSession, sf: str) -> DataFrame:
    return chunking.split_blocks(corpus(spark, sf)).select("doc_id", "block", "block_text")


@query("c2_block_topic")
def c2(spark: SparkSession, sf: str) -> DataFrame:
    blocks = chunking.split_blocks(corpus(spark, sf).unionByName(turns(spark, sf)))
    return blocks.select("doc_id", "block", chunking.block_topic(F.col("block_text")).alias("topic"))


def _sections(spark: SparkSession, sf: str) -> DataFrame:
    placed = corpus(spark, sf).unionByName(turns(spark, sf)).repartition("doc_id")
    blocks = chunking.split_blocks(placed).withColumn("topic", chunking.block_topic(F.col("block_text")))
    return chunking.split_sections(blocks)


@query("c3_sections")
def c3(spark: SparkSession, sf: str) -> DataFrame:
    return _sections(spark, sf).select("doc_id", "block", F.col("section_no").cast("int"), "h2", "h3", "section_text")


@query("c4_recursive_split")
def c4(spark: SparkSession, sf: str) -> DataFrame:
    pieces = chunking.recursive_pieces(F.col("text"), 2000, 300)
    return corpus(spark, sf).select("doc_id", F.posexplode_outer(pieces).alias("piece_no", "piece"))


@query("c4b_character_windows")
def c4b(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return chunking.character_windows(docs, "text", 2000, 300).select("doc_id", "piece_no", "piece")


@query("c5_word_windows")
def c5(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return chunking.word_windows(docs, "text", 500, 80).select("doc_id", "piece_no", "n_words", "piece")


@query("c6_section_label")
def c6(spark: SparkSession, sf: str) -> DataFrame:
    label = chunking.section_label(F.col("h2"), F.col("h3"), F.col("topic"))
    return _sections(spark, sf).select("doc_id", "block", F.col("section_no").cast("int"), label.alias("section"))


@query("c7_context_injection")
def c7(spark: SparkSession, sf: str) -> DataFrame:
    label = chunking.section_label(F.col("h2"), F.col("h3"), F.col("topic"))
    content = chunking.with_context(F.col("topic"), label, F.col("section_text"))
    return _sections(spark, sf).select("doc_id", "block", F.col("section_no").cast("int"), content.alias("content"))


@query("c8_chunk_ids")
def c8(spark: SparkSession, sf: str) -> DataFrame:
    return chunking.chunk_corpus(corpus(spark, sf), 2000, 300).select("doc_id", "doc_chunk_index", "chunk_id")


@query("c9_metadata")
def c9(spark: SparkSession, sf: str) -> DataFrame:
    """Document, header and chunk metadata of each section, merged; later layers win."""

    def layer(**entries: Column) -> Column:
        return F.create_map(*[x for key, value in entries.items() for x in (F.lit(key), value)])

    doc = layer(source=F.col("source"), H2=F.lit("from document"), topic=F.lit("from document"))
    headers = F.map_filter(layer(H2=F.col("h2"), H3=F.col("h3")), lambda _, value: value.isNotNull())
    merged = chunking.merge_metadata(doc, headers, layer(topic=F.col("topic"), block=F.col("block").cast("string")))
    sections = _sections(spark, sf).withColumn("meta", merged)
    fields = [F.col("meta")[k].alias(f"meta_{k.lower()}") for k in ("source", "H2", "H3", "topic", "block")]
    return sections.select("doc_id", F.col("section_no").cast("int"), *fields, F.size("meta").alias("n_keys"))


@query("c10_embedding_text")
def c10(spark: SparkSession, sf: str) -> DataFrame:
    shown = {k: F.col(c) for k, c in (("source", "source"), ("doc_id", "doc_id"), ("H2", "h2"), ("H3", "h3"), ("topic", "topic"))}
    text = chunking.embedding_text(F.col("section_text"), shown)
    return _sections(spark, sf).select("doc_id", "block", F.col("section_no").cast("int"), text.alias("embed_text"))


def _chunk_columns(chunks: DataFrame) -> DataFrame:
    return chunks.select("chunk_id", "doc_chunk_index", "topic", "section", "content", "embed_text", "chunk_metadata")


@query("c11_chunk_corpus")
def c11(spark: SparkSession, sf: str) -> DataFrame:
    return _chunk_columns(chunking.chunk_corpus(corpus(spark, sf), 2000, 300))


@query("c11_long_documents")
def c11_long(spark: SparkSession, sf: str) -> DataFrame:
    """The same chunks from rows of lines, which spread a document over tasks."""
    return _chunk_columns(long_documents.chunk_lines(long_documents.lines_of(corpus(spark, sf)), 2000, 300))


# --- hashing, duplicates, integrity ---------------------------------------------------------------------------------


def _chunk_table(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as the chunks of their language; the hash is missing where the document has a label."""
    known = table(spark, sf, "labels").select("doc_id", F.lit(True).alias("known"))
    rows = table(spark, sf, "documents").join(known, "doc_id", "left")
    return rows.select(
        F.col("doc_id").cast("string").alias("id"),
        F.col("lang").alias("document_id"),
        F.col("n_chars").cast("int").alias("chunk_index"),
        F.col("text").alias("content"),
        F.when(F.col("known").isNull(), X.content_hash(F.col("text"))).alias("content_hash"),
        F.when(F.col("lang") != "de", F.array(F.lit(1.0))).alias("embedding"),
    )


@query("h1_content_hash")
def h1(spark: SparkSession, sf: str) -> DataFrame:
    return integrity.add_content_hash(table(spark, sf, "documents"), "text").select("doc_id", "content_hash")


@query("h2_hash_backfill")
def h2(spark: SparkSession, sf: str) -> DataFrame:
    return integrity.backfill_hash(_chunk_table(spark, sf)).select("id", "content_hash")


@query("h3_dedup_chunks")
def h3(spark: SparkSession, sf: str) -> DataFrame:
    return integrity.drop_duplicates(_chunk_table(spark, sf)).select("id", "document_id", "chunk_index", "content_hash")


@query("h4_integrity_report")
def h4(spark: SparkSession, sf: str) -> DataFrame:
    """The document table knows every language but French."""
    owners = table(spark, sf, "documents").where("lang <> 'fr'").select(F.col("lang").alias("id")).distinct()
    return integrity.integrity_report(_chunk_table(spark, sf), owners)


@query("h5_embedding_check")
def h5(spark: SparkSession, sf: str) -> DataFrame:
    damaged = (
        F.when(F.col("label") == 0, F.lit(None)).when(F.col("label") == 1, F.slice("embedding", 1, 32)).otherwise(F.col("embedding"))
    )
    rows = table(spark, sf, "embeddings").withColumn("embedding", damaged)
    return integrity.embedding_faults(rows, DIM).select("vec_id", "label")


# --- embedding ------------------------------------------------------------------------------------------------------


def _size_model() -> embedding.Model:
    return lambda texts: [[float(len(t)), float(t.count(" "))] for t in texts]


@query("e1_model_embedding")
def e1(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    rows = embedding.embed_with(docs, "text", _size_model)
    return rows.select("doc_id", F.col("embedding")[0].cast("double").alias("e0"), F.col("embedding")[1].cast("double").alias("e1"))


@query("e1_resumed_embedding")
def e1_resumed(spark: SparkSession, sf: str) -> DataFrame:
    """A first job embeds the English documents, a second one what is left of all of them."""
    docs, folder = table(spark, sf, "documents").select("doc_id", "text", "lang"), shared_folder(spark)
    embedding.embed_once(docs.where("lang = 'en'"), "text", _size_model, folder, "size", 4)
    rows = embedding.embed_once(docs, "text", _size_model, folder, "size", 4)
    return rows.select("doc_id", F.col("embedding")[0].cast("double").alias("e0"), F.col("embedding")[1].cast("double").alias("e1"))


def _entries(rows: DataFrame, key: str) -> DataFrame:
    entries = rows.select(key, F.posexplode_outer("embedding").alias("bucket", "weight"))
    return entries.where("weight <> 0").select(key, "bucket", F.round(F.col("weight").cast("double"), 6).alias("weight"))


@query("e2_hash_embedding")
def e2(spark: SparkSession, sf: str) -> DataFrame:
    return _entries(embedded_chunks(spark, sf), "chunk_id")


@query("e3_query_embedding")
def e3(spark: SparkSession, sf: str) -> DataFrame:
    return _entries(embedded_queries(spark, sf), "query_id")


# --- retrieval ------------------------------------------------------------------------------------------------------


@query("v1_cosine_topk")
def v1(spark: SparkSession, sf: str) -> DataFrame:
    return _hit_columns(vector_hits(spark, sf), "dist")


@query("v2_parameter_sweep")
def v2(spark: SparkSession, sf: str) -> DataFrame:
    hits = vector.exact_sweep(embedded_chunks(spark, sf), embedded_queries(spark, sf), PARAMS, K)
    return _hit_columns(hits, "dist")


@query("v1_cosine_one_source")
def v1_one(spark: SparkSession, sf: str) -> DataFrame:
    return _hit_columns(vector.cosine_top_k(embedded_chunks(spark, sf), embedded_queries(spark, sf), K, SOURCE), "dist")


def _label_cells(spark: SparkSession, sf: str) -> DataFrame:
    """Hits in the cells around the mean vectors of the labels, of which there are as many as labels."""
    asked = label_queries(spark, sf)
    means = asked.orderBy(F.col("query_text").cast("int")).select("embedding").collect()
    index = vector.build_cells(vectors(spark, sf), centroids=np.array([r.embedding for r in means]))
    return vector.cell_top_k(index, asked, PROBES, K)


@query("v3_cells_topk")
def v3(spark: SparkSession, sf: str) -> DataFrame:
    return _hit_columns(_label_cells(spark, sf), "dist")


@query("v3_recall")
def v3_recall(spark: SparkSession, sf: str) -> DataFrame:
    exact = vector.cosine_top_k(vectors(spark, sf), label_queries(spark, sf), K)
    return _rounded(vector.recall(_label_cells(spark, sf), exact))


@query("v3_all_cells")
def v3_all(spark: SparkSession, sf: str) -> DataFrame:
    """Looking into every cell is exact search; the index is kept as files and read back."""
    folder = shared_folder(spark)
    vector.build_cells(vectors(spark, sf), 16).write(folder)
    index = vector.CellIndex.read(spark, folder)
    return _hit_columns(vector.cell_top_k(index, label_queries(spark, sf), (16,), K), "dist")


@query("v3_recall_target")
def v3_target(spark: SparkSession, sf: str) -> DataFrame:
    """Exact hits from the cells that each query needs, whose number depends on the data alone."""
    asked = label_queries(spark, sf)
    means = asked.orderBy(F.col("query_text").cast("int")).select("embedding").collect()
    index = vector.build_cells(vectors(spark, sf), centroids=np.array([r.embedding for r in means]))
    hits = vector.cells_to_recall(index, asked, 1.0, K)
    return _hit_columns(hits, "dist").drop("cells_read")


@query("v3_grown_cells")
def v3_grown(spark: SparkSession, sf: str) -> DataFrame:
    """Exact hits from an index that grew: built on a third of the vectors, given the rest and the first third once more."""
    everything, asked = vectors(spark, sf), label_queries(spark, sf)
    first, *rest = [everything.where(F.pmod(F.xxhash64("chunk_id"), F.lit(3)) == n) for n in range(3)]
    means = asked.orderBy(F.col("query_text").cast("int")).select("embedding").collect()
    index = vector.build_cells(first, centroids=np.array([r.embedding for r in means]))
    for part in (*rest, first):
        index = growing_cells.append(index, part)
    index = growing_cells.balance(index, most=max(1, everything.count() // (2 * len(means))))
    return _hit_columns(vector.cells_to_recall(index, asked, 1.0, K), "dist").drop("cells_read")


@query("v4_postings")
def v4(spark: SparkSession, sf: str) -> DataFrame:
    index = keyword.keyword_index(documents_as_chunks(spark, sf))
    n = index.totals.select("n_chunks").scalar()
    avg_dl = index.totals.select("avg_dl").scalar()
    return small_join(index.postings, index.token_df, ["token"], spread="chunk_id").select(
        "chunk_id", "token", "tf", "dl", "df", n.alias("n_chunks"), F.round(avg_dl, 6).alias("avg_dl")
    )


@query("v5_bm25_topk")
def v5(spark: SparkSession, sf: str) -> DataFrame:
    return _hit_columns(keyword_hits(spark, sf), "score")


@query("v5_bm25_one_source")
def v5_one(spark: SparkSession, sf: str) -> DataFrame:
    """Statistics of the whole corpus, hits of one source."""
    chunks, asked = documents_as_chunks(spark, sf), benchmark_queries(spark, sf)
    hits = keyword.bm25_top_k(keyword.keyword_index(chunks, asked), chunks, asked, K, SOURCE)
    return _hit_columns(hits, "score")


def _saved_postings(spark: SparkSession, sf: str) -> postings.Postings:
    """Postings of all documents, kept as files and read back."""
    folder = shared_folder(spark)
    made = postings.build_postings(documents_as_chunks(spark, sf), buckets=16)
    made.write(folder)
    made.drop()
    return postings.Postings.read(spark, folder)


@query("v4_postings_by_token")
def v4_by_token(spark: SparkSession, sf: str) -> DataFrame:
    index = _saved_postings(spark, sf)
    totals = index.totals.select("n_chunks", F.round("avg_dl", 6).alias("avg_dl"))
    counted = small_join(index.rows, index.tokens.select("token", "df"), ["token"])
    return counted.select(
        "chunk_id", "token", "tf", "dl", "df", totals.select("n_chunks").scalar().alias("n_chunks"), totals.select("avg_dl").scalar().alias("avg_dl")
    )


@query("v5_postings_topk")
def v5_postings(spark: SparkSession, sf: str) -> DataFrame:
    chunks, asked = documents_as_chunks(spark, sf), benchmark_queries(spark, sf)
    return _hit_columns(postings.postings_top_k(_saved_postings(spark, sf), chunks, asked, K), "score")


@query("v5_postings_one_source")
def v5_postings_one(spark: SparkSession, sf: str) -> DataFrame:
    chunks, asked = documents_as_chunks(spark, sf), benchmark_queries(spark, sf)
    return _hit_columns(postings.postings_top_k(_saved_postings(spark, sf), chunks, asked, K, SOURCE), "score")


def _hybrid(spark: SparkSession, sf: str, source: str | None) -> DataFrame:
    asked = benchmark_queries(spark, sf)
    index = keyword.keyword_index(documents_as_chunks(spark, sf), asked)
    hits = fusion.hybrid_search(embedded_chunks(spark, sf), embedded_queries(spark, sf), index, PARAMS, K, source=source)
    return _fused_columns(hits)


@query("v6_hybrid_search")
def v6(spark: SparkSession, sf: str) -> DataFrame:
    return _hybrid(spark, sf, None)


@query("v6_hybrid_one_source")
def v6_one(spark: SparkSession, sf: str) -> DataFrame:
    return _hybrid(spark, sf, SOURCE)


def _fused_columns(hits: DataFrame) -> DataFrame:
    return hits.select(
        "query_id", "query_text", "chunk_id", "chunk_text", F.round("score", 6).alias("score"), F.col("rank").cast("int")
    )


def fused_hits(spark: SparkSession, sf: str) -> DataFrame:
    """Fused hits, written once: reranking reads them twice."""
    vec, key = vector_hits(spark, sf), keyword_hits(spark, sf)
    return stage(fusion.reciprocal_rank_fusion(vec, key, rows_per_query=2 * K))


@query("v7_rrf")
def v7(spark: SparkSession, sf: str) -> DataFrame:
    """Two orders of every document of a source, by length and by id, fused; a source is a query."""
    docs = table(spark, sf, "documents").select(
        F.col("source").alias("query_id"),
        F.col("source").alias("query_text"),
        F.col("doc_id").cast("string").alias("chunk_id"),
        F.col("lang").alias("chunk_text"),
        "n_chars",
        "doc_id",
    )
    keys = fusion.KEYS
    by_length = docs.select(*keys, F.col("n_chars").alias("rank"))
    by_id = docs.select(*keys, F.col("doc_id").alias("rank"))
    return _fused_columns(fusion.reciprocal_rank_fusion(by_length, by_id, a=0.7, b=0.3))


@query("v8_rerank")
def v8(spark: SparkSession, sf: str) -> DataFrame:
    return rerank.rerank(fused_hits(spark, sf), k=CUT, queries=benchmark_queries(spark, sf)).select(
        "query_id", "chunk_id", F.col("rank").cast("int"), F.round("rerank_score", 6).alias("rerank_score"), "rank_reranked"
    )


@query("v9_context")
def v9(spark: SparkSession, sf: str) -> DataFrame:
    return rerank.retrieved_context(keyword_hits(spark, sf), 3)


# --- labels ---------------------------------------------------------------------------------------------------------


@query("l1_nearest_hits")
def l1(spark: SparkSession, sf: str) -> DataFrame:
    hits = vector.exact_sweep(vectors(spark, sf), label_queries(spark, sf), PARAMS, K)
    return _hit_columns(labels.nearest_hits(hits), "dist")


def _labelled(spark: SparkSession, sf: str) -> DataFrame:
    """One label per document copy, written the way people type them."""
    graded = table(spark, sf, "labels")
    typed = (
        F.when((F.col("quality") == 1) & (F.col("toxic") == 0), " 2.7 ")
        .when(F.col("quality") == 1, "1e0")
        .when(F.col("toxic") == 1, "bad")
        .when(F.col("quality") == 0, "-1.5")
    )
    return table(spark, sf, "documents").join(graded, "doc_id", "left").select(
        F.col("source").alias("query_id"), F.sha2("text", 256).alias("chunk_id"), typed.alias("relevance")
    )


@query("l2_truth")
def l2(spark: SparkSession, sf: str) -> DataFrame:
    return labels.truth_labels(_labelled(spark, sf))


@query("l3_repeated_labels")
def l3(spark: SparkSession, sf: str) -> DataFrame:
    return integrity.repeated_keys(_labelled(spark, sf), labels.KEYS)


@query("l4_gold_query_id")
def l4(spark: SparkSession, sf: str) -> DataFrame:
    padded = F.lpad(F.col("item_id").cast("string"), 3, "0")
    named = F.explode(F.array(
        F.concat(F.lit("parse_eval2_q"), padded, F.lit("_01")),
        F.concat(F.lit("eval2_q"), padded),
        F.concat(F.lit("parse_parse_q"), padded, F.lit("_a_b")),
    ))
    ids = table(spark, sf, "benchmark").select(named.alias("query_id"))
    return ids.select("query_id", X.gold_query_id(F.col("query_id")).alias("gold_query_id"))


@query("l5_label_join")
def l5(spark: SparkSession, sf: str) -> DataFrame:
    truth = pooled_truth(spark, sf, keyword_hits(spark, sf))
    hits = vector_hits(spark, sf).withColumn("query_id", F.concat(F.lit("parse_"), F.col("query_id"), F.lit("_01")))
    joined = labels.label_hits(hits, truth)
    return joined.select("query_id", "chunk_id", "rank", "gold_query_id", "query_id_truth", "relevance")


# --- metrics --------------------------------------------------------------------------------------------------------


def _rounded(scores: DataFrame) -> DataFrame:
    return scores.select(*[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in scores.dtypes])


@query("m1_ranked_list")
def m1(spark: SparkSession, sf: str) -> DataFrame:
    ranked = metrics.ranked_list(judged_lists(spark, sf))
    return ranked.select("query_id", "chunk_id", "relevance", F.col("rank").cast("int"))


@query("m2_dcg")
def m2(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(metrics.dcg(judged_lists(spark, sf), CUT))


@query("m3_ndcg")
def m3(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(metrics.ndcg(judged_lists(spark, sf), CUT))


@query("m4_precision")
def m4(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(metrics.precision(judged_lists(spark, sf), CUT))


@query("m5_average_precision")
def m5(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(metrics.average_precision(judged_lists(spark, sf), CUT))


@query("m6_precision_scores")
def m6(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(metrics.precision_scores(judged_lists(spark, sf), CUT))


@query("m7_summary")
def m7(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(metrics.summarize(label_hits(spark, sf), CUT))


def _run_summaries(spark: SparkSession, sf: str) -> DataFrame:
    vec, key = stage(vector_hits(spark, sf)), stage(keyword_hits(spark, sf))
    fused = stage(fusion.reciprocal_rank_fusion(vec, key, rows_per_query=2 * K))
    truth = pooled_truth(spark, sf, key)
    ranked = ("query_id", "chunk_id", "rank")
    runs = [
        hits.select(F.lit(run).alias("run"), *ranked)
        for run, hits in (("vector", vec), ("bm25", key), ("rrf", fused), ("reranked", rerank.rerank(fused, k=CUT, queries=benchmark_queries(spark, sf))))
    ]
    stacked = runs[0].unionByName(runs[1]).unionByName(runs[2]).unionByName(runs[3])
    return metrics.summarize(labels.label_hits(stacked, truth), CUT)


@query("m8_run_comparison")
def m8(spark: SparkSession, sf: str) -> DataFrame:
    summary = _run_summaries(spark, sf)
    return metrics.compare_runs(summary).unionByName(metrics.run_delta(summary, "rrf", "vector"))


@query("m8_chunker_delta")
def m8_chunkers(spark: SparkSession, sf: str) -> DataFrame:
    """The structural chunker minus the fixed one, by vector search; a chunk has the grade of its document."""
    grade = table(spark, sf, "labels").join(table(spark, sf, "documents").select("doc_id", "source"), "doc_id").select(
        F.concat(F.col("source"), F.lit("::"), F.col("doc_id").cast("string"), F.lit(".md")).alias("owner"),
        (F.col("quality") * 2 + (1 - F.col("toxic"))).cast("int").alias("relevance"),
    )
    runs = []
    for run, made in (("custom", chunking.chunk_corpus(corpus(spark, sf), 2000, 300)), ("fixed", chunking.chunk_fixed(corpus(spark, sf)))):
        chunks = stage(made.select("chunk_id", F.col("content").alias("chunk_text")))
        hits = vector.cosine_top_k(embedding.hash_embed(chunks, "chunk_text", DIM), embedded_queries(spark, sf), K)
        owner = F.regexp_replace("chunk_id", r"::\d+$", "")
        truth = hits.select("query_id", "chunk_id", owner.alias("owner")).join(grade, "owner").select("query_id", "chunk_id", "relevance")
        runs.append(labels.label_hits(hits, truth).select(F.lit(run).alias("run"), "query_id", "chunk_id", "rank", "relevance"))
    summary = metrics.summarize(runs[0].unionByName(runs[1]), CUT)
    return metrics.compare_runs(summary).unionByName(metrics.run_delta(summary, "custom", "fixed"))


# --- query rewriting ------------------------------------------------------------------------------------------------


@query("q1_prompts")
def q1(spark: SparkSession, sf: str) -> DataFrame:
    """Benchmark queries get their chunks, conversation turns have none."""
    asked = benchmark_queries(spark, sf)
    turn = table(spark, sf, "conversations").select(
        F.concat_ws("-", F.lit("turn"), F.col("conv_id"), F.col("turn")).alias("query_id"),
        F.concat(F.lit("{user_query} "), F.col("text")).alias("query_text"),
    )
    context = rerank.retrieved_context(keyword_hits(spark, sf), 3)
    return rewrite.render_prompts(asked.unionByName(turn), TEMPLATE, context).select("query_id", "prompt", "repair_prompt")


def _answers(spark: SparkSession, sf: str) -> DataFrame:
    """Each conversation turn as a model would answer it: properly, sloppily and wrongly."""
    text = F.to_json(F.struct(F.col("text").alias("refined_query")))
    inside = F.substring(text, F.lit(2), F.length(text) - 2)
    forms = {
        "plain": text,
        "full": F.concat(F.lit('{"filters":{"p":"x"},"must_not":["y"],"confidence":"0.5",'), inside, F.lit("}")),
        "boolean": F.concat(F.lit('{"confidence":true,'), inside, F.lit("}")),
        "list_filter": F.concat(F.lit('{"filters":{"p":["x"]},'), inside, F.lit("}")),
        "null_filter": F.concat(F.lit('{"filters":null,'), inside, F.lit("}")),
        "number_in_list": F.concat(F.lit('{"must_not":[1],'), inside, F.lit("}")),
        "wrong_type": F.lit('{"refined_query":5}'),
        "tail": F.concat(text, F.lit(" done")),
        "list": F.concat(F.lit("["), text, F.lit("]")),
        "two": F.concat(text, F.lit(',{"b":1}')),
        "prose": F.col("text"),
    }
    form = F.explode(F.array(*[F.struct(F.lit(k).alias("form"), v.alias("raw")) for k, v in forms.items()]))
    rows = table(spark, sf, "conversations").select(
        F.concat_ws("-", F.col("conv_id"), F.col("turn")).alias("turn_id"), F.col("text").alias("query_text"), form.alias("f")
    )
    return rows.select("turn_id", "query_text", F.col("f.form").alias("form"), F.col("f.raw").alias("raw"))


@query("q2_validate_output")
def q2(spark: SparkSession, sf: str) -> DataFrame:
    checked = rewrite.validate_output(_answers(spark, sf))
    return checked.select(
        "turn_id", "form", "valid",
        F.col("parsed.refined_query").alias("refined_query"),
        F.size("parsed.filters").alias("n_filters"),
        F.size("parsed.must_not").alias("n_must_not"),
        F.col("parsed.confidence").alias("confidence"),
    )


@query("q3_attempts")
def q3(spark: SparkSession, sf: str) -> DataFrame:
    answers = _answers(spark, sf)
    good = F.to_json(F.struct(F.concat(F.lit("again: "), F.col("query_text")).alias("refined_query")))
    tried = answers.withColumn("raw1", F.col("raw")).withColumn("raw2", F.when(F.col("form") != "prose", good))
    return rewrite.choose_attempt(tried).select(
        "turn_id", "form", "attempt", F.col("parsed.refined_query").alias("refined_query")
    )


@query("q4_substitute")
def q4(spark: SparkSession, sf: str) -> DataFrame:
    asked = benchmark_queries(spark, sf).withColumn("difficulty", F.length("query_text"))
    raw = F.to_json(F.struct(F.concat(F.lit("refined: "), F.col("query_text")).alias("refined_query")))
    tried = asked.withColumn("raw1", F.lit("no")).withColumn("raw2", raw)
    return rewrite.substitute(rewrite.choose_attempt(tried)).select("query_id", "query_text", "difficulty")


def _rewritten(spark: SparkSession, sf: str, first_hits: DataFrame) -> dict[str, DataFrame]:
    """The query set as it is, and three rewrites of it; the last one adds the best chunk found before."""
    asked = benchmark_queries(spark, sf)
    short = F.to_json(F.struct(F.regexp_replace("query_text", r"[.,]", "").alias("refined_query")))
    parsed = rewrite.choose_attempt(asked.withColumn("raw1", short).withColumn("raw2", F.lit("")))
    last = F.to_json(F.struct(F.element_at(F.split("query_text", r"\. "), -1).alias("refined_query")))
    improved = rewrite.choose_attempt(asked.withColumn("raw1", F.lit("")).withColumn("raw2", last))
    best = first_hits.where("rank = 1").select("query_id", "chunk_text")
    longer = F.to_json(F.struct(F.concat_ws(" ", "query_text", "chunk_text").alias("refined_query")))
    known = asked.join(best, "query_id", "left").withColumn("raw1", longer).withColumn("raw2", F.lit(""))
    augmented = rewrite.choose_attempt(known)
    sets = {"parsed": parsed, "improved": improved, "augmented": augmented}
    return {"unparsed": asked, **{run: rewrite.substitute(queries) for run, queries in sets.items()}}


@query("q5_rewrite_experiment")
def q5(spark: SparkSession, sf: str) -> DataFrame:
    chunks, first_hits = embedded_chunks(spark, sf), stage(keyword_hits(spark, sf))
    truth = pooled_truth(spark, sf, first_hits)
    summary = rewrite_experiment(
        _rewritten(spark, sf, first_hits), lambda asked: vector.cosine_top_k(chunks, asked, K), embed_texts, truth, CUT
    )
    return _rounded(summary)


# --- whole jobs -----------------------------------------------------------------------------------------------------


def _ingested(spark: SparkSession, sf: str, size: int, overlap: int) -> DataFrame:
    folder = shared_folder(spark)
    ingest.ingest(corpus(spark, sf), folder, DIM, lambda docs: chunking.chunk_corpus(docs, size, overlap), title="corpus")
    owners = store.read_documents(spark, folder).select(F.col("id").alias("document_id"), "doc_metadata")
    return store.read_chunks(spark, folder).join(owners, "document_id").select(
        "id", "document_id", "source", "chunk_index", "content_hash", "doc_metadata", F.size("embedding").alias("dim")
    )


@query("ingest_corpus")
def ingest_corpus(spark: SparkSession, sf: str) -> DataFrame:
    """Chunk, number, de-duplicate, embed, publish and read back the documents as markdown."""
    return _ingested(spark, sf, 2000, 300)
