"""Explicit schemas; no source is ever inferred."""

from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


_S, _I, _D, _TS = T.StringType(), T.IntegerType(), T.DoubleType(), T.TimestampType()
_STRINGS = T.ArrayType(_S)

QUERY = _struct(
    id=_S, category=_S, difficulty=_I, text=_S, tags=_STRINGS, atoms_required=_STRINGS, gold_id=_S, challenge=_S
)
QUERY_REQUIRED = ("id", "category", "difficulty", "text")

VECTOR_HIT = _struct(
    query_id=_S, query_text=_S, run_name=_S, param_value=_I, rank=_I, dist=_D, chunk_id=_S, chunk_text=_S
)
KEYWORD_HIT = _struct(
    query_id=_S, query_text=_S, run_name=_S, param_value=_I, rank=_I, score=_D, chunk_id=_S, chunk_text=_S
)
LABELLED_VECTOR_HIT = T.StructType(VECTOR_HIT.fields + [T.StructField("relevance", _S)])
LABELLED_KEYWORD_HIT = T.StructType(KEYWORD_HIT.fields + [T.StructField("relevance", _S)])
FUSED_HIT = _struct(query_id=_S, query_text=_S, chunk_id=_S, chunk_text=_S, score=_D, rank=_I)
LABELLED_FUSED_HIT = T.StructType(FUSED_HIT.fields + [T.StructField("relevance", _S)])
RERANKED_HIT = T.StructType(
    LABELLED_FUSED_HIT.fields + [T.StructField("rerank_score", _D), T.StructField("rank_reranked", _I)]
)
TRUTH = _struct(query_id=_S, chunk_id=_S, relevance=_I)

DOCUMENTS = _struct(id=_S, title=_S, doc_metadata=_S, embedding_model=_S, created_at=_TS)
CHUNKS = _struct(
    id=_S,
    document_id=_S,
    chunk_index=T.LongType(),
    content=_S,
    content_hash=_S,
    embedding=T.ArrayType(T.FloatType()),
    chunk_metadata=_S,
    created_at=_TS,
)
# One appended row per source that a version replaces; the version of the source's last commit is the current one.
MANIFEST = _struct(source=_S, version=T.LongType(), folder=_S)

# Layouts of labelled CSV files, by name.
LABELLED = {
    "vector": LABELLED_VECTOR_HIT, "keyword": LABELLED_KEYWORD_HIT, "fused": LABELLED_FUSED_HIT, "reranked": RERANKED_HIT,
    "truth": TRUTH,
}
