"""Text embedding: a batch operator for any model, and a built-in hashing embedder that needs none."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.ml.feature import CountVectorizerModel, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarryline.functions.text import tokens
from quarryline.operators.integrity import require_unique
from quarryline.session import stage

Model = Callable[[list[str]], Sequence[Sequence[float]]]


def embed_with(
    df: DataFrame, text: str, make_model: Callable[[], Model], batch_size: int = 99, out: str = "embedding"
) -> DataFrame:
    """Add ``out`` by calling a user's model on slices of ``batch_size`` texts; the model is built once per task.

    Only the text travels to the model; all other columns stay where they are.
    """

    @F.pandas_udf(T.ArrayType(T.FloatType()))
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = make_model()
        for batch in batches:
            texts = batch.tolist()
            vectors: list[Sequence[float]] = []
            for start in range(0, len(texts), batch_size):
                part = texts[start : start + batch_size]
                answer = model(part)
                if len(answer) != len(part):
                    raise ValueError(f"the model returned {len(answer)} vectors for {len(part)} texts")
                vectors.extend(answer)
            yield pd.Series(vectors, index=batch.index, dtype=object)

    return df.withColumn(out, run(F.col(text)))


def embed_once(
    df: DataFrame,
    text: str,
    make_model: Callable[[], Model],
    folder: str,
    model: str,
    rounds: int = 16,
    batch_size: int = 99,
    out: str = "embedding",
) -> DataFrame:
    """``embed_with`` that resumes: vectors are kept in ``folder`` by content hash and ``model`` (a name), and only texts
    that have none yet go to the model, each different text once.

    The missing texts are embedded in ``rounds``, and every round is committed by itself, so a job that fails keeps what the
    rounds before it have made, and the next call goes on from there. A null text gets a null vector. Rows that share a text
    share its vector. Writers that run at the same time may both embed a text; one of the vectors is used.
    """
    spark, name = df.sparkSession, model.encode().hex()
    path, schema = f"{folder}/model={name}", "_hash string, _vector array<float>"
    keyed = df.withColumn("_hash", F.sha2(F.col(text), 256))
    texts = keyed.where(F.col(text).isNotNull()).groupBy("_hash").agg(F.first(text).alias("_text"))
    try:
        texts = texts.join(spark.read.schema(schema).parquet(path).select("_hash"), "_hash", "left_anti")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
    left = stage(texts)
    for n in range(rounds) if not left.isEmpty() else ():
        part = left.where(F.pmod(F.xxhash64("_hash"), F.lit(rounds)) == n)
        embed_with(part, "_text", make_model, batch_size, "_vector").select("_hash", "_vector").write.mode("append").parquet(path)
    try:
        known = spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        known = spark.createDataFrame([], schema)  # not a single text yet
    vectors = known.groupBy("_hash").agg(F.min("_vector").alias(out))
    return keyed.join(vectors, "_hash", "left").select(*df.columns, out)


def token_bucket(token: Column, dim: int) -> Column:
    """Bucket of a token: the first 32 bits of its MD5, modulo ``dim``."""
    return F.conv(F.substring(F.md5(token), 1, 8), 16, 10).cast("bigint") % dim


def hash_embed(df: DataFrame, text: str, dim: int = 64, out: str = "embedding") -> DataFrame:
    """Unit-length token-bucket counts as ``array<float>``; texts without tokens (and null texts) get the zero vector.

    Row-local and linear in the text: buckets become words of a fixed ``dim``-word vocabulary, which the ML count
    vectoriser turns into a vector. Nothing is shuffled.
    """
    buckets = F.transform(F.coalesce(tokens(F.col(text)), F.array()), lambda t: token_bucket(t, dim).cast("string"))
    vocabulary = [str(i) for i in range(dim)]
    counter = CountVectorizerModel.from_vocabulary(vocabulary, inputCol="_buckets", outputCol="_counts")
    unit = Normalizer(p=2.0, inputCol="_counts", outputCol="_unit")
    vectors = unit.transform(counter.transform(df.withColumn("_buckets", buckets)))
    return vectors.select(*df.columns, vector_to_array("_unit", "float32").alias(out))


def embed_queries(queries: DataFrame, embed: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Embed each query once, for all parameter values of a search; repeated ids are an error."""
    return embed(require_unique(queries, ["query_id"]))
