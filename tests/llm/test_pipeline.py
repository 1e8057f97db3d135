import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as pipeline
from quarryline.llm import bpe, jaccard, quality, secrets, toxicity


@pytest.fixture(scope="module")
def folder(spark, data, tmp_path_factory):
    """The smallest documents, with nulls, empty and repeated rows and columns of clashing names."""
    root = str(tmp_path_factory.mktemp("pipeline"))
    docs = spark.read.parquet(f"{data}/documents.parquet").selectExpr("*", "1 AS _score", "'t' AS _toxic", "2 AS _row", "3 AS _clean", "4 AS rep")
    first = docs.orderBy("doc_id").limit(1)
    odd = first.selectExpr("CAST(NULL AS BIGINT) AS doc_id", "CAST(NULL AS STRING) AS text", "lang", "source", "n_chars", "_score", "_toxic", "_row", "_clean", "rep")
    empty = first.selectExpr("doc_id + 100000 AS doc_id", "'' AS text", "lang", "source", "n_chars", "_score", "_toxic", "_row", "_clean", "rep")
    docs.union(first).union(odd).union(empty).coalesce(2).write.parquet(f"{root}/documents.parquet")
    spark.read.parquet(f"{data}/labels.parquet").coalesce(1).write.parquet(f"{root}/labels.parquet")
    return root


def rows(frame):
    return sorted(map(tuple, frame.collect()), key=str)


def test_stages_against_brute_force(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    columns, step, before = docs.columns, 0, docs
    for name, function in pipeline.STAGES:
        after = function(spark, before, folder)
        after.write.parquet(f"{folder}/after{step}")
        after = spark.read.parquet(f"{folder}/after{step}")
        given = before.collect()
        if step == 0:
            model = quality.train(before, labels)
            kept = [r for r in given if model.score(np.array([quality.features(r.text or "")]))[0] >= 0.7]
        elif step == 1:
            model = toxicity.train(before, labels)
            kept = [r for r in given if model.reach([r.text or ""])[0, 0] < 0.5]
        elif step == 2:
            sets = []
            for r in given:
                w = jaccard._WORD.findall((r.text or "").lower())
                sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
            group = list(range(len(given)))
            for i in range(len(given)):
                for j in range(i):
                    if sets[i] and sets[j] and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                        old, new = group[i], group[j]
                        group = [new if g == old else g for g in group]
            order = sorted(range(len(given)), key=lambda i: (given[i].doc_id is None, given[i].doc_id or 0, i))
            first = {}
            for i in order:
                first.setdefault(group[i], i)
            kept = [given[i] for i in sorted(first.values())]
        elif step == 3:
            formats = secrets.train(before)
            kept = []
            for r in given:
                text, done, out = r.text, 0, ""
                for start, _, end in formats.spans(text or "")[1]:
                    if start >= done:
                        out += text[done:start] + "[SECRET]"
                    done = max(done, end)
                masked = None if text is None else out + text[done:]
                kept.append(tuple(masked if c == "text" else len(masked) if c == "n_chars" and masked != text else r[c] for c in columns))
        if step < 4:
            assert after.columns == columns, name
            assert rows(after) == sorted(map(tuple, kept), key=str), name
            before = after
        else:
            library = Tokenizer.from_file(bpe.public_file("byte_bpe_50k.json"))
            need = {r.doc_id: len(library.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in given}
            got = {}
            for r in after.collect():
                got[r.doc_id] = got.get(r.doc_id, 0) + r.length
            assert got == need
        step += 1
    assert 0 < before.count() < docs.count()


def test_run(spark, folder):
    packed = pipeline.run(spark, folder)
    assert rows(packed.select("doc_id", "piece", "length")) == rows(spark.read.parquet(f"{folder}/after4").select("doc_id", "piece", "length"))


def test_empty(spark, folder, tmp_path):
    spark.read.parquet(f"{folder}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{folder}/labels.parquet").limit(0).write.parquet(f"{tmp_path}/labels.parquet")
    assert pipeline.run(spark, str(tmp_path)).count() == 0
