"""Embedding that resumes after a failure."""

import pytest

from quarryline.operators import embedding


def test_a_failed_job_is_resumed(spark, tmp_path):
    texts = [f"text {i}" for i in range(60)] + ["text 3", "text 3", "", None]
    frame = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "id long, text string, _text string").repartition(4)
    asked = spark.sparkContext.accumulator(0)

    def model(bad):
        def make():
            def run(batch):
                if bad in batch:
                    raise RuntimeError("the service is down")
                asked.add(len(batch))
                return [[float(len(t)), 1.0] for t in batch]

            return run

        return make

    folder = str(tmp_path / "vectors")
    with pytest.raises(Exception, match="the service is down"):
        embedding.embed_once(frame, "text", model("text 7"), folder, "m/1", rounds=12)
    kept = spark.read.parquet(folder).count() if (tmp_path / "vectors").exists() else 0
    assert 0 < kept < 61
    before = asked.value
    got = {r.id: r.embedding for r in embedding.embed_once(frame, "text", model("no such"), folder, "m/1", rounds=12).collect()}
    assert asked.value - before == 61 - kept  # what was committed is not asked for again
    assert got == {i: None if t is None else [float(len(t)), 1.0] for i, t in enumerate(texts)}
    before = asked.value
    again = embedding.embed_once(frame, "text", model("text 1"), folder, "m/1")
    assert again.columns == ["id", "text", "_text", "embedding"] and again.count() == 64 and asked.value == before
    embedding.embed_once(frame.where("id < 5"), "text", model("no such"), folder, "m/2", rounds=2)
    assert asked.value == before + 5  # another model has its own vectors


def test_nothing_to_embed(spark, tmp_path):
    frame = spark.createDataFrame([(1, None)], "id long, text string")
    assert embedding.embed_once(frame, "text", lambda: None, str(tmp_path / "v"), "m").first().embedding is None
