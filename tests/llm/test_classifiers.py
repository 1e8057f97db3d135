import random
import zlib

import numpy as np

from quarryline.llm import quality, toxicity


def tables(spark, n=400):
    rng = random.Random(2)
    vocabulary = ["and", "house", "river", "walk", "green", "seven", "over", "table", "light", "music"]
    docs, labels = [], []
    for i in range(n):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(20, 200))]
        bad, toxic = i % 5 == 0, i % 7 == 0
        if bad:
            words = [w.upper() + "!!" for w in words]
        for _ in range(rng.randint(1, 6) if toxic else 0):
            words.insert(rng.randrange(len(words)), rng.choice(["vile", "scum", "filth"]))
        docs.append((i, " ".join(words) + ".", 1.0, "x"))
        labels.append((i, int(not bad), int(toxic)))
    docs += [(9000, "", 1.0, ""), (9001, None, 1.0, ""), (None, "and over the table.", 1.0, ""), docs[3]]
    labels += [(9999, 1, 0), (None, 1, 1), (9000, None, None), labels[3]]
    return (
        spark.createDataFrame(docs, "doc_id long, text string, score double, quality string"),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
    )


def test_quality_on_held_out(spark):
    docs, labels = tables(spark)
    got = quality.score_documents(docs, quality.train(docs, labels)).collect()
    truth = {r.doc_id: r.quality for r in labels.collect()}
    assert len(got) == docs.count()
    held = [r for r in got if r.held_out]
    assert {r.doc_id for r in held} == {r.doc_id for r in got if zlib.crc32(("" if r.doc_id is None else str(r.doc_id)).encode()) % 4 == 2}
    assert np.mean([r.predicted == truth[r.doc_id] for r in held if truth.get(r.doc_id) is not None]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)


def test_quality_without_labels(spark):
    docs, labels = tables(spark, 20)
    model = quality.train(docs, labels.where("quality = 1"))
    assert all(r.predicted == 1 for r in quality.score_documents(docs, model).collect())
    assert quality.score_documents(docs.limit(0), model).count() == 0


def test_threshold_is_a_quantile():
    rng = np.random.default_rng(0)
    width = len(quality.features(""))
    good, bad = rng.normal(1, 1, (500, width)), rng.normal(-1, 1, (200, width))
    model = quality.fit(good, bad, 0.1)
    strength = model.strength(np.concatenate([good, bad]))
    weight = np.r_[np.full(500, 0.9 / 500), np.full(200, 0.1 / 200)]
    assert abs(weight[strength < model.threshold].sum() - 0.1) < 0.01


def test_toxicity(spark):
    docs, labels = tables(spark)
    model = toxicity.train(docs, labels)
    got = toxicity.score_documents(docs, model).collect()
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    known = [r for r in got if truth.get(r.doc_id) is not None and r.doc_id is not None]
    assert np.mean([r.toxic == truth[r.doc_id] for r in known]) > 0.98
    assert all(0 <= r.severity <= 2 and r.toxic == int(r.p_toxic >= 0.5) for r in got)
    assert all(r.toxic == 0 for r in got if r.doc_id in (9000, 9001))
    # One word less is never more severe: the weights are shared by all cuts.
    low, high = model.reach(["and vile over", "vile scum filth vile scum filth"])
    assert high[0] >= low[0] and high[1] >= low[1] and low[0] >= low[1] and high[0] >= high[1]
    assert model.cuts[0] < model.cuts[1]


def test_toxicity_without_labels(spark):
    docs, labels = tables(spark, 20)
    for some in (labels.limit(0), labels.where("toxic = 0")):
        assert all(r.toxic == 0 for r in toxicity.score_documents(docs, toxicity.train(docs, some)).collect())


def test_threshold_covers_all_labels(spark):
    """Few learning rows don't move the quantile: it is that of all labelled rows which are not held out."""
    docs, labels = tables(spark)
    known = {}
    for r in labels.collect():
        if r.doc_id is not None and r.quality is not None and zlib.crc32(str(r.doc_id).encode()) % 4 != 2:
            known.setdefault(r.doc_id, []).append(r.quality)
    share = np.mean([q == 0 for v in known.values() for q in v])
    for per_label in (10, 4000):
        model = quality.train(docs, labels, per_label)
        rows = [(float(model.strength(np.array([quality.features(r.text or "")]))[0]), q) for r in docs.collect() for q in known.get(r.doc_id, [])]
        rows.sort(key=lambda x: (x[0], -x[1]))
        n = {q: sum(x == q for _, x in rows) for q in (0, 1)}
        reached = np.cumsum([share / n[0] if q == 0 else (1 - share) / n[1] for _, q in rows])
        at = int(np.searchsorted(reached, share - 1e-12))
        assert abs(model.threshold - (rows[at][0] + rows[at + 1][0]) / 2) < 1e-9


def test_ordinal_fit_against_plain_likelihood():
    """The penalised likelihood, written down grade by grade and minimised by a descent on numeric gradients."""
    rng = np.random.default_rng(7)
    words, rows = 4, []
    for _ in range(250):
        value = rng.integers(0, 3, words) * 1.0
        level = value @ [2.0, -1.0, 0.5, 0.0] + rng.logistic()
        at = np.flatnonzero(value)
        rows.append((int(level > 1) + int(level > 3), at, value[at]))
    dense = np.zeros((len(rows), words))
    for k, (_, at, value) in enumerate(rows):
        dense[k, at] = value
    grade = np.array([g for g, _, _ in rows])
    penalty = 0.3

    def loss(theta):
        below = [1 / (1 + np.exp(dense @ theta[:words] - cut)) for cut in (theta[words], theta[words] + np.exp(theta[words + 1]))]
        share = np.where(grade == 0, below[0], np.where(grade == 1, below[1] - below[0], 1 - below[1]))
        return (-np.log(share).sum() + penalty / 2 * (theta[:words] ** 2).sum()) / len(rows)

    theta, step = np.concatenate([np.zeros(words), [0.0, 0.0]]), 1.0
    for _ in range(2000):
        slope = np.array([(loss(theta + e) - loss(theta - e)) / 2e-5 for e in 1e-5 * np.eye(words + 2)])
        while step > 1e-9 and loss(theta - step * slope) > loss(theta) - step / 2 * slope @ slope:
            step /= 2
        theta, step = theta - step * slope, step * 1.5
    weights, cuts = toxicity.fit(rows, words, penalty)
    own = np.concatenate([weights, [cuts[0], np.log(cuts[1] - cuts[0])]])
    assert loss(own) < loss(theta) + 1e-3
    assert np.abs(own[:words] - theta[:words]).max() < 0.1
