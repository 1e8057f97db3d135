import random

import numpy as np
import pytest

from quarryline.llm import caps, jaccard, links


def smallest(edges):
    near = {}
    for a, b in edges:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    label = {}
    for start in sorted(near):
        todo = [start]
        while todo:
            x = todo.pop()
            if x not in label:
                label[x] = start
                todo += near[x]
    return label


def test_components(spark):
    rng = random.Random(0)
    edges = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(170)] + [(1000 + i, 1001 + i) for i in range(40)] + [(-5, 2000)]
    edges += [(-5, 3000 + i) for i in range(100)]
    frame = spark.createDataFrame(edges, "a long, b long")
    got = {r.id: r.component for r in links.components(frame).collect()}
    expected = smallest([(a, b) for a, b in edges if a != b])
    assert got == {k: v for k, v in expected.items() if k != v}
    assert links.components(frame.limit(0)).count() == 0


def words(rng, n):
    return [rng.choice("abcdefghij") + rng.choice("klmnop") + str(rng.randint(0, 40)) for _ in range(n)]


def corpus():
    rng = random.Random(4)
    texts = [" ".join(words(rng, rng.randint(1, 120))) for _ in range(150)]
    hot = words(rng, 150)
    for _ in range(130):  # one large group of near copies, in a chain of small changes
        hot = list(hot)
        hot[rng.randrange(len(hot))] = words(rng, 1)[0]
        texts.append(" ".join(hot))
    for text in texts[:30]:
        changed = text.split(" ")
        changed[rng.randrange(len(changed))] = "new"
        texts.append(" ".join(changed))
    texts += ["a b c d e f g " * 2000, "", None, "...", "one", "One!", "one two three", texts[3], texts[3], texts[200]]
    rows = [(i if i != 7 else None, t, "x", 1) for i, t in enumerate(texts)]
    return rows + [(5, "an id that is repeated with another text", "x", 1), rows[9], rows[9]]


def shingles(text):
    found = jaccard._WORD.findall((text or "").lower())
    return {tuple(found[i : i + 5]) for i in range(max(1, len(found) - 4))} if found else set()


def test_jaccard_against_brute_force(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string, row string, copies int").repartition(4).cache()
    got = sorted(jaccard.join(docs).collect(), key=lambda r: r.row)
    frame = docs.collect()
    assert [r.doc_id for r in got] == [r.doc_id for r in frame]
    sets = [shingles(r.text) for r in frame]
    linked = [(i, j) for i in range(len(sets)) for j in range(i) if sets[i] and sets[j] and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])]
    degree = np.zeros(len(sets), int)
    for i, j in linked:
        degree[i] += 1
        degree[j] += 1
    found = np.array([r.n_links for r in got])
    assert (found <= degree).all() and found.sum() >= 0.999 * degree.sum()
    label = smallest(linked)
    for i, r in enumerate(got):
        group = [frame[j].doc_id for j in range(len(sets)) if label.get(j, j) == label.get(i, i) and frame[j].doc_id is not None]
        assert r.class_id == (min(group) if group else None)
    assert sum(r.kept for r in got) == len({label.get(i, i) for i in range(len(sets))})
    kept = jaccard.keep_one(docs)
    assert kept.columns == docs.columns and kept.count() == sum(r.kept for r in got)
    assert jaccard.join(docs.limit(0)).count() == 0
    docs.unpersist()


def test_many_tiles(spark, monkeypatch):
    """Blocks far smaller than the group: tiles must neither lose nor repeat a pair."""
    monkeypatch.setattr(links, "BLOCK", 8)
    rows = [(i, sorted({(i // 5), 100 + i % 7, 1000})) for i in range(60)]
    reps = spark.createDataFrame([(i, 1 + i % 3, k) for i, k in rows], "rep long, copies long, keys array<long>")
    from pyspark.sql import functions as F

    payload = lambda work: work.withColumn("payload", F.col("rep").cast("string").cast("binary"))
    verify = lambda left, right: np.array([[abs(int(a) - int(b)) <= 2 for b in right] for a in left])
    got = {r.rep: (r.n_links, r.component) for r in links.link(reps, payload, verify, block=8).collect()}
    assert got == {i: (sum(1 + j % 3 for j in range(60) if j != i and abs(i - j) <= 2), 0) for i in range(60)}


def test_prefix_length():
    assert jaccard.prefix_length() == 5
    assert jaccard.prefix_length(recall=0.9) > jaccard.prefix_length(recall=0.9999)


def vectors(n, width=16):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(n, width))
    near = base[:60] + rng.normal(size=(60, width)) * 0.07
    crowd = base[0] + rng.normal(size=(140, width)) * 0.04
    all_rows = np.concatenate([base, near, crowd]).astype(np.float32).astype(float)
    rows = [(i, [float(x) for x in v], i % 3 if i < n else (i - n) % 3 if i < n + 60 else 0) for i, v in enumerate(all_rows)]
    rows += [(9000, None, 1), (9001, [0.0] * width, 1), (9002, [float("nan")] * width, 1), (9003, rows[0][1], None), (None, rows[0][1], 0)]
    return rows + [(9004, [1.0, None], 1), (9005, [], 1), (9006, [1.0, 0.0], 2), (9007, [1.0, 0.01], 2), (9008, rows[3][1], rows[3][2]), rows[3]]


def test_caps_against_brute_force(spark):
    rows = vectors(300)
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(4)
    # In few dimensions caps are met more often; fewer code words do.
    got = caps.near_duplicates(frame, words=256, rotations=8, cap=0.75).collect()
    fit = [r for r in rows if r[0] is not None and r[2] is not None and r[1] and all(x is not None and np.isfinite(x) for x in r[1]) and any(r[1])]
    unit = [np.array(r[1], np.float32).astype(float) / np.linalg.norm(np.array(r[1], np.float32).astype(float)) for r in fit]
    linked = [(i, j) for i in range(len(fit)) for j in range(i) if fit[i][2] == fit[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= 0.93]
    degree = {}
    for i, j in linked:
        degree[i] = degree.get(i, 0) + 1
        degree[j] = degree.get(j, 0) + 1
    by_id = {}
    for r in got:
        by_id[r.vec_id] = r
    assert len(got) == len(rows)
    true = {}
    for i, r in enumerate(fit):
        true[r[0]] = max(true.get(r[0], 0), degree.get(i, 0))
    assert all(by_id[i].n_links <= n for i, n in true.items())
    assert sum(by_id[i].n_links for i in true) >= 0.99 * sum(true.values()) and len(linked) > 5000
    for r in got:
        if r.vec_id is None or r.vec_id not in true:
            assert (r.n_links, r.component_id) == (0, r.vec_id)
        else:
            assert r.kept == (r.vec_id == r.component_id)
    assert caps.near_duplicates(frame.limit(0)).count() == 0


def test_caps_recall_with_production_parameters():
    """Pairs exactly at the threshold, in 64 dimensions."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(200, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z = rng.normal(size=x.shape)
    z -= (z * x).sum(axis=1, keepdims=True) * x
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    y = 0.93 * x + np.sqrt(1 - 0.93**2) * z
    code = caps.Code(64, caps.CODE_WORDS, caps.ROTATIONS)
    a, b = code.passed(x, caps.CAP), code.passed(y, caps.CAP)
    assert np.mean([bool(set(p) & set(q)) for p, q in zip(a, b)]) >= 0.98


def pairs_at_threshold(n, width):
    rng = np.random.default_rng(6)
    x, z = rng.normal(size=(2, n, width))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z -= (z * x).sum(axis=1, keepdims=True) * x
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    return x, 0.93 * x + np.sqrt(1 - 0.93**2) * z


def test_caps_recall_in_wide_vectors():
    assert caps.Code(64, 512, 2).usual_cap() == caps.CAP
    for width in (96, 128, 384):
        x, y = pairs_at_threshold(200, width)
        code = caps.Code(width, caps.CODE_WORDS, caps.ROTATIONS)
        a, b = (code.passed(v, code.usual_cap()) for v in (x, y))
        recall = np.mean([bool(set(p) & set(q)) for p, q in zip(a, b)])
        print(width, code.usual_cap(), recall, np.mean([len(p) for p in a]))
        assert recall >= 0.98


@pytest.mark.parametrize("width", [2, 3, 4, 8, 16, 24, 32, 48])
def test_caps_recall_in_narrow_vectors(width):
    """With the defaults close pairs meet, and no vector passes filters without bound."""
    x, y = pairs_at_threshold(200, width)
    code, cap = caps.code_of(width)
    a, b = (code.passed(v / np.linalg.norm(v, axis=1, keepdims=True), cap) for v in (x, y))
    recall = np.mean([not p or not q or bool(set(p) & set(q)) for p, q in zip(a, b)])  # one without filters is compared with all
    print(width, cap, recall, np.mean([len(p) for p in a]), max(map(len, a)), sum(not p for p in a))
    assert recall >= 0.9 and max(map(len, a)) < 20_000


def test_caps_vectors_without_filters(spark, monkeypatch):
    """Nothing passes a filter: every pair is found by comparison, in several blocks."""
    monkeypatch.setattr(caps, "BLOCK_BYTES", 20_000)
    x, y = pairs_at_threshold(24, 128)
    y = y + 0.05 * x  # clear of the threshold
    rows = [(2 * i + k, v[i].tolist(), i % 2) for i in range(24) for k, v in enumerate((x, y))]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(3)
    got = caps.near_duplicates(frame, words=16, rotations=1, cap=0.9).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got) == [(i, 1, i - i % 2) for i in range(48)]


def test_long_words_by_position(spark):
    """Blocks of 64 bytes that change places make another word."""
    a, b = "x" * 64 + "y" * 64, "y" * 64 + "x" * 64
    texts = [f"{a} {i} {b}" for i in "pq"] + [f"{b} p {a}", a, b, a + b, b + a, f"{a} p {b}"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.class_id, r.n_links) for r in jaccard.join(frame).collect()}
    assert got == {i: (i, 0) for i in range(1, 7)} | {0: (0, 1), 7: (0, 1)}
