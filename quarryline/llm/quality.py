"""Quality scores by Bradley-Terry pairwise ranking.

A document's strength is a weighted sum of text statistics. The weights are learned from preference pairs (a document
labelled 1 beats one labelled 0) by logistic loss on the difference of their features. The decision threshold is a
quantile of the strengths: the share of labels 0 among all training labels.

The weights are learned from at most ``per_label`` documents of each label, those with the smallest hash of their id. The
threshold is exact over the strengths of all labelled documents that are not held out. Labels, lang, source and ids never enter a score. A null text is empty; an empty text gets a score
like any other. Without labels, or with one kind only, every document scores ``KEEP``, hence is kept. Repeated labels of a
document count as often as they occur; labels other than 0 and 1 and null labels are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarryline.llm.rows import bucket_of, texts
from quarryline.operators.scale import running_sum
from quarryline.session import stage

KEEP = 0.7  # the score at the threshold
PER_LABEL = 4000
_EDGES = re.compile(r"[.\n]+")


def features(text: str) -> list[float]:
    """Text statistics, each within 0 to 1 or a small multiple of it."""
    words = text.split()
    n, size = len(words), max(len(text), 1)
    raw = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    upper = int(np.count_nonzero((raw >= 65) & (raw <= 90)))
    lower = int(np.count_nonzero((raw >= 97) & (raw <= 122)))
    digits = int(np.count_nonzero((raw >= 48) & (raw <= 57)))
    spaces = int(np.count_nonzero((raw == 32) | (raw == 10)))
    marks = int(np.count_nonzero(((raw > 32) & (raw < 48)) | ((raw > 57) & (raw < 65)) | ((raw > 90) & (raw < 97)) | ((raw > 122) & (raw < 127))))
    plain = int(np.count_nonzero((raw == 46) | (raw == 44)))
    counts = Counter(words)
    most = counts.most_common(1)[0][1] if n else 0
    again = sum(map(str.__eq__, words, words[1:]))
    pieces = [p for p in map(str.strip, _EDGES.split(text)) if p]
    repeated = sum(len(p) * (c - 1) for p, c in Counter(pieces).items())
    odd_ends = sum(not w[-1].isalnum() and w[-1] not in ".,;:" for w in words)
    share = lambda x, of: x / max(of, 1)
    base = [
        share(upper, upper + lower), share(digits, size), share(marks - plain, size), share(plain, size), share(size - spaces, size),
        share(len(counts), n), share(most, n), share(again, n), share(repeated, size), share(odd_ends, n),
        min(size / max(n, 1), 20.0) / 10, np.log1p(n) / 10, share(len(pieces), n), float(n == 0),
    ]
    # Saturating forms of the shares: the step from none to a little says more than from much to very much.
    return base + [min(10 * x, 1.0) for x in (base[0], base[2], base[7], base[8], base[9])] + [min(n / 12, 1.0)]


def _matrix(batch: pd.Series) -> np.ndarray:
    return np.array([features(t or "") for t in batch], dtype=float)


@dataclass(frozen=True)
class Quality:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    threshold: float

    def strength(self, rows: np.ndarray) -> np.ndarray:
        return ((rows - self.mean) / self.scale) @ self.weights

    def score(self, rows: np.ndarray) -> np.ndarray:
        """0 to 1; ``KEEP`` exactly where the strength is the threshold."""
        away = np.clip(self.strength(rows) - self.threshold, -30, 30)
        return 1 / (1 + (1 - KEEP) / KEEP * np.exp(-away))


def fit(good: np.ndarray, bad: np.ndarray, bad_share: float, penalty: float = 1.0, pairs: int = 40_000) -> Quality:
    """Newton steps on the pairwise logistic loss; ``bad_share`` is the quantile of the threshold."""
    both = np.concatenate([good, bad]) if len(good) and len(bad) else np.zeros((0, len(features(""))))
    if not len(both):
        flat = np.zeros(both.shape[1])
        return Quality(flat, np.ones_like(flat), flat, 0.0)
    mean, scale = both.mean(axis=0), both.std(axis=0) + 1e-6
    rng = np.random.default_rng(0)
    left, right = rng.integers(0, len(good), pairs), rng.integers(0, len(bad), pairs)
    delta = (good[left] - bad[right]) / scale
    weights = np.zeros(both.shape[1])
    for _ in range(25):
        wins = 1 / (1 + np.exp(-np.clip(delta @ weights, -30, 30)))
        slope = delta.T @ (wins - 1) + penalty * weights
        curve = (delta * (wins * (1 - wins))[:, None]).T @ delta + penalty * np.eye(len(weights))
        step = np.linalg.solve(curve, slope)
        weights = weights - step
        if np.abs(step).max() < 1e-6:
            break
    model = Quality(mean, scale, weights, 0.0)
    # Quantile with the classes in their true proportion, whatever was sampled of each.
    strength = model.strength(both)
    weight = np.r_[np.full(len(good), (1 - bad_share) / len(good)), np.full(len(bad), bad_share / len(bad))]
    order = np.argsort(strength, kind="stable")
    reached = np.cumsum(weight[order])
    at = int(np.searchsorted(reached, bad_share - 1e-12))
    at = min(at, len(order) - 2) if len(order) > 1 else 0
    threshold = float(strength[order][at : at + 2].mean())
    return Quality(mean, scale, weights, threshold)


def held_out(doc_id: Column) -> Column:
    return bucket_of(doc_id, 4) == 2


def train(docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL) -> Quality:
    """Learn from ``labels`` (doc_id, quality) of rows that are not held out."""
    known = labels.select(F.col("doc_id"), F.col("quality").alias("label"))
    known = known.where(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    sizes = {r.label: r.n for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    chosen = [known.where(F.col("label") == v).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_label) for v in (0, 1)]
    sample = F.broadcast(chosen[0].unionByName(chosen[1]))  # at most 2 * per_label rows of two numbers
    measured = F.pandas_udf(lambda s: pd.Series(list(_matrix(s))), "array<double>")
    rows = texts(docs).join(sample, "doc_id").select("label", measured("text").alias("x")).collect()
    split = [np.array([r.x for r in rows if r.label == v], dtype=float).reshape(-1, len(features(""))) for v in (0, 1)]
    total = sum(sizes.values())
    bad_share = sizes.get(0, 0) / total if total else 0.0
    model = fit(split[1], split[0], bad_share)
    return replace(model, threshold=threshold(docs, known, model, bad_share)) if model.weights.any() else model


def threshold(docs: DataFrame, known: DataFrame, model: Quality, bad_share: float) -> float:
    """The ``bad_share`` quantile of the strengths of all documents in ``known`` (doc_id, label), exactly.

    As in ``fit``, each label has its true share of the weight, and the quantile is the middle between the row that
    reaches it and the next. Texts stay where they are: strengths are joined with the labels, and equal ones become counts.
    """

    @F.pandas_udf("double")
    def strength(batch: pd.Series) -> pd.Series:
        return pd.Series(model.strength(_matrix(batch)) if len(batch) else [], dtype=float)

    rows = texts(docs.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))))
    measured = rows.select("doc_id", strength("text").alias("strength")).groupBy("doc_id", "strength").agg(F.count("*").alias("copies"))
    asked = known.groupBy("doc_id").agg(F.count(F.when(F.col("label") == 1, 1)).alias("good"), F.count(F.when(F.col("label") == 0, 1)).alias("bad"))
    both = measured.join(asked, "doc_id").groupBy("strength").agg(F.sum(F.col("copies") * F.col("good")).alias("good"), F.sum(F.col("copies") * F.col("bad")).alias("bad"))
    counted = stage(both)
    sums = counted.agg(F.sum("good").alias("good"), F.sum("bad").alias("bad")).head()
    for label in ("good", "bad"):
        counted = running_sum(counted, [], [F.col("strength")], F.col(label), f"{label}_before")
    one = {"good": (1 - bad_share) / sums.good, "bad": bad_share / sums.bad}
    reached = sum((F.col(f"{c}_before") + F.col(c)) * one[c] for c in one)
    ranked = stage(counted.withColumn("reached", reached))
    at = ranked.where(F.col("reached") >= bad_share - 1e-12).orderBy("strength").limit(2).collect()
    # The row that reaches the quantile is the last of its strength, unless the others of its strength reach it too.
    last = at[0].reached - (one["bad"] if at[0].bad else one["good"]) < bad_share - 1e-12
    if len(at) == 2 and last:
        return (at[0].strength + at[1].strength) / 2
    if last and at[0].good + at[0].bad == 1:  # no row is left above: the middle of the last two
        below = ranked.where(F.col("strength") < at[0].strength).agg(F.max("strength")).head()[0]
        return (below + at[0].strength) / 2
    return at[0].strength


def score_column(model: Quality, text: Column) -> Column:
    @F.pandas_udf("double")
    def score(batch: pd.Series) -> pd.Series:
        return pd.Series(model.score(_matrix(batch)) if len(batch) else [], dtype=float)

    return score(text)


def score_documents(docs: DataFrame, model: Quality) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""
    rows = texts(docs).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score_column(model, F.col("text")).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= KEEP).cast("int"))
