"""Toxicity by cumulative-link ordinal regression on sparse word features.

``P(grade >= j) = sigmoid(w.x - cut_j)`` with the same word weights ``w`` for every cut and increasing cuts. Labels only
tell toxic from clean, so grades are derived: 0 clean, 1 toxic, 2 toxic with more than the median number of words that
are typical of toxic documents. A document's severity is the expected grade, 0 to 2.

Learning takes at most ``per_label`` documents of each label (smallest hash of the id): the words are chosen and
weighed from them. Scoring reads whole texts. A null or empty text has severity ``2 * floor`` of no evidence, that is,
it is clean. Without both labels nothing is toxic. Repeated labels count as often as they occur; null labels and labels
other than 0 and 1 are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarryline.llm.rows import texts
from quarryline.session import stage

PER_LABEL = 5000
WORDS = 3000  # words that have a weight
LEAST_DOCUMENTS = 5  # a word must occur in as many sampled documents
TYPICAL = 5.0  # z score above which a word is typical of toxic documents
_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


@dataclass(frozen=True)
class Toxicity:
    weights: dict[str, float]
    cuts: tuple[float, ...]

    def evidence(self, text: str) -> float:
        found = Counter(filter(self.weights.__contains__, words_of(text)))
        return sum(self.weights[w] * np.log1p(n) for w, n in found.items())

    def reach(self, batch: list[str]) -> np.ndarray:
        """P(grade >= j) for j = 1, 2: one row per text."""
        level = np.array([self.evidence(t or "") for t in batch], dtype=float).reshape(-1, 1)
        return 1 / (1 + np.exp(-np.clip(level - np.array(self.cuts), -30, 30)))


def fit(rows: list[tuple[int, np.ndarray, np.ndarray]], n_words: int, penalty: float = 0.3, steps: int = 500) -> tuple[np.ndarray, np.ndarray]:
    """Weights and cuts from (grade, word numbers, values) by Adam steps on the cumulative-link likelihood."""
    grade = np.array([g for g, _, _ in rows])
    owner = np.repeat(np.arange(len(rows)), [len(w) for _, w, _ in rows])
    word = np.concatenate([w for _, w, _ in rows]).astype(int)
    value = np.concatenate([v for _, _, v in rows])
    # Cuts as a first one and positive gaps keep their order.
    theta = np.concatenate([np.zeros(n_words), [2.0, 1.0]])
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    sigmoid = lambda x: 1 / (1 + np.exp(-np.clip(x, -30, 30)))
    for step in range(1, steps + 1):
        level = np.bincount(owner, theta[word] * value, minlength=len(rows))
        cut = np.array([theta[-2], theta[-2] + np.exp(theta[-1])])
        above = sigmoid(level - cut[0]), sigmoid(level - cut[1])
        slope = [p * (1 - p) for p in above]
        share = np.maximum(np.choose(grade, [1 - above[0], above[0] - above[1], above[1]]), 1e-9)
        # Derivative of -log(share) by the level, and by the cuts.
        by_low = np.choose(grade, [slope[0], -slope[0], 0 * slope[0]]) / share
        by_high = np.choose(grade, [0 * slope[1], slope[1], -slope[1]]) / share
        by_level = by_low + by_high
        change = np.bincount(word, by_level[owner] * value, minlength=n_words) + penalty * theta[:-2]
        gradient = np.concatenate([change, [-(by_low + by_high).sum(), -by_high.sum() * np.exp(theta[-1])]]) / len(rows)
        first, second = 0.9 * first + 0.1 * gradient, 0.99 * second + 0.01 * gradient**2
        theta = theta - 0.05 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return theta[:-2], np.array([theta[-2], theta[-2] + np.exp(theta[-1])])


def train(docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL, words: int = WORDS) -> Toxicity:
    """Learn from ``labels`` (doc_id, toxic)."""
    known = labels.select("doc_id", F.col("toxic").alias("label")).where(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull())
    chosen = [known.where(F.col("label") == v).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_label) for v in (0, 1)]
    sample = F.broadcast(chosen[0].unionByName(chosen[1]))  # at most 2 * per_label rows of two numbers
    split = F.pandas_udf(lambda s: s.map(lambda t: words_of(t or "")), "array<string>")
    rows = stage(texts(docs).join(sample, "doc_id").select("label", split("text").alias("words")))
    sizes = {r.label: r.n for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        return Toxicity({}, (30.0, 30.0))
    # Log odds of a document with the word being toxic, in units of its standard error.
    a, b = F.sum("label") + F.lit(0.5), F.sum(1 - F.col("label")) + F.lit(0.5)
    odds = F.log(a / (sizes[1] + 1)) - F.log(b / (sizes[0] + 1))
    each = rows.select("label", F.explode(F.array_distinct("words")).alias("word")).groupBy("word")
    tested = each.agg(F.count("*").alias("n"), (odds / F.sqrt(1 / a + 1 / b)).alias("z")).where(F.col("n") >= LEAST_DOCUMENTS)
    best = tested.orderBy(F.abs(F.col("z")).desc(), "word").limit(words).collect()  # ``words`` rows at most
    number = {r.word: k for k, r in enumerate(best)}
    typical = {r.word for r in best if r.z > TYPICAL}

    def count(batch: pd.Series) -> pd.DataFrame:
        out = []
        for found in batch:
            seen = Counter(w for w in found if w in number)
            out.append(([number[w] for w in seen], [float(np.log1p(n)) for n in seen.values()], sum(n for w, n in seen.items() if w in typical)))
        return pd.DataFrame(out, columns=["word", "value", "typical"])

    sparse = F.pandas_udf(count, "word array<int>, value array<double>, typical long")
    data = rows.select("label", sparse("words").alias("x")).select("label", "x.*").collect()
    middle = float(np.median([r.typical for r in data if r.label == 1]))
    graded = [(0 if r.label == 0 else 1 + int(r.typical > middle), np.array(r.word, int), np.array(r.value, float)) for r in data]
    weights, cuts = fit(graded, len(number))
    return Toxicity({w: float(weights[k]) for w, k in number.items()}, (float(cuts[0]), float(cuts[1])))


def severity_columns(model: Toxicity, text: Column) -> Column:
    """Struct (severity, p_toxic) of a text column."""

    @F.pandas_udf("severity double, p_toxic double")
    def severity(batch: pd.Series) -> pd.DataFrame:
        reach = model.reach(list(batch))
        return pd.DataFrame({"severity": reach.sum(axis=1), "p_toxic": reach[:, 0]})

    return severity(text)


def score_documents(docs: DataFrame, model: Toxicity) -> DataFrame:
    """(doc_id, severity, p_toxic, grade, toxic) of every document: ``toxic`` is 1 from an even chance on."""
    rows = texts(docs).select("doc_id", severity_columns(model, F.col("text")).alias("x")).select("doc_id", "x.*")
    grade = F.round("severity").cast("int")
    return rows.select("*", grade.alias("grade"), (F.col("p_toxic") >= 0.5).cast("int").alias("toxic"))
