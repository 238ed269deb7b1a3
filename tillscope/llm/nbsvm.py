"""Quality classifier: a support vector machine on naive Bayes features.

Indicators of n-grams are scaled by the log-count ratio of the classes, each
document is brought to unit length, and a linear hinge-loss model is fitted by
dual coordinate descent. Two token streams give the n-grams: the words, and their
shapes (runs of lower-case letters, capitals, digits and of the same sign each
become one sign, with a mark on a word that repeats the one before).
"""

from __future__ import annotations

from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillscope.llm.common import free_name, remainder, table
from tillscope.llm.labelled import SAMPLE_ROWS, labelled_sample

#: n-grams are numbered by a hash of so many bits.
HASH_BITS = 18
WORD_ORDER, SHAPE_ORDER = 2, 3
SMOOTHING = 1.0
COST = 1.0
EPOCHS = 30
FOLDS = 3
ACCEPTED = 0.3
HELD_OUT_MODULUS, HELD_OUT = 5, 0

_SHAPES = bytes(
    ord("a") if 97 <= c <= 122 or c >= 128 else ord("A") if 65 <= c <= 90 else ord("0") if 48 <= c <= 57 else c
    for c in range(256)
)
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], dtype=np.uint64)
_REPEAT = np.uint64(1 << 40)


def _hashes(tokens: list[bytes]) -> np.ndarray:
    return np.fromiter(map(crc32, tokens), dtype=np.uint64, count=len(tokens))


def _ngrams(tokens: np.ndarray, order: int, kind: int) -> list[np.ndarray]:
    found = []
    for n in range(1, order + 1):
        if len(tokens) < n:
            break
        mixed = np.full(len(tokens) - n + 1, kind * 8 + n, dtype=np.uint64) * _FACTORS[2]
        for k in range(n):
            mixed = (mixed ^ tokens[k : len(tokens) - n + 1 + k]) * _FACTORS[k & 1]
            mixed ^= mixed >> np.uint64(29)
        found.append(mixed * _FACTORS[0] >> np.uint64(64 - HASH_BITS))
    return found


def features(text: bytes | None) -> np.ndarray:
    """Sorted numbers of the distinct n-grams of a whole text; none for a blank one."""
    raw = text or b""
    words = _hashes(raw.lower().split())
    if not len(words):
        return np.empty(0, dtype=np.int64)
    signs = np.frombuffer(raw.translate(_SHAPES), dtype=np.uint8)
    runs = signs[np.append(True, signs[1:] != signs[:-1])]
    shapes = _hashes(runs.tobytes().split())
    shapes[1:][words[1:] == words[:-1]] |= _REPEAT
    found = _ngrams(words, WORD_ORDER, 0) + _ngrams(shapes, SHAPE_ORDER, 1)
    return np.unique(np.concatenate(found)).astype(np.int64)


@dataclass
class Model:
    ratios: np.ndarray
    weights: np.ndarray
    bias: float
    slope: float
    offset: float

    def margin(self, text: bytes | None) -> float:
        found = features(text)
        if not len(found):
            return self.bias
        scales = self.ratios[found]
        return float(scales @ self.weights[found] / np.sqrt(scales @ scales + 1e-12)) + self.bias

    def score(self, text: bytes | None) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * self.margin(text) + self.offset, -30, 30))))


def _log_ratios(rows: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    size = 1 << HASH_BITS
    counts = [np.bincount(np.concatenate([r for r, y in zip(rows, labels) if y == side] or [rows[0][:0]]), minlength=size) for side in (1, 0)]
    p, q = (c + SMOOTHING for c in counts)
    return (np.log(p / p.sum()) - np.log(q / q.sum())).astype(np.float32)


def _coordinate_descent(rows: list[np.ndarray], ratios: np.ndarray, labels: np.ndarray):
    """Weights and bias of the linear hinge-loss model over unit-length scaled rows."""
    signs = np.where(labels == 1, 1.0, -1.0)
    # an example weighs so much that both classes count alike
    cost = COST * np.where(labels == 1, len(labels) / (2 * max(1, (labels == 1).sum())), len(labels) / (2 * max(1, (labels == 0).sum())))
    values = [ratios[r] / np.sqrt(ratios[r] @ ratios[r] + 1e-12) for r in rows]
    norms = np.array([v @ v for v in values]) + 1.0  # the bias is a feature that is always one
    weights, bias, alpha = np.zeros(1 << HASH_BITS, dtype=np.float64), 0.0, np.zeros(len(rows))
    order = np.random.default_rng(7)
    for _ in range(EPOCHS):
        most = 0.0
        for i in order.permutation(len(rows)):
            gradient = signs[i] * (values[i] @ weights[rows[i]] + bias) - 1
            new = min(max(alpha[i] - gradient / norms[i], 0.0), cost[i])
            if (step := (new - alpha[i]) * signs[i]):
                alpha[i] = new
                weights[rows[i]] += step * values[i]
                bias += step
                most = max(most, abs(step))
        if most < 1e-4:
            break
    return weights, bias


def _platt(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve through the margins, by Newton's steps."""
    good, bad = (labels == 1).sum(), (labels == 0).sum()
    goal = np.where(labels == 1, (good + 1) / (good + 2), 1 / (bad + 2))
    beta = np.array([1.0, 0.0])
    design = np.stack([margins, np.ones_like(margins)], axis=1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        gradient = design.T @ (p - goal) + 1e-3 * beta
        hessian = (design * (p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        beta -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return float(max(beta[0], 0.0)), float(beta[1])


def fit(examples: list[tuple[bytes, int]]) -> Model:
    """Fits ratios, weights and, on margins of rows left out, the curve to a score.

    Without examples of both classes every score is the smoothed share of label 1.
    """
    labels = np.array([y for _, y in examples], dtype=int)
    size = 1 << HASH_BITS
    if len(set(labels.tolist())) < 2:
        share = (labels.sum() + 1) / (len(labels) + 2)
        return Model(np.zeros(size, np.float32), np.zeros(size, np.float32), 0.0, 0.0, float(np.log(share / (1 - share))))
    rows = [features(t) for t, _ in examples]
    texts = [t for t, _ in examples]
    fold = np.arange(len(rows)) % FOLDS
    margins = np.zeros(len(rows))
    for k in range(FOLDS):
        inside = np.flatnonzero(fold != k)
        part = [rows[i] for i in inside]
        ratios = _log_ratios(part, labels[inside])
        weights, bias = _coordinate_descent(part, ratios, labels[inside])
        model = Model(ratios, weights, bias, 1.0, 0.0)
        for i in np.flatnonzero(fold == k):
            margins[i] = model.margin(texts[i])
    slope, offset = _platt(margins, labels)
    ratios = _log_ratios(rows, labels)
    weights, bias = _coordinate_descent(rows, ratios, labels)
    return Model(ratios, weights.astype(np.float32), bias, slope, offset)


def fitted(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Model:
    usable = remainder(F.col("doc_id"), HELD_OUT_MODULUS) != HELD_OUT
    return fit(labelled_sample(docs, labels, "quality", usable, rows=rows))


def score(docs: DataFrame, text: Column, model: Model) -> Column:
    """Score in 0 to 1 of every whole text; null and blank texts count as empty ones."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # four bytes a hash slot, twice

    @F.pandas_udf("double")
    def quality(texts: pd.Series) -> pd.Series:
        known = shared.value
        return pd.Series([known.score(t) for t in texts], dtype=float)

    return quality(text.cast("binary"))


def quality_scores(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs`` (doc_id, text, others).

    The model is fitted on at most ``rows`` labelled documents, none of them held
    out. Null texts are scored as empty ones; a row with a null doc_id is scored
    and not held out; repeated rows get equal scores; empty tables give an empty
    result, and without usable labels every score is one half.
    """
    held_out = F.coalesce(remainder(F.col("doc_id"), HELD_OUT_MODULUS) == HELD_OUT, F.lit(False))
    scored = docs.select("doc_id", "text").withColumn("score", score(docs, F.col("text"), fitted(docs, labels, rows)))
    return scored.select(
        "doc_id", held_out.alias("held_out"), "score",
        F.when(F.col("score") >= ACCEPTED, 1).otherwise(0).alias("predicted"),
    )


def accepted(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """The rows of ``docs`` that the classifier predicts to be of label 1, all columns as they are."""
    name = free_name(docs, "quality_score")
    scored = docs.withColumn(name, score(docs, F.col("text"), fitted(docs, labels, rows)))
    return scored.filter(F.col(name) >= ACCEPTED).drop(name)


def query(spark, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
