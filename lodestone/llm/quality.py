"""Operator 2, quality classifier: Naive Bayes support vectors.

Indicators of n-grams (of token shapes, and words) are scaled by their class log-count ratio; a linear model
with hinge loss is fitted to them by dual coordinate descent, and its margins, taken out of fold, are
turned into probabilities by a fitted sigmoid. Trained on the driver on at most max_rows labelled rows (the
documented bound); every text is scored whole.

Defined cases: a null or empty text gets the score of the bias; without labelled rows, or with one class
alone, the score is the share of label 1 (1 without any, so that nothing is lost); rows that repeat are scored
alike; an empty table gives an empty table; input columns called score or predicted are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .features import ShapeNgrams, Sparse, collected, fold, score, sigmoid, training_sample


@dataclass
class QualityModel:
    weights: dict[int, float]
    bias: float
    scale: float


def log_count_ratio(x: Sparse, y: np.ndarray, smooth: float = 1.0) -> np.ndarray:
    """log of each feature's share among label 1 over its share among label 0."""
    p, q = smooth + x.back((y == 1).astype(float)), smooth + x.back((y == 0).astype(float))
    return np.log((p / p.sum()) / (q / q.sum()))


def dual_coordinate_descent(x: Sparse, r: np.ndarray, y: np.ndarray, rows: np.ndarray, c: float = 1.0, epochs: int = 12) -> np.ndarray:
    """Weights (the last one the bias) of the L1-loss linear SVM on the given rows, features scaled by r."""
    norm = r / np.sqrt(max(1.0, float(np.mean(x.dot(r * r)[rows]))))
    index = [x.index[x.starts[i] : x.starts[i + 1]] for i in rows]
    value = [norm[i] for i in index]
    sign = np.where(y[rows] == 1, 1.0, -1.0)
    squares = np.array([v @ v + 1.0 for v in value])
    weight = np.where(sign > 0, 0.5 * len(sign) / max(1, (sign > 0).sum()), 0.5 * len(sign) / max(1, (sign < 0).sum())) * c
    alpha, w, bias = np.zeros(len(rows)), np.zeros(len(r)), 0.0
    order = np.random.default_rng(7)
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            slope = sign[i] * (w[index[i]] @ value[i] + bias) - 1
            new = min(max(alpha[i] - slope / squares[i], 0.0), weight[i])
            if new != alpha[i]:
                move = (new - alpha[i]) * sign[i]
                w[index[i]] += move * value[i]
                bias += move
                alpha[i] = new
    return np.append(w * norm, bias)


def fit_sigmoid(margin: np.ndarray, y: np.ndarray, steps: int = 60) -> tuple[float, float]:
    """Slope and offset of the sigmoid that gives label 1's probability, by Newton steps on smoothed targets."""
    pos, neg = (y == 1).sum(), (y == 0).sum()
    target = np.where(y == 1, (pos + 1) / (pos + 2), 1 / (neg + 2))
    theta, z = np.array([1.0, 0.0]), np.column_stack((margin, np.ones(len(margin))))
    for _ in range(steps):
        p = sigmoid(z @ theta)
        hessian = (z * (p * (1 - p) + 1e-9)[:, None]).T @ z + 1e-6 * np.eye(2)
        move = np.linalg.solve(hessian, z.T @ (p - target) + 1e-6 * theta)
        theta -= move * min(1.0, 2 / (np.abs(move).max() + 1e-12))
        if np.abs(move).max() < 1e-9:
            break
    return float(max(theta[0], 1e-6)), float(theta[1])


def fit(rows: list[np.ndarray], y: np.ndarray, min_rows: int = 3, **options) -> QualityModel:
    if not len(y) or y.min() == y.max():
        share = float(y.mean()) if len(y) else 1.0
        return QualityModel({}, float(np.log((share + 1e-9) / (1 - share + 1e-9))), 1.0)
    x = Sparse(rows, ShapeNgrams.size, min_rows)
    margins, half = np.zeros(len(y)), np.arange(len(y)) % 2
    for part in (0, 1):
        own = np.flatnonzero(half != part)
        if y[own].min() == y[own].max():
            own = np.arange(len(y))
        inside = (half != part).astype(float) if len(own) < len(y) else np.ones(len(y))
        p, q = 1 + x.back(inside * (y == 1)), 1 + x.back(inside * (y == 0))
        w = dual_coordinate_descent(x, np.log((p / p.sum()) / (q / q.sum())), y, own, **options)
        margins[half == part] = (x.dot(w[:-1]) + w[-1])[half == part]
    scale, offset = fit_sigmoid(margins, y)
    w = dual_coordinate_descent(x, log_count_ratio(x, y), y, np.arange(len(y)), **options)
    used = np.flatnonzero(w[:-1])
    return QualityModel(dict(zip(x.columns[used].tolist(), w[used].tolist(), strict=True)), scale * float(w[-1]) + offset, scale)


def train(docs: DataFrame, labels: DataFrame, max_rows: int = 10_000, folds: int = 3, held_out: int = 1, **options) -> QualityModel:
    """Fit on at most max_rows labelled rows outside the held-out fold of crc32(doc_id)."""
    rows, y, _ = collected(training_sample(docs, labels, "quality", fold(F.col("doc_id"), folds) != held_out, max_rows), ShapeNgrams)
    return fit(rows, y, **options)


def score_quality(docs: DataFrame, model: QualityModel, text_col: str = "text") -> DataFrame:
    """Adds score (0 to 1, higher: good) and predicted (1 if score >= 0.5)."""
    return score(docs, ShapeNgrams, model.weights, model.bias, model.scale, text_col, ("score", "predicted"))
