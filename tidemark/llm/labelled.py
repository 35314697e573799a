"""A bounded sample of labelled documents, and small numpy models fitted to it."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import held_out


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, most: int) -> DataFrame:
    """Texts and labels (doc_id, text, y) of at most `most` labelled documents.

    Only rows that are not held out; taken by a hash of the identifier, so that
    reruns agree. Null labels do not count; an identifier labelled more than once
    takes its largest label.
    """
    ids = (labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
           .groupBy("doc_id").agg((F.max(F.col(label).cast("int")) > 0).cast("int").alias("y"))
           .orderBy(F.xxhash64("doc_id"), "doc_id").limit(most))
    return docs.join(F.broadcast(ids), "doc_id")  # at most `most` rows of an id and a label


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


def temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature of least log loss on rows that were not fitted."""
    if not len(y):
        return 1.0
    def loss(t: float) -> float:
        p = np.clip(sigmoid(logits / t), 1e-6, 1 - 1e-6)
        return float(-np.mean(y * np.log(p) + (1 - y) * np.log(1 - p)))
    return min(np.geomspace(0.25, 8, 41), key=loss)


class Network:
    """Two layers (tanh, logistic) on standardised inputs, Adam, temperature-calibrated."""

    def __init__(self, x: np.ndarray, y: np.ndarray, hidden: int = 24, epochs: int = 60, seed: int = 7) -> None:
        rng = np.random.default_rng(seed)
        self.mean, self.scale = x.mean(0), x.std(0) + 1e-6
        x, y = self._inputs(x), y.astype(np.float64)
        check = np.arange(len(y)) % 5 == 0  # kept back for the temperature
        fit_x, fit_y = x[~check], y[~check]
        w = [rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], hidden)), np.zeros(hidden),
             rng.normal(0, 1 / np.sqrt(hidden), hidden), np.zeros(1)]
        m, v, step = [np.zeros_like(a) for a in w], [np.zeros_like(a) for a in w], 0
        for _ in range(epochs):
            order = rng.permutation(len(fit_y))
            for i in range(0, len(order), 128):
                rows = order[i:i + 128]
                h = np.tanh(fit_x[rows] @ w[0] + w[1])
                d = (sigmoid(h @ w[2] + w[3]) - fit_y[rows]) / len(rows)
                back = np.outer(d, w[2]) * (1 - h * h)
                grads = [fit_x[rows].T @ back + 1e-4 * w[0], back.sum(0), h.T @ d + 1e-4 * w[2], np.array([d.sum()])]
                step += 1
                for k, g in enumerate(grads):
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.999 * v[k] + 0.001 * g * g
                    w[k] -= 0.005 * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
        self.w = w
        self.t = 1.0
        self.t = temperature(self.logits(x[check]), y[check])

    def _inputs(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -8, 8)

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh(x @ self.w[0] + self.w[1]) @ self.w[2] + self.w[3]

    def __call__(self, x: np.ndarray) -> np.ndarray:
        """Probabilities, rounded so that a row's does not depend on the rows multiplied with it."""
        return np.round(sigmoid(self.logits(self._inputs(x)) / self.t), 9)


class Prior:
    """What is left to say without rows of both labels: their share, or a half."""

    def __init__(self, y: np.ndarray) -> None:
        self.p = float(y.mean()) if len(y) else 0.5

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return np.full(len(x), self.p)


def fitted(x: np.ndarray, y: np.ndarray, **options):
    return Network(x, y, **options) if len(y) >= 20 and 0 < y.sum() < len(y) else Prior(y)
