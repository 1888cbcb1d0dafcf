"""Small pieces shared by the two classifiers: bounded samples and a logistic fit on the driver."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def crc_remainder(doc_id: Column, divisor: int) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string")), F.lit(divisor))


def bounded_ids(ids: DataFrame, most: int, seed: int) -> DataFrame:
    """At most `most` distinct rows of ids (doc_id and more), chosen by a hash of doc_id."""
    return ids.distinct().orderBy(F.xxhash64(F.lit(seed), "doc_id"), *ids.columns).limit(most)


def one_text(texts: DataFrame) -> DataFrame:
    """One text per doc_id, whatever the number of its rows: what reaches the driver is bounded by ids then."""
    return texts.groupBy("doc_id").agg(F.min_by("text", F.xxhash64("text")).alias("text")).select("text")


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def adam(gradient, size: int, steps: int, rate: float = 0.05) -> np.ndarray:
    """Minimises by Adam from zero; gradient(w) -> array of the same size."""
    w, m, v = np.zeros(size), np.zeros(size), np.zeros(size)
    for t in range(1, steps + 1):
        g = gradient(w)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w


def fit_logistic(x: np.ndarray, target: np.ndarray, ridge: float = 1e-4, steps: int = 400) -> np.ndarray:
    """Weights (the last is the intercept) of a logistic model for soft targets."""
    x = np.hstack([x, np.ones((len(x), 1))])
    keep = np.ones(x.shape[1])
    keep[-1] = 0
    return adam(lambda w: x.T @ (sigmoid(x @ w) - target) / len(x) + ridge * keep * w, x.shape[1], steps)
