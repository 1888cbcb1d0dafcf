"""Quality by positive-unlabelled learning.

Trusted positives are labelled rows of good quality; unlabelled are documents of any kind. The class
prior of the unlabelled ones is estimated from the best bin of a first classifier, and a logistic model
over features of the whole text minimises the non-negative unbiased risk.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartmetrics.llm.common import chunks
from cartmetrics.llm.learning import adam, bounded_ids, crc_remainder, fit_logistic, one_text, sigmoid

#: Bound of each of the two samples that the model is fitted on.
SAMPLE_ROWS = 15_000
_SYMBOL = re.compile(r"[#*$%&|<>=~^_{}\[\]\\@]")
_DIGIT = re.compile(r"[0-9]")
_SHOUT = re.compile(r"[!?]{2,}|\.{4,}")
_PUNCTUATION = re.compile(r"[.,;:!?]")
_UPPER = re.compile(r"[A-ZÀ-ÖØ-Þ]")


def features(text: str | None) -> list[float]:
    """Shares and logarithms that describe a text, whatever its length."""
    text = text or ""
    words = text.split()
    n, chars = max(len(words), 1), max(len(text), 1)
    counts = Counter(words)
    lines = [line for line in text.split("\n") if line.strip()]
    distinct = len(counts)
    runs = sum(a == b for a, b in zip(words, words[1:], strict=False))
    pairs = len(set(zip(words, words[1:], strict=False)))
    lengths = [len(w) for w in words]
    mean = sum(lengths) / n
    return [
        np.log1p(len(words)),
        distinct / n**0.9,
        counts.most_common(1)[0][1] / n if words else 1.0,
        runs / n,
        pairs / n,
        mean,
        max(lengths, default=0) / 100,
        (sum(x * x for x in lengths) / n - mean * mean) ** 0.5 if words else 0.0,
        len(_SYMBOL.findall(text)) / n,
        len(_DIGIT.findall(text)) / chars,
        len(_SHOUT.findall(text)) / n,
        len(_PUNCTUATION.findall(text)) / n,
        len(_UPPER.findall(text)) / chars,
        text.count("|") / n,
        len(set(lines)) / max(len(lines), 1),
        np.log1p(n / max(len(lines), 1)),
        sum(len(x) for x in lines if len(x) < 40) / chars,
        float(text.rstrip()[-1:] in ".!?\"'»"),
    ]


N_FEATURES = len(features(""))


def expand(x: np.ndarray, center: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Standardised features, clipped, with hinges on both sides: what is too little or too much."""
    z = np.clip((x - center) / scale, -6, 6)
    return np.hstack([z, np.maximum(z - 1, 0), np.maximum(-z - 1, 0), np.maximum(z - 3, 0), np.maximum(-z - 3, 0)])


def class_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """Share of positives among the unlabelled by the best bin: the least ratio of what the two kinds
    have above a threshold, with an allowance that grows as the samples shrink (few positives give a prior near 1)."""
    cuts = np.quantile(positive, np.linspace(0.0, 0.95, 96))
    above = lambda s: np.array([(s >= c).mean() for c in cuts])
    slack = 1.0 / np.sqrt(max(len(positive), 1)) + 1.0 / np.sqrt(max(len(unlabelled), 1))
    ratio = (above(unlabelled) + 0.5 * slack) / np.maximum(above(positive), 1e-9)
    return float(np.clip(ratio.min(), 0.05, 0.98))


def fit_nnpu(positive: np.ndarray, unlabelled: np.ndarray, prior: float, steps: int = 800) -> np.ndarray:
    """Weights minimising prior * R_p+ + max(0, R_u- - prior * R_p-) for the logistic loss."""
    p, u = (np.hstack([x, np.ones((len(x), 1))]) for x in (positive, unlabelled))

    def gradient(w: np.ndarray) -> np.ndarray:
        at_p, at_u = p @ w, u @ w
        negative = np.logaddexp(0, at_u).mean() - prior * np.logaddexp(0, at_p).mean()
        g_negative = u.T @ sigmoid(at_u) / len(u) - prior * (p.T @ sigmoid(at_p)) / len(p)
        g_positive = -prior * (p.T @ sigmoid(-at_p)) / len(p)
        ridge = 3e-4 * np.append(w[:-1], 0)
        # Below zero the risk of the negatives is overfitted: step back up until it is not.
        return ridge + (g_positive + g_negative if negative >= 0 else -g_negative)

    return adam(gradient, p.shape[1], steps, 0.03)


def _feature_rows(texts: DataFrame) -> np.ndarray:
    """Features of a bounded number of texts, on the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches):
            rows = [features(t) for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.float64()))], names=["x"])

    rows = texts.select("text").mapInArrow(run, "x array<double>").collect()
    return np.array([r["x"] for r in rows], dtype=np.float64).reshape(-1, N_FEATURES)


def fit_quality(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Center, scale and weights. labels (doc_id, quality): the rows to learn from."""
    good = F.broadcast(bounded_ids(labels.where("quality = 1 AND doc_id IS NOT NULL").select("doc_id"), SAMPLE_ROWS, 5))
    some = F.broadcast(bounded_ids(docs.where("doc_id IS NOT NULL").select("doc_id"), SAMPLE_ROWS, 3))
    p, u = (_feature_rows(one_text(docs.join(ids, "doc_id", "left_semi"))) for ids in (good, some))
    if not len(p) or not len(u):
        return np.zeros(N_FEATURES), np.ones(N_FEATURES), np.zeros(5 * N_FEATURES + 1)
    center = np.median(p, axis=0)
    scale = np.maximum(np.quantile(np.abs(p - center), 0.75, axis=0) * 1.5, 1e-3)
    ep, eu = expand(p, center, scale), expand(u, center, scale)
    # A first classifier tells positives from unlabelled; one half fits it, the other half gives the prior.
    first = fit_logistic(np.vstack([ep[::2], eu[::2]]), np.repeat([1.0, 0.0], [len(ep[::2]), len(eu[::2])]), steps=300)
    rank = lambda x: x @ first[:-1]
    held = (ep[1::2], eu[1::2]) if len(ep) > 1 and len(eu) > 1 else (ep, eu)
    prior = class_prior(rank(held[0]), rank(held[1]))
    return center, scale, fit_nnpu(ep, eu, prior)


def quality_scores(docs: DataFrame, labels: DataFrame, divisor: int = 4, held_out: int = 2) -> DataFrame:
    """doc_id, held_out, score, predicted for each row of docs (doc_id, text).

    Labels (doc_id, quality) are learned only from rows whose crc32(doc_id) mod `divisor` is not
    `held_out`. The two samples (trusted positives, unlabelled documents) hold SAMPLE_ROWS at most.

    Null and empty texts have the features of an empty text. Null labels and labels of absent documents
    are ignored; without positives or documents every score is 0.5. The class prior is estimated at any number of rows.
    Repeated rows are scored each; rows without doc_id have held_out null. An empty table gives no rows. A text is held
    in one task's memory as a whole. Other columns are ignored.
    """
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    known = labels.where(crc_remainder(F.col("doc_id"), divisor) != held_out).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    center, scale, weights = fit_quality(docs, known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches):
            x = np.array([features(t) for t in part.column("text").to_pylist()], dtype=np.float64).reshape(-1, N_FEATURES)
            score = sigmoid(expand(x, center, scale) @ weights[:-1] + weights[-1])
            yield pa.RecordBatch.from_arrays([part.column("doc_id").combine_chunks(), pa.array(score)], names=["doc_id", "score"])

    scored = docs.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score double")
    return scored.select("doc_id", (crc_remainder(F.col("doc_id"), divisor) == held_out).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))
