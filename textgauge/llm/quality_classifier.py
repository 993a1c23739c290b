"""Quality scores from hashed word n-grams, learned by follow-the-regularised-leader.

Method: word 1- and 2-grams are hashed to 2^18 indexes; a text is the sparse
unit vector of log(1 + count). Logistic regression is fitted by FTRL-proximal
updates (per-coordinate rates, L1 and L2), in a seeded order, and a text's
score is the sigmoid of a sparse dot product.

The model is fitted on a bounded sample of labelled rows: ``max_rows`` of them,
those with the smallest hash of their id. Their counts are made by Spark tasks
and collected packed; all texts are then scored in Arrow batches.

Defined results: a null or empty text scores as the bias alone; without labels
of both kinds every score is the share of label 1, or 0.5 without any.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textgauge.llm.common import bounded_batches
from textgauge.llm.hashed import BITS, labelled_counts, sigmoid, unpacked_counts, word_grams

MAX_ROWS = 6000


def unit(index: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indexes and values of the unit vector of some counts."""
    value = np.log1p(count).astype(np.float32)
    return index, value / max(1e-9, float(np.sqrt((value * value).sum())))


def vector(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    return unit(*np.unique(word_grams(text), return_counts=True))


def fit_ftrl(rows: list, epochs: int = 3, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.02, l2: float = 0.5, seed: int = 7) -> tuple[np.ndarray, float]:
    """Weights (the last one is the bias) of rows with label and packed counts."""
    size = 1 << BITS
    z, n = np.zeros(size + 1, np.float64), np.zeros(size + 1, np.float64)

    def weights(at):
        zs = z[at]
        return np.where(np.abs(zs) <= l1, 0.0, -(zs - np.sign(zs) * l1) / ((beta + np.sqrt(n[at])) / alpha + l2))

    share = sum(r["label"] for r in rows) / len(rows) if rows else 0.5
    if not rows or share in (0, 1):
        out = np.zeros(size + 1)
        out[size] = np.log(np.clip(share, 1e-3, 1 - 1e-3) / (1 - np.clip(share, 1e-3, 1 - 1e-3)))
        return out.astype(np.float32), share
    order = np.random.default_rng(seed)
    for _ in range(epochs):
        for k in order.permutation(len(rows)):
            y = rows[k]["label"]
            at, x = unit(*unpacked_counts(rows[k]["counts"]))
            at, x = np.append(at, size), np.append(x, 1.0)
            w = weights(at)
            g = (sigmoid(w @ x) - y) * x
            step = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha
            z[at] += g - step * w
            n[at] += g * g
    return weights(np.arange(size + 1)).astype(np.float32), share


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", max_rows: int = MAX_ROWS) -> np.ndarray:
    return fit_ftrl(labelled_counts(docs, labels, id_col, text_col, label_col, max_rows, word_grams))[0]


def score(docs: DataFrame, weights: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) of every row."""
    bounded_batches(docs.sparkSession)
    model = docs.sparkSession.sparkContext.broadcast(weights)  # 1 MB, whatever the data

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = model.value
        for batch in batches:
            out = []
            for text in batch.column(1).to_pylist():
                index, value = vector(text)
                out.append(float(sigmoid(float(w[index] @ value) + float(w[-1]))))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.float64())], names=["id", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(scored, f"id {kind}, score double")
