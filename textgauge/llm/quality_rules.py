"""Quality rules: counted signals and a calibrated classifier against thresholds.

Method: logistic regression on hashed word n-grams (1, 2) and character n-grams
(3, 4 bytes), each family as relative frequencies, trained in numpy on labelled
quality rows by adaptive gradient steps. A quarter of the rows is kept out of
training and calibrates the probability (Platt's a*x + b). Whole texts are
scored in Arrow batches; the thresholds are fixed.

The sample of labelled rows is bounded by ``max_rows`` (smallest hashes of the
id); everything else covers all rows.

Defined results: a null text has no words and fails; without labels of both
kinds the classifier rejects nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textgauge.llm.common import bounded_batches
from textgauge.llm.hashed import BITS, char_gram_chunks, labelled_counts, sigmoid, unpacked_counts, word_grams

MAX_ROWS = 4000
MIN_WORDS = 20
#: Per cent of words in repeated windows.
MAX_REPEATED = 30
WINDOW = 8
#: Calibrated probability of label 1 under which a text is rejected.
MIN_PROBABILITY = 0.35
BLANKS = b" \t\n\x0b\f\r"
SYMBOLS = b"#*$%&|<>"
_SIZE = 1 << BITS
_STEPS = np.array([pow(0x9E3779B97F4A7C15, j, 1 << 64) for j in range(WINDOW)], np.uint64)
#: Relative frequencies are small; the factor brings them near 1.
_SCALE = 20.0


def repeated_words(words: list[bytes]) -> int:
    """Words inside windows of 8 words that occur at least twice."""
    m = len(words) - WINDOW + 1
    if m < 2:
        return 0
    h = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    window = sum(h[j : j + m] * _STEPS[j] for j in range(WINDOW))
    order = np.sort(window)
    twice = order[1:][order[1:] == order[:-1]]
    if not len(twice):
        return 0
    starts = np.isin(window, twice)
    cover = np.zeros(len(words) + 1, np.int64)
    cover[:m] += starts
    cover[WINDOW : WINDOW + m] -= starts
    return int((np.cumsum(cover) > 0).sum())


def signals(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.split()
    blanks = len(data) - len(data.translate(None, BLANKS))
    lines = [x for x in data.split(b"\n") if x.strip(BLANKS)]
    return (
        len(words),
        len(text or "") - blanks,
        len(data) - len(data.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
    )


class Model(NamedTuple):
    weights: np.ndarray  # words, then characters
    bias: float
    slope: float
    offset: float


NEUTRAL = Model(np.zeros(2 * _SIZE, np.float32), 0.0, 0.0, 10.0)


def raw_score(text: str | None, model: Model) -> float:
    words = word_grams(text)
    total = float(model.weights[words].mean()) if len(words) else 0.0
    parts = [(float(model.weights[_SIZE:][c].sum(dtype=np.float64)), len(c)) for c in char_gram_chunks(text)]
    if parts:
        total += sum(s for s, _ in parts) / sum(n for _, n in parts)
    return total * _SCALE + model.bias


def probability(text: str | None, model: Model) -> float:
    return float(sigmoid(model.slope * raw_score(text, model) + model.offset))


def all_grams(text: str | None) -> np.ndarray:
    """Word grams, then character grams from 2^18 on."""
    return np.concatenate([word_grams(text), *[c + np.int32(_SIZE) for c in char_gram_chunks(text)]])


def frequencies(index: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each family's counts by its sum, scaled."""
    value, cut = count.astype(np.float32) * np.float32(_SCALE), np.searchsorted(index, _SIZE)
    for part in (slice(0, cut), slice(cut, None)):
        value[part] /= max(1, int(count[part].sum()))
    return index, value


def _platt(x: np.ndarray, target: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the calibrated log-odds, by Newton steps that never raise the loss."""
    scale = max(1e-9, float(np.std(x)))
    x = x / scale

    def loss(at: np.ndarray) -> float:
        f = at[0] * x + at[1]
        return float((np.logaddexp(0, f) - target * f).sum() + 1e-3 * at[0] ** 2)

    at = np.zeros(2)
    for _ in range(100):
        p = sigmoid(at[0] * x + at[1])
        r, s = p - target, p * (1 - p) + 1e-9
        gradient = np.array([r @ x + 2e-3 * at[0], r.sum()])
        step = np.linalg.solve([[s @ (x * x) + 2e-3, s @ x], [s @ x, s.sum()]], gradient)
        size = 1.0
        while size > 1e-6 and loss(at - size * step) > loss(at):
            size /= 2
        at = at - size * step
        if np.abs(gradient).max() < 1e-6:
            break
    return float(at[0] / scale), float(at[1])


def fit_model(rows: list, epochs: int = 4, rate: float = 0.3, l2: float = 1e-5, seed: int = 3) -> Model:
    """Fit on rows with label and packed counts; every fourth row calibrates."""
    train, held = [r for k, r in enumerate(rows) if k % 4], rows[::4]
    if len({r["label"] for r in train}) < 2 or len({r["label"] for r in held}) < 2:
        return NEUTRAL
    w, seen, bias, bias_seen = np.zeros(2 * _SIZE), np.full(2 * _SIZE, 1e-2), 0.0, 1.0
    order = np.random.default_rng(seed)
    for _ in range(epochs):
        for k in order.permutation(len(train)):
            at, x = frequencies(*unpacked_counts(train[k]["counts"]))
            error = sigmoid(w[at] @ x + bias) - train[k]["label"]
            g = error * x + l2 * w[at]
            seen[at] += g * g
            w[at] -= rate * g / np.sqrt(seen[at])
            bias_seen += error * error
            bias -= rate * error / np.sqrt(bias_seen)
    y, x = np.array([r["label"] for r in held], float), np.empty(len(held))
    for k, r in enumerate(held):
        at, v = frequencies(*unpacked_counts(r["counts"]))
        x[k] = w[at] @ v + bias
    # Platt's targets keep the fit finite where the classes separate
    target = np.where(y > 0, (y.sum() + 1) / (y.sum() + 2), 1 / (len(y) - y.sum() + 2))
    a, b = _platt(x, target)
    return Model(w.astype(np.float32), float(bias), float(a), float(b))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", max_rows: int = MAX_ROWS) -> Model:
    """Fit on at most ``max_rows`` labelled rows; their counts are made by Spark tasks."""
    return fit_model(labelled_counts(docs, labels, id_col, text_col, label_col, max_rows, all_grams))


def judge(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, the signals, probability, base_failed, kept) of every row."""
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2 MB, whatever the data
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            columns = list(zip(*map(signals, texts))) or [[]] * len(counts)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, pa.int64()) for c in columns], pa.array([probability(t, shared.value) for t in texts], pa.float64())],
                names=["id", *counts, "probability"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    found = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        judged, f"id {kind}, " + ", ".join(f"{c} long" for c in counts) + ", probability double"
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    return found.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & (F.col("probability") >= MIN_PROBABILITY))
