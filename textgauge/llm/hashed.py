"""Hashed n-gram features of whole texts, as numpy arrays.

Words are runs of letters and digits or runs of other printed characters
(A-Z lower-cased), so marks stuck to a word are words of their own. Hashes are
CRC-32 and multiplications, the same in every process.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from zlib import compress, crc32, decompress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textgauge.llm.common import LOWER_BYTES, bounded_batches

BITS = 18
_WORD = re.compile(rb"[a-z0-9\x80-\xff]+|[^\sa-z0-9\x80-\xff]+")
_MIX = np.uint32(2654435761)
_STEP = np.uint32(0x85EBCA6B)
_SHIFT = np.uint32(32 - BITS)
#: Bytes of a text whose character n-grams are made at once.
_CHUNK = 1 << 20


def word_grams(text: str | None, orders: int = 2) -> np.ndarray:
    """Indexes of a text's word n-grams of 1 to ``orders`` words, repeats included."""
    words = _WORD.findall(text.encode("utf-8", "surrogatepass").translate(LOWER_BYTES)) if text else []
    single = np.fromiter(map(crc32, words), np.uint32, len(words))
    grams, last = [single], single
    for n in range(1, orders):
        last = last[:-1] * _STEP + single[n:] if len(last) else last
        grams.append(last)
    return ((np.concatenate(grams) * _MIX) >> _SHIFT).astype(np.int32)


def char_gram_chunks(text: str | None, orders: tuple[int, ...] = (3, 4)):
    """Indexes of a text's n-grams of UTF-8 bytes, chunk by chunk; case is kept."""
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8).astype(np.uint32) if text else np.empty(0, np.uint32)
    for n in orders:
        for at in range(0, max(0, len(data) - n + 1), _CHUNK):
            part = data[at : at + _CHUNK + n - 1]
            code = part[: len(part) - n + 1]
            for j in range(1, n):
                code = code * np.uint32(257) + part[j : len(part) - n + 1 + j]
            yield ((code * _STEP ^ code >> np.uint32(15)) * _MIX >> _SHIFT).astype(np.int32)


def packed_counts(grams: np.ndarray) -> bytes:
    """The distinct indexes of n-grams and their counts, a byte or two for each."""
    index, count = np.unique(grams, return_counts=True)
    steps = np.diff(index, prepend=0).astype("<u4").view(np.uint8).reshape(-1, 4).T
    return compress(steps.tobytes() + count.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def unpacked_counts(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    planes = np.frombuffer(decompress(data), np.uint8).reshape(8, -1)
    steps, count = (np.ascontiguousarray(p.T).view("<u4").ravel() for p in (planes[:4], planes[4:]))
    return np.cumsum(steps, dtype=np.int64).astype(np.int32), count.astype(np.int64)


def labelled_counts(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, max_rows: int, grams) -> list:
    """(id, label, counts) of at most ``max_rows`` labelled ids, those with the smallest hashes.

    Of rows with one id, the text with the smallest hash stands for all. Tasks make the packed counts of ``grams(text)``; only these reach the driver.
    """
    bounded_batches(docs.sparkSession)
    chosen = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("label")).distinct()
    chosen = chosen.orderBy(F.xxhash64("_id"), "_id", "label").limit(max_rows)
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "_id")
    rows = rows.groupBy("_id", "label").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = pa.array([packed_counts(grams(t)) for t in batch.column(2).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), counts], names=["id", "label", "counts"])

    kind = docs.schema[id_col].dataType.simpleString()
    found = rows.select("_id", "label", "text").mapInArrow(counted, f"id {kind}, label int, counts binary").collect()
    return sorted(found, key=lambda r: (crc32(str(r["id"]).encode()), str(r["id"]), r["label"], bytes(r["counts"])))


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35.0, 35.0)))
