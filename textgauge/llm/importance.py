"""Importance resampling of documents toward a target distribution.

Features are all runs of 1 to 2 consecutive words, hashed into buckets by CRC-32
of their UTF-8 bytes. A bucket's gain is the log of its smoothed share in the
target over that in the corpus; a document's weight is the mean gain of its
features. Weight plus seeded Gumbel noise is its score, and the highest scores
are drawn: sampling without replacement in proportion to exp(weight).

Method of hashing: CRC-32 is linear over XOR. A table gives what a byte adds to
the remainder by its distance from the end of its span (``SPAN`` x 256 values,
made from the polynomial), and a constant by length what start and end values
add. The CRCs of all features of a batch are one gather and one
``bitwise_xor.reduceat`` over the features' spans. Longer spans are cut into
blocks of ``SPAN`` bytes from their end; the remainders of the blocks are folded,
each shifted by one block with four look-ups.

Two passes over the texts, no shuffle of texts: bucket counts are summed inside
each task, and the gains of the fixed number of buckets travel to the second
pass. Ranks need no sort in one task: scores are whole numbers of a bounded
range, so their counts make a bounded table; ranks start from it, and copies of
an id count by partition.

A task holds one Arrow batch; texts are worked on in pieces of ``PIECE`` bytes
that are cut between words.

Defined results: a null text has no words, so no features, weight 0 and no rank;
a null id counts as the empty string and comes before all others in ties; of
rows with one id and score, which gets the smaller rank is not defined. Columns
other than id and text are not read.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textgauge.llm.common import LOWER_BYTES, bounded_batches, saved

BUCKETS = 10_000
SEED, PERCENT, MIN_WORDS = 7, 25, 20
SPAN = 64
PIECE = 2 << 20
#: Bytes gathered at once.
_SLICE = 1 << 20
_POLYNOMIAL = 0xEDB88320
#: A word is a run of these: ASCII letters and digits and all beyond ASCII.
_WORD = np.zeros(256, bool)
_WORD[np.frombuffer(b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz", np.uint8)] = True
_WORD[128:] = True


def _contributions() -> np.ndarray:
    """What byte b at distance d from the end adds to the remainder: row d, column b."""
    rows = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        rows = np.where(rows & 1, (rows >> 1) ^ np.uint32(_POLYNOMIAL), rows >> 1)
    table = [rows]
    for _ in range(SPAN - 1):
        table.append(rows[table[-1] & 255] ^ (table[-1] >> 8))
    return np.stack(table)


_TABLE = _contributions()
_FLAT = _TABLE.ravel()


def _constants(lengths: np.ndarray) -> np.ndarray:
    """CRC-32 of as many zero bytes: what start and end values add."""
    known, back = np.unique(lengths, return_inverse=True)
    return np.array([zlib.crc32(bytes(int(n))) for n in known], np.uint32)[back]


def _remainders(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """XOR of all contributions of spans of 1 to ``SPAN`` bytes."""
    out = np.empty(len(starts), np.uint32)
    sums = np.cumsum(ends - starts)
    at = 0
    while at < len(starts):
        upto = max(at + 1, int(np.searchsorted(sums, (sums[at - 1] if at else 0) + _SLICE, "right")))
        s, e = starts[at:upto], ends[at:upto]
        sizes = e - s
        heads = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        places = np.arange(sizes.sum()) + np.repeat(s - heads, sizes)
        added = _FLAT[((np.repeat(e, sizes) - 1 - places) << 8) | data[places]]
        out[at:upto] = np.bitwise_xor.reduceat(added, heads)
        at = upto
    return out


def _shifted(r: np.ndarray) -> np.ndarray:
    """Remainders after one more block of zero bytes."""
    return _TABLE[SPAN - 1][r & 255] ^ _TABLE[SPAN - 2][(r >> 8) & 255] ^ _TABLE[SPAN - 3][(r >> 16) & 255] ^ _TABLE[SPAN - 4][r >> 24]


def crc32(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC-32 of ``data[start:end]`` for each span; spans may overlap."""
    out = np.zeros(len(starts), np.uint32)
    sizes = ends - starts
    short = (sizes > 0) & (sizes <= SPAN)
    out[short] = _remainders(data, starts[short], ends[short])
    long = np.flatnonzero(sizes > SPAN)
    if len(long):
        blocks = -(-sizes[long] // SPAN)
        heads = np.concatenate([[0], np.cumsum(blocks)[:-1]])
        number = np.arange(blocks.sum()) - np.repeat(heads, blocks)
        block_ends = np.repeat(ends[long] - (blocks - 1) * SPAN, blocks) + number * SPAN
        block_starts = np.maximum(block_ends - SPAN, np.repeat(starts[long], blocks))
        parts = _remainders(data, block_starts, block_ends)
        folded, left = parts[heads], np.arange(len(long))
        for k in range(1, int(blocks.max())):
            left = left[blocks[left] > k]
            folded[left] = _shifted(folded[left]) ^ parts[heads[left] + k]
        out[long] = folded
    return out ^ _constants(sizes)


def _pieces(text: bytes) -> Iterator[tuple[bytes, bool]]:
    """The text in pieces cut between words; a later piece begins with the last word of the one before it (marked True)."""
    at, carried = 0, b""
    while len(text) - at > PIECE:
        part = np.frombuffer(text, np.uint8, PIECE, at)
        gaps = np.flatnonzero(~_WORD[part])
        if not len(gaps):  # a word of more than a piece: take the text up to its end
            rest = np.frombuffer(text, np.uint8, offset=at)
            stop = int(np.argmin(_WORD[rest])) if not _WORD[rest].all() else len(rest)
        else:
            stop = int(gaps[-1]) + 1
        piece = text[at : at + stop]
        yield carried + piece, bool(carried)
        whole = np.flatnonzero(_WORD[np.frombuffer(piece, np.uint8)])
        if len(whole):
            last = int(whole[-1]) + 1
            before = np.flatnonzero(~_WORD[np.frombuffer(piece, np.uint8, last)])
            carried = piece[int(before[-1]) + 1 if len(before) else 0 : last] + b" "
        at += stop
    yield carried + text[at:], bool(carried)


def _chunks(texts: list[str | None]) -> Iterator[tuple[list[int], list[bytes], list[bool]]]:
    """Texts of about ``PIECE`` bytes together: row numbers, pieces, and which begin with a word already counted."""
    rows, pieces, carried, size = [], [], [], 0
    for row, text in enumerate(texts):
        for piece, again in _pieces(text.encode().translate(LOWER_BYTES)) if text else ():
            rows.append(row)
            pieces.append(piece)
            carried.append(again)
            size += len(piece)
            if size >= PIECE:
                yield rows, pieces, carried
                rows, pieces, carried, size = [], [], [], 0
    if rows:
        yield rows, pieces, carried


def features(pieces: list[bytes], carried: list[bool], buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket and piece of each feature, and the new words of each piece."""
    joined = np.frombuffer(b" ".join(pieces), np.uint8)
    ends_of = np.cumsum(np.array([len(p) + 1 for p in pieces], np.int64))
    word = np.zeros(len(joined) + 2, bool)
    word[1:-1] = _WORD[joined]
    starts, ends = np.flatnonzero(~word[:-1] & word[1:]), np.flatnonzero(word[:-1] & ~word[1:])
    piece = np.searchsorted(ends_of, starts, "right")
    # words in a row, one space between them
    kept = word[1:-1] | word[2:]
    plain = np.where(word[1:-1], joined, np.uint8(32))[kept]
    moved = np.concatenate([[0], np.cumsum(kept)])
    starts, ends = moved[starts], moved[ends]
    first = np.ones(len(piece), bool)
    first[1:] = piece[1:] != piece[:-1]
    again = first & np.array(carried, bool)[piece]
    second = np.flatnonzero(~first)
    all_starts, all_ends = np.concatenate([starts[~again], starts[second - 1]]), np.concatenate([ends[~again], ends[second]])
    owner = np.concatenate([piece[~again], piece[second]])
    return crc32(plain, all_starts, all_ends) % np.uint32(buckets), owner, np.bincount(piece[~again], minlength=len(pieces))


def bucket_counts(docs: DataFrame, text_col: str = "text", buckets: int = BUCKETS) -> np.ndarray:
    """How many features of the whole table fall in each bucket; summed inside each task first."""
    bounded_batches(docs.sparkSession)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, pieces, carried in _chunks(batch.column(0).to_pylist()):
                total += np.bincount(features(pieces, carried, buckets)[0], minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(total[used], pa.int64())], ["bucket", "n"])

    rows = docs.select(F.col(text_col).alias("text")).mapInArrow(counted, "bucket int, n long")
    out = np.zeros(buckets, np.int64)
    for row in rows.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # one row a bucket
        out[row["bucket"]] = row["n"]
    return out


def gains(target: np.ndarray, corpus: np.ndarray) -> np.ndarray:
    """Thousandths of the log of smoothed shares, target over corpus."""
    size, t_sum, s_sum = len(corpus), int(target.sum()), int(corpus.sum())
    return np.array(
        [math.floor(1000 * math.log(((t + 1) * float(s_sum + size)) / ((s + 1) * float(t_sum + size)))) for t, s in zip(target.tolist(), corpus.tolist())],
        np.int64,
    )


def weights(docs: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, n_features, weight): the floored mean gain of a text's features."""
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def weighed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, n, total = (np.zeros(batch.num_rows, np.int64) for _ in range(3))
            for numbers, pieces, carried in _chunks(batch.column("text").to_pylist()):
                bucket, owner, words = features(pieces, carried, len(gain))
                at = np.array(numbers)
                np.add.at(n_words, at, words)
                np.add.at(n, at, np.bincount(owner, minlength=len(pieces)))
                sums = np.zeros(len(pieces), np.int64)
                np.add.at(sums, owner, gain[bucket])
                np.add.at(total, at, sums)
            mean = np.where(n > 0, total // np.maximum(n, 1), 0)
            columns = [batch.column("id"), *(pa.array(c, pa.int64()) for c in (n_words, n, mean))]
            yield pa.RecordBatch.from_arrays(columns, ["id", "n_words", "n_features", "weight"])

    return rows.mapInArrow(weighed, f"id {kind}, n_words long, n_features long, weight long")


def ranked(scored: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS) -> DataFrame:
    """Append ``rank`` to (id, n_words, score, part, ...): 1, 2, ... for the drawn rows, null for the others.

    Scores are whole numbers between the bounds of gain and noise (some 100,000
    values), so the table of their counts is small whatever the rows.
    """
    able = F.col("n_words") >= min_words
    counts = saved(scored.where(able).groupBy("score").agg(F.count(F.lit(1)).alias("n")))
    drawn = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"] * percent // 100
    higher = Window.orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("score", F.coalesce(F.sum("n").over(higher), F.lit(0)).alias("before"))
    cut = before.where(F.col("before") < drawn).agg(F.min("score").alias("cut")).first()["cut"]
    top = able & (F.col("score") >= F.lit(cut)) if cut is not None else F.lit(False)
    top_rows = scored.where(top).join(F.broadcast(before.where(F.col("before") < drawn)), "score")
    # rows of one id and score count by partition, so that no id gathers in one task
    group = ["score", "id", "part"]
    inside = Window.partitionBy("score").orderBy(F.asc_nulls_first("id"), "part").rowsBetween(Window.unboundedPreceding, -1)
    groups = top_rows.groupBy(*group).agg(F.count(F.lit(1)).alias("n"))
    groups = groups.select(*group, F.coalesce(F.sum("n").over(inside), F.lit(0)).alias("earlier"))
    keyed = groups.select(F.col("score").alias("_s"), F.col("id").alias("_i"), F.col("part").alias("_p"), "earlier")
    same = (F.col("score") == F.col("_s")) & F.col("id").eqNullSafe(F.col("_i")) & (F.col("part") == F.col("_p"))
    place = F.col("before") + F.col("earlier") + F.row_number().over(Window.partitionBy(*group).orderBy("n_features"))
    placed = top_rows.join(keyed, same).select(*scored.columns, place.cast("long").alias("rank"))
    placed = placed.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    return placed.unionByName(scored.where(~F.coalesce(top, F.lit(False))).withColumn("rank", F.lit(None).cast("long")))


def resample(
    docs: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_col: str = "text",
    seed: int = SEED,
    percent: int = PERCENT,
    min_words: int = MIN_WORDS,
    buckets: int = BUCKETS,
) -> DataFrame:
    """(id, n_words, n_features, weight, score, rank) of every row; rank is null for rows that are not drawn."""
    gain = gains(bucket_counts(target, target_col, buckets), bucket_counts(docs, text_col, buckets))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))
    weighed = weights(docs, gain, id_col, text_col).withColumn("score", F.col("weight") + noise)
    return ranked(saved(weighed.withColumn("part", F.spark_partition_id())), percent, min_words).drop("part")
