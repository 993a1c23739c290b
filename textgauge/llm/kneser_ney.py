"""Interpolated modified Kneser-Ney bigram model, counted by Spark and memory-mapped.

Method: words and pairs are counted in Spark tasks; sums made inside a task are
shuffled as packed arrays, so a frequent word or pair is one entry per task.
The model is a set of sorted arrays in files below the folder that all machines
share: word hashes with their counts, and hashes of word pairs with theirs.
Workers map the files into memory, so its pages are shared on a machine and only
those needed are read; a batch of texts is looked up with its keys sorted.

    p(w|v) = max(c(v,w) - D(c(v,w)), 0) / c(v) + gamma(v) p(w)
    p(w)   = max(n(w) - d(n(w)), 0) / n + gamma / (V + 1)

n(w) is the number of different words before w; D and d have separate values
for counts 1, 2 and 3 or more, from the counts of counts (Chen and Goodman).
gamma gives back what was discounted; an unknown word gets gamma / (V + 1).

A word's id is its place among the sorted hashes; a pair is the number
v * (V + 1) + w, exact below 2^32 words (more are an error), and its hash a
multiplication by an odd number, which is one-to-one. Shards are ranges of
hashes, and their number grows with the tokens counted.

Defined results: a null or empty text is its end alone. Without training texts
every token has probability 1. Repeated rows count, and are scored, repeatedly.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textgauge.llm.common import bounded_batches, checkpoint_dir, saved, words_of

#: No word holds white space, so these two are free.
END, BEGIN = xxhash.xxh64_intdigest(b"\n"), xxhash.xxh64_intdigest(b" ")
ODD = np.uint64(0x9E3779B97F4A7C15)
#: Entries of a shard, about; and entries that a task adds up before it sends them.
SHARD_ENTRIES = 2_000_000
HELD_ENTRIES = 1_500_000
BATCH_ROWS = 1000
PACKED = "shard int, keys binary, counts binary"
U64 = np.uint64


def pack(values: np.ndarray) -> bytes:
    """Sorted unsigned numbers as differences, byte by byte, which compresses well."""
    steps = np.diff(values, prepend=U64(0)).astype("<u8")
    return steps.view(np.uint8).reshape(-1, 8).T.tobytes()


def unpack(data: bytes | pa.Buffer) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u8").ravel(), dtype=U64)


def summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, with the sums of their counts."""
    key, count = np.concatenate([np.empty(0, U64), *keys]), np.concatenate([np.empty(0, np.int64), *counts])
    order = np.argsort(key, kind="stable")
    key, count = key[order], count[order]
    heads = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.empty(0, np.int64)
    return key[heads], (np.add.reduceat(count, heads) if len(heads) else count)


def shard_of(hashes: np.ndarray, shards: int) -> np.ndarray:
    """Which of equal ranges of 64 bits a hash is in."""
    return ((hashes >> U64(32)) * U64(shards)) >> U64(32)


def tokens(text: str | None) -> np.ndarray:
    """Hashes of a text's words and its end."""
    words = words_of(text)
    return np.append(np.fromiter(map(xxhash.xxh64_intdigest, words), U64, len(words)), U64(END))


def _shared(folder: str) -> str:
    """The local path of a shared folder; files are mapped, so it must be mounted."""
    if "://" in folder and not folder.startswith("file://"):
        raise ValueError(f"{folder} can't be memory-mapped: name a mounted folder in spark.checkpoint.dir")
    return folder.removeprefix("file://").removeprefix("file:")


def _counted(texts: DataFrame, keys_of: Callable[[list], np.ndarray], hash_of: Callable[[np.ndarray], np.ndarray], shards: int) -> DataFrame:
    """Sums of each task, one packed row per shard."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def sent() -> pa.RecordBatch:
            key, count = summed([k for k, _ in held], [c for _, c in held])
            shard = shard_of(hash_of(key), shards)
            order = np.argsort(shard, kind="stable")
            cuts = np.searchsorted(shard[order], np.arange(shards + 1))
            parts = [order[a:b] for a, b in zip(cuts[:-1], cuts[1:])]
            full = [k for k, p in enumerate(parts) if len(p)]
            columns = [
                pa.array(full, pa.int32()),
                pa.array([pack(key[parts[k]]) for k in full], pa.binary()),
                pa.array([count[parts[k]].astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes() for k in full], pa.binary()),
            ]
            return pa.RecordBatch.from_arrays(columns, names=["shard", "keys", "counts"])

        for batch in batches:
            held.append(np.unique(keys_of(batch.column(0).to_pylist()), return_counts=True))
            if sum(len(k) for k, _ in held) > HELD_ENTRIES:
                merged = summed([k for k, _ in held], [c for _, c in held])
                held = [merged]
                if len(merged[0]) > HELD_ENTRIES // 2:
                    yield sent()
                    held = []
        if held:
            yield sent()

    return texts.mapInArrow(made, PACKED)


def _merged(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    keys = [unpack(k.as_buffer()) for k in table.column("keys")]
    planes = [np.frombuffer(c.as_buffer(), np.uint8).reshape(8, -1) for c in table.column("counts")]
    return summed(keys, [np.ascontiguousarray(p.T).view("<u8").ravel().astype(np.int64) for p in planes])


def _kind(name: str) -> str:
    """Counts are 4 bytes wide where all of a shard fit; the name ends with the width."""
    return "<u8" if name.endswith("-8") else "<u4"


class Model(NamedTuple):
    """What scoring needs beside the files: one entry per shard."""

    folder: str
    words: tuple[tuple[str, int], ...]  # file and entries of each shard, in order of hashes
    pairs: tuple[tuple[str, int], ...]
    blocks: tuple[str, ...]
    tokens: int
    distinct: int
    pair_discounts: tuple[float, float, float]
    word_discounts: tuple[float, float, float]
    continuations: int
    discounted_words: tuple[int, int, int]
    block: int


#: Ids of a block of context and continuation counts; one task adds up a block's partial sums of all shards.
BLOCK = 1 << 17


class Lookup:
    """Sorted arrays of a model's files, mapped into memory."""

    def __init__(self, folder: str, files: tuple[tuple[str, int], ...]):
        self.shards = len(files)
        self.keys = [np.memmap(f"{folder}/{n}.keys", "<u8", "r", shape=(size,)) if size else np.empty(0, U64) for n, size in files]
        self.counts = [np.memmap(f"{folder}/{n}.counts", _kind(n), "r", shape=(size,)) if size else np.empty(0, np.uint32) for n, size in files]
        self.offsets = np.concatenate([[0], np.cumsum([size for _, size in files])])

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place among all keys (-1: none) and count of each of some sorted hashes."""
        place, count = np.full(len(hashes), -1, np.int64), np.zeros(len(hashes), np.int64)
        cuts = np.searchsorted(shard_of(hashes, self.shards), np.arange(self.shards + 1)) if self.shards else [0]
        for k in range(self.shards):
            a, b = cuts[k], cuts[k + 1]
            if a < b and len(self.keys[k]):
                at = np.minimum(np.searchsorted(self.keys[k], hashes[a:b]), len(self.keys[k]) - 1)
                same = self.keys[k][at] == hashes[a:b]
                place[a:b] = np.where(same, at + self.offsets[k], -1)
                count[a:b] = np.where(same, self.counts[k][at], 0)
        return place, count


@lru_cache(maxsize=2)
def _lookup(folder: str, files: tuple[tuple[str, int], ...]) -> Lookup:
    return Lookup(folder, files)


def _saved_shards(packed: DataFrame, folder: str, shards: int, key_of: Callable[[np.ndarray], np.ndarray], more: Callable | None = None) -> list:
    """Write each shard's sorted arrays; rows (shard, name, size, total, and up to 4 counts of counts)."""

    def written(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        code, count = _merged(table)
        wide = "8" if len(count) and count.max() >= 2**32 else "4"
        name, hashes = f"{shard}-{uuid.uuid4().hex}-{wide}", key_of(code)
        order = np.argsort(hashes)
        hashes[order].astype("<u8").tofile(f"{folder}/{name}.keys")
        count[order].astype(_kind(name)).tofile(f"{folder}/{name}.counts")
        of = [int((count == k).sum()) for k in range(1, 5)]
        return pa.table(
            {"shard": pa.array([shard], pa.int32()), "name": [name], "size": [len(code)], "total": [int(count.sum())], "of": pa.array([of], pa.list_(pa.int64()))}
        )

    found = packed.groupBy("shard").applyInArrow(written, "shard int, name string, size long, total long, of array<long>")
    return saved(found).orderBy("shard").collect()  # one row a shard


def _files(rows: list, shards: int) -> tuple[tuple[str, int], ...]:
    by = {r["shard"]: (r["name"], r["size"]) for r in rows}
    return tuple(by.get(k, ("", 0)) for k in range(shards))


def discounts(of: list[int]) -> tuple[float, float, float]:
    """Discounts of counts 1, 2 and 3 or more, from how many keys have count 1, 2, 3 and 4."""
    n1, n2, n3, n4 = of
    if not (n1 and n2 and n3):
        return 0.5, 0.75, 1.0  # too few counts to estimate from
    y = n1 / (n1 + 2 * n2)
    values = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
    return tuple(float(np.clip(v, 0.05, k)) for k, v in enumerate(values, 1))


def _contexts(pairs: list, folder: str, distinct: int, width: int, spark: SparkSession) -> tuple[tuple[str, ...], int, list[int], tuple[int, int, int]]:
    """Dense files per block of ids: followers with count 1, 2, 3+, all, and words before.

    Partial sums of each shard of pairs are shuffled by block of ids.
    """
    base = U64(distinct + 1)

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, size in zip(batch.column("name").to_pylist(), batch.column("size").to_pylist()):
                code = np.fromfile(f"{folder}/{name}.keys", "<u8") * _INVERSE
                count = np.fromfile(f"{folder}/{name}.counts", _kind(name)).astype(np.int64)
                v, w = code // base, code % base
                columns = [(v, (count == 1).astype(np.int64)), (v, (count == 2).astype(np.int64)), (v, (count >= 3).astype(np.int64)), (v, count), (w, np.ones(size, np.int64))]
                for kind, (ids, amounts) in enumerate(columns):
                    key, total = summed([ids[amounts > 0]], [amounts[amounts > 0]])
                    cuts = np.searchsorted(key, np.arange(0, distinct + 1 + width, width).astype(U64))
                    for k in range(len(cuts) - 1):
                        a, b = cuts[k], cuts[k + 1]
                        if a < b:
                            packed = total[a:b].astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()
                            yield pa.RecordBatch.from_arrays(
                                [pa.array([k], pa.int32()), pa.array([kind], pa.int32()), pa.array([pack(key[a:b])], pa.binary()), pa.array([packed], pa.binary())],
                                names=["block", "kind", "keys", "counts"],
                            )

    def dense(table: pa.Table) -> pa.Table:
        block = table.column("block")[0].as_py()
        size = min(width, distinct + 1 - block * width)
        out = np.zeros((5, size), np.int64)
        for kind, keys, counts in zip(*(table.column(c) for c in ("kind", "keys", "counts"))):
            planes = np.frombuffer(counts.as_buffer(), np.uint8).reshape(8, -1)
            at = (unpack(keys.as_buffer()) - U64(block * width)).astype(np.int64)
            out[kind.as_py(), at] += np.ascontiguousarray(planes.T).view("<u8").ravel().astype(np.int64)
        name = f"block-{block}-{uuid.uuid4().hex}"
        out.tofile(f"{folder}/{name}")
        before = out[4]
        of = [int((before == k).sum()) for k in range(1, 5)]
        return pa.table({"block": pa.array([block], pa.int32()), "name": [name], "n": [int(before.sum())], "of": pa.array([of], pa.list_(pa.int64())), "more": [int((before >= 3).sum())]})

    listed = spark.createDataFrame([(r["name"], r["size"]) for r in pairs], "name string, size long").repartition(max(1, len(pairs)))
    sums = listed.mapInArrow(parts, "block int, kind int, keys binary, counts binary")
    rows = saved(sums.groupBy("block").applyInArrow(dense, "block int, name string, n long, of array<long>, more long")).orderBy("block").collect()
    of = [sum(r["of"][k] for r in rows) for k in range(4)]
    return tuple(r["name"] for r in rows), sum(r["n"] for r in rows), of, (of[0], of[1], sum(r["more"] for r in rows))


_INVERSE = U64(pow(int(ODD), -1, 1 << 64))


def train(texts: DataFrame, text_col: str = "text", folder: str | None = None, block: int = BLOCK) -> Model:
    """Count and store the model of ``texts``."""
    spark = texts.sparkSession
    folder = _shared(folder or f"{checkpoint_dir(spark)}/kneser-ney-{uuid.uuid4().hex}")
    path = spark._jvm.org.apache.hadoop.fs.Path(f"file://{folder}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(path)
    bounded_batches(spark, BATCH_ROWS)
    texts = texts.select(F.col(text_col).alias("text"))
    # about six bytes a word: only the number of shards depends on it
    roughly = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"] // 6
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-roughly // SHARD_ENTRIES))

    def word_keys(rows: list) -> np.ndarray:
        return np.concatenate([np.empty(0, U64), *map(tokens, rows)])

    words = _saved_shards(_counted(texts, word_keys, lambda k: k, shards), folder, shards, lambda k: k)
    distinct, total = sum(r["size"] for r in words), sum(r["total"] for r in words)
    if distinct >= 2**32 - 1:
        raise ValueError("more than 2^32 distinct words")
    files = _files(words, shards)
    begin, base = distinct, U64(distinct + 1)

    def pair_keys(rows: list) -> np.ndarray:
        made = [tokens(t) for t in rows]
        known, inverse = np.unique(np.concatenate([np.empty(0, U64), *made]), return_inverse=True)
        ids = _lookup(folder, files).find(known)[0][inverse].astype(U64)
        before = np.empty_like(ids)
        before[1:] = ids[:-1]
        before[np.cumsum([0, *map(len, made[:-1])])] = U64(begin)
        return before * base + ids

    pairs = _saved_shards(_counted(texts, pair_keys, lambda k: k * ODD, shards), folder, shards, lambda k: k * ODD)
    blocks, continuations, of_words, classes = _contexts(pairs, folder, distinct, block, spark)
    of_pairs = [sum(r["of"][k] for r in pairs) for k in range(4)]
    return Model(folder, files, _files(pairs, shards), blocks, total, distinct, discounts(of_pairs), discounts(of_words), continuations, classes, block)


def _discount(counts: np.ndarray, values: tuple[float, float, float]) -> np.ndarray:
    return np.maximum(counts - np.array([0.0, *values])[np.minimum(counts, 3)], 0.0)


class Scorer:
    """Scores batches of texts with a model's mapped files."""

    def __init__(self, model: Model):
        self.model = model
        self.words, self.pairs = _lookup(model.folder, model.words), Lookup(model.folder, model.pairs)
        size = model.distinct + 1
        self.blocks = [np.memmap(f"{model.folder}/{n}", np.int64, "r").reshape(5, -1) for n in model.blocks]
        self.size = size

    def _of_ids(self, ids: np.ndarray) -> np.ndarray:
        """The five numbers of each id; zeros where it is -1."""
        out = np.zeros((5, len(ids)), np.int64)
        block = ids // self.model.block  # -1 where there is no id
        order = np.argsort(block, kind="stable")
        held, starts = np.unique(block[order], return_index=True)
        for k, own in zip(held.tolist(), np.split(order, starts[1:])):
            if k >= 0:
                out[:, own] = self.blocks[k][:, ids[own] - k * self.model.block]
        return out

    def __call__(self, texts: list) -> list[tuple[int, int, float, float]]:
        """(tokens, known tokens, base score, score) of each text."""
        model = self.model
        made = [tokens(t) for t in texts]
        starts = np.cumsum([0, *map(len, made)])[:-1]
        known, inverse = np.unique(np.concatenate(made), return_inverse=True)
        ids, counts = self.words.find(known)
        base = np.log10((counts + 1.0) / (model.tokens + model.distinct + 1.0))
        if model.tokens == 0:
            return [(len(m), 0, float(base[inverse[a : a + len(m)]].sum()), 0.0) for a, m in zip(starts, made)]
        about = self._of_ids(ids)
        d1, d2, d3 = model.word_discounts
        left = sum(d * n for d, n in zip((d1, d2, d3), model.discounted_words)) / model.continuations
        single = _discount(about[4], model.word_discounts) / model.continuations + left / (model.distinct + 1)
        e1, e2, e3 = model.pair_discounts
        with np.errstate(divide="ignore", invalid="ignore"):
            gamma = np.where(about[3] > 0, (e1 * about[0] + e2 * about[1] + e3 * about[2]) / about[3], 1.0)
        first = self._of_ids(np.array([model.distinct]))[:, 0]
        before = np.empty(len(inverse), np.int64)
        before[1:] = inverse[:-1]
        at_start = np.zeros(len(inverse), bool)
        at_start[starts] = True
        before[starts] = 0
        w = ids[inverse]
        v = np.where(at_start, model.distinct, ids[before])
        context = np.where(at_start, first[3], about[3][before])
        rest = np.where(at_start, (e1 * first[0] + e2 * first[1] + e3 * first[2]) / max(1, first[3]), gamma[before])
        code = np.where((w >= 0) & (v >= 0), v.astype(U64) * U64(model.distinct + 1) + w.astype(U64), U64(0))
        hashes = code * ODD
        order = np.argsort(hashes)
        pair = np.empty(len(code), np.int64)
        pair[order] = self.pairs.find(hashes[order])[1]
        pair[(w < 0) | (v < 0)] = 0
        chance = np.where(context > 0, _discount(pair, model.pair_discounts) / np.maximum(context, 1), 0.0) + rest * single[inverse]
        scores, bases, seen = np.add.reduceat(np.log10(chance), starts), np.add.reduceat(base[inverse], starts), np.add.reduceat((counts > 0)[inverse].astype(np.int64), starts)
        return [(len(m), int(k), float(b), float(s)) for m, k, b, s in zip(made, seen, bases, scores)]


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, n_known, base_score, score, perplexity) of every row."""
    bounded_batches(docs.sparkSession, BATCH_ROWS)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # names of files, one a shard

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by = Scorer(shared.value)
        for batch in batches:
            if batch.num_rows:
                n, known, base, own = zip(*by(batch.column(1).to_pylist()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(n, pa.int64()), pa.array(known, pa.int64()), pa.array(base), pa.array(own)],
                    names=["id", "n_tokens", "n_known", "base_score", "score"],
                )

    kind = docs.schema[id_col].dataType.simpleString()
    found = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        scored, f"id {kind}, n_tokens long, n_known long, base_score double, score double"
    )
    return found.withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))
