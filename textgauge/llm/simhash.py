"""SimHash near-duplicates through a Gray-order hierarchical index.

Method: a text's fingerprint has a bit set where over half of its shingles'
XXH64 (seed 42) have it. Distinct fingerprints are sorted by Gray rank, the
place of a bit pattern in the reflected Gray code, so that neighbours differ in
few bits. Nodes over runs of neighbours hold the bits all of them share (a mask
and a pattern), less those the parent holds already. A search goes down from
the root, adds up the differences on the masked bits, and drops whole groups at
once when the sum passes the threshold.

Spark deals the work: fingerprints at 3 or fewer differing bits agree on one of
4 blocks of 16 bits, so the index is kept in four rotations, split by the block
that comes first; a split of the index is searched by the fingerprints in it.
A split with more than ``MAX_SPLIT`` fingerprints is split by a further block
of its free bits in the same way, until at most 2^21 are possible. Each split
returns a spanning forest of its links, never all pairs: groups of linked
fingerprints are merged while searching, and nodes that lie wholly inside the
searcher's group are skipped.

Defined results: a null or empty text has fingerprint zero and is linked like
any other. Rows with a null id get a class like others, and the class id is the
smallest id that is not null. Repeated rows give repeated rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textgauge.llm.common import bounded_batches, join_hot, saved, words_of
from textgauge.llm.components import components, contracted

SEED = 42
BITS = 3
MAX_SPLIT = 50_000
FAN = 8
#: (searcher, node) pairs held at once.
FRONTIER = 1 << 18
#: Searchers between two merges of groups.
BLOCK = 1 << 10
#: Hashes of a long text whose bits are counted at once.
_CHUNK = 1 << 18


def shingle_hashes(words: list[bytes], size: int) -> np.ndarray:
    """XXH64 of each run of ``size`` words; of the whole, if there are fewer."""
    if not words:
        return np.empty(0, np.uint64)
    if len(words) <= size:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)], np.uint64)
    text = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate([[0], ends[:-size]]).tolist()
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(text[a:b], SEED) for a, b in zip(starts, (ends[size - 1 :] - 1).tolist())), np.uint64, len(starts))


def fingerprint(hashes: np.ndarray) -> int:
    """Bits set in over half of the hashes, as an unsigned integer."""
    if not len(hashes):
        return 0
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), _CHUNK):
        part = hashes[at : at + _CHUNK].astype(">u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(id, fp) of every row; fp as a signed long."""
    bounded_batches(docs.sparkSession)

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(shingle_hashes(words_of(t), shingle)) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.array(prints, np.uint64).view(np.int64))], names=["id", "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(made, f"id {kind}, fp long")


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Place of each pattern in the reflected Gray code."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class GrayIndex:
    """Several splits of the index, each a run of fingerprints in Gray order."""

    def __init__(self, split: np.ndarray, codes: np.ndarray):
        order = np.lexsort((gray_rank(codes), split))
        self.order, self.codes, split = order, codes[order], split[order]
        self.group = np.arange(len(codes))
        levels = [(self.codes, self.codes, split, np.arange(len(codes)), np.arange(len(codes)) + 1)]
        while True:
            both, either, of, first, last = levels[-1]
            starts = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
            place = np.arange(len(of)) - np.repeat(starts, np.diff(np.append(starts, len(of))))
            heads = np.flatnonzero(place % FAN == 0)
            if len(heads) == len(of):
                break
            stops = np.append(heads[1:], len(of))
            levels.append((np.bitwise_and.reduceat(both, heads), np.bitwise_or.reduceat(either, heads), of[heads], heads, stops))
        levels.reverse()  # the roots, one for each split, come first
        self.patterns, self.masks, self.first, self.last, self.entry = [], [], [], [], []
        above = None
        for k, (both, either, of, first, last) in enumerate(levels):
            mask = ~(both ^ either)
            if k:
                parent = np.repeat(np.arange(len(levels[k - 1][2])), levels[k - 1][4] - levels[k - 1][3])
                rest = mask & ~above[parent]
            else:
                rest = mask
            above = mask
            self.patterns.append(both)
            self.masks.append(rest)
            self.first.append(first)
            self.last.append(last)
        leaf_first, leaf_last = np.arange(len(codes)), np.arange(len(codes)) + 1
        spans = [(leaf_first, leaf_last)]
        for first, last in zip(self.first[-2::-1], self.last[-2::-1]):
            low, high = spans[-1]
            spans.append((low[first], high[last - 1]))
        self.spans = spans[::-1]
        roots = self.spans[0]
        self.root_of = np.repeat(np.arange(len(roots[0])), roots[1] - roots[0])

    def links(self, bits: int) -> np.ndarray:
        """For each fingerprint, in the order given, one of its group: the group's first."""
        for at in range(0, len(self.codes), BLOCK):
            searchers = np.arange(at, min(at + BLOCK, len(self.codes)))
            uniform = [np.minimum.reduceat(self.group, low) == np.maximum.reduceat(self.group, low) for low, _ in self.spans]
            self._descend(0, searchers, self.root_of[searchers], np.zeros(len(searchers), np.int64), bits, uniform)
        out = np.empty(len(self.order), np.int64)
        out[self.order] = self.order[self.group]
        return out

    def _descend(self, level: int, who: np.ndarray, node: np.ndarray, sums: np.ndarray, bits: int, uniform: list) -> None:
        while True:
            sums = sums + np.bitwise_count((self.codes[who] ^ self.patterns[level][node]) & self.masks[level][node])
            low, high = self.spans[level]
            inside = uniform[level][node] & (self.group[low[node]] == self.group[who])
            go = (sums <= bits) & (high[node] > who + 1) & ~inside
            who, node, sums = who[go], node[go], sums[go]
            if not len(who):
                return
            if level == len(self.patterns) - 1:
                self._merge(who, node)
                return
            first, size = self.first[level][node], self.last[level][node] - self.first[level][node]
            level += 1
            total = int(size.sum())
            if total > FRONTIER and len(who) > 1:
                for a in range(0, len(who), FRONTIER // FAN):
                    part = slice(a, a + FRONTIER // FAN)
                    self._descend(level, *self._children(who[part], first[part], size[part], sums[part]), bits, uniform)
                return
            who, node, sums = self._children(who, first, size, sums)

    @staticmethod
    def _children(who, first, size, sums):
        rep = np.repeat(np.arange(len(who)), size)
        inner = np.arange(len(rep)) - np.repeat(np.cumsum(size) - size, size)
        return who[rep], first[rep] + inner, sums[rep]

    def _merge(self, a: np.ndarray, b: np.ndarray) -> None:
        parent = np.arange(len(self.group))
        x, y = self.group[a], self.group[b]
        while True:
            apart = x != y
            if not apart.any():
                break
            x, y = x[apart], y[apart]
            np.minimum.at(parent, np.maximum(x, y), np.minimum(x, y))
            while True:
                up = parent[parent]
                if (up == parent).all():
                    break
                parent = up
            x, y = parent[x], parent[y]
        self.group = parent[self.group]


def _splits(prints: DataFrame) -> DataFrame:
    """(key, code, fp, free): each fingerprint in the split of each of its 4 blocks."""
    turned = F.explode(F.array(*[F.struct(F.lit(t).alias("t"), _rotated(F.col("fp"), 64, 16 * t).alias("code")) for t in range(4)]))
    rows = prints.select("fp", turned.alias("x")).select("fp", "x.*")
    return rows.select(F.xxhash64("t", F.shiftrightunsigned("code", 48)).alias("key"), "code", "fp", F.lit(48).alias("free"))


def _rotated(code, free: int, by: int):
    """The lowest ``free`` bits of ``code`` turned left by ``by``."""
    if not by:
        return code
    mask = (1 << free) - 1
    low = code if free == 64 else code.bitwiseAND(F.lit(mask))
    turned = F.shiftleft(low, by).bitwiseOR(F.shiftrightunsigned(low, free - by))
    return turned if free == 64 else turned.bitwiseAND(F.lit(mask)).bitwiseOR(code.bitwiseAND(F.lit(~mask)))


def _split_further(rows: DataFrame, free: int, bits: int) -> DataFrame:
    """Splits of one size of free bits by each of 4 blocks of these bits."""
    width = free // 4
    turned = F.explode(F.array(*[F.struct(F.lit(t).alias("t"), _rotated(F.col("code"), free, width * t).alias("code")) for t in range(4)]))
    rows = rows.select("key", "fp", turned.alias("x")).select("key", "fp", "x.*")
    head = F.shiftrightunsigned("code", free - width)
    return rows.select(F.xxhash64("key", "t", head).alias("key"), "code", "fp", F.lit(free - width).alias("free"))


def links(prints: DataFrame, bits: int = BITS, max_split: int = MAX_SPLIT) -> DataFrame:
    """(a, b) between distinct fingerprints: a spanning forest of each task's links.

    ``prints`` has one row per distinct ``fp``; 4 blocks find up to 3 differing bits.
    """
    if not 0 <= bits <= 3:
        raise ValueError("4 blocks find at most 3 differing bits")
    rows, ready, free = _splits(prints), None, 48
    while free > 21:
        large = saved(rows.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > max_split).select("key"))
        if large.isEmpty():
            break
        small = rows.join(large, "key", "left_anti")
        ready = small if ready is None else ready.unionByName(small)
        rows, free = _split_further(rows.join(large, "key", "left_semi"), free, bits), free - free // 4
    rows = rows if ready is None else ready.unionByName(rows)

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        count = 0

        def found(part: np.ndarray) -> pa.RecordBatch:
            _, split = np.unique(part[:, 0], return_inverse=True)
            first = GrayIndex(split, part[:, 1].view(np.uint64)).links(bits)
            linked = first != np.arange(len(first))
            return pa.RecordBatch.from_arrays([pa.array(part[linked, 2]), pa.array(part[first[linked], 2])], names=["a", "b"])

        for batch in batches:
            part = np.stack([c.to_numpy() for c in batch.columns], axis=1)
            held.append(part)
            count += len(part)
            if count >= max_split:
                whole = np.concatenate(held)
                last = np.flatnonzero(whole[:, 0] != whole[-1, 0])
                done = last[-1] + 1 if len(last) else 0  # the last split may go on
                if done:
                    yield found(np.ascontiguousarray(whole[:done]))
                held = [whole[done:]]
                count = len(whole) - done if done else 0
        if held and sum(map(len, held)):
            yield found(np.ascontiguousarray(np.concatenate(held)))

    dealt = rows.select("key", "code", "fp").repartition(int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions")), "key").sortWithinPartitions("key")
    return dealt.mapInArrow(lambda batches: contracted(searched(batches)), "a long, b long")


def classes(prints: DataFrame, bits: int = BITS) -> DataFrame:
    """(fp, n, component_id) per distinct fingerprint of ``prints`` (id, fp)."""
    distinct = saved(prints.groupBy("fp").agg(F.count("*").alias("n"), F.min("id").alias("first")))
    bounded_batches(prints.sparkSession, 10_000)
    roots = components(links(distinct.select("fp"), bits), forests=True)
    rooted = distinct.join(roots, distinct["fp"] == roots["node"], "left").select("fp", "n", "first", F.coalesce("root", "fp").alias("root"))
    named = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return rooted.join(named, "root").select("fp", "n", "component_id")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, bits: int = BITS) -> DataFrame:
    """(id, fp, component_id) of every row."""
    prints = saved(fingerprints(docs, id_col, text_col, shingle))
    return join_hot(prints, saved(classes(prints, bits)), ["fp"], "n").select("id", "fp", "component_id")
