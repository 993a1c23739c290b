"""Removal of every byte that lies in a string of ``LENGTH`` bytes found elsewhere too.

Method: threshold-bounded interval expansion. The Burrows-Wheeler transform of
a shard of strings is searched backwards, breadth first: from the intervals of
single symbols, each round puts one symbol before the strings of the round
before it. An interval that ends at a boundary not yet known names the common
prefix there, so the rounds find all common prefixes by increasing value. They
stop at ``LENGTH``: boundaries then unknown join suffixes that agree in
``LENGTH`` bytes or more, and such a class with two places is repeated text.

Shards: the transform of a whole corpus fits no task, so places are brought
together by content first. Each window of ``LENGTH`` bytes has an anchor, the
smallest hash of its ``GRAM``-byte strings (leftmost of equals), so equal
windows have equal anchors. A piece is a run of windows with one anchor. Pieces
are counted by anchor before any text is moved: an anchor found once in the
corpus has no copy, and of pieces that are equal to the byte (128 bits of hash)
only one goes on, with their number as its weight. The texts of these are
fetched and go to the shard of their anchor.

Skew: copies are put together inside each task first. An anchor whose pieces
differ in many ways is dealt out by piece where a task alone sees more than
``SPREAD`` of them, so what one task gets of an anchor is bounded by the number
of tasks. An anchor with more than ``GROUP`` different pieces would fill a
shard: its windows are counted one by one by a hash of all their bytes, and
those found twice are pieces of their own, whose shard holds one text.

Texts are shuffled once, by row key, and met by their hits and by their marks;
both joins ask for the same exchange. Lost executors cost a recomputation of
their parts; hits are kept in the shared folder.

Memory: texts are worked on in blocks of ``STEP`` bytes, tasks let go of the
pieces they gathered every ``HELD`` bytes, a shard has ``SHARD`` bytes and the
rest of its last anchor.

Defined results: a null text is empty; texts shorter than ``LENGTH`` lose
nothing; rows are documents of their own, so rows that are equal, id and text,
are copies of each other. Only the id and the operator's own columns are
returned, so further columns cannot clash. The kept bytes are binary, as a run
may begin or end inside a character.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textgauge.llm.common import bounded_batches, row_key, saved
from textgauge.session import fits

LENGTH, GRAM = 200, 32
GROUP, SPREAD = 8192, 64
STEP = 1 << 18
HELD = 48 << 20
SHARD = 1 << 20
#: Anchors with many surroundings: 8 bytes each, so at most 1 MB is broadcast; more are joined by salted shuffle.
BROADCAST_ROWS = 100_000
SALTS = 32
_PLACE = np.uint64((1 << 20) - 1)
_BASE = 0x9E3779B97F4A7C15
_CODES = np.random.default_rng(11).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _powers(base: int) -> np.ndarray:
    out = np.full(1 << 20, base, np.uint64)
    out[0] = 1
    return np.cumprod(out)


_UP, _DOWN = _powers(_BASE), _powers(pow(_BASE, -1, 1 << 64))
_UP_2, _DOWN_2 = _powers(_BASE ^ 0x5555555555555554), _powers(pow(_BASE ^ 0x5555555555555554, -1, 1 << 64))


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


class Block:
    """Parts of texts side by side, with two hashes of any of their substrings."""

    def __init__(self, parts: list[bytes], length: int, gram: int):
        seen = np.frombuffer(b"".join(parts), np.uint8)
        codes = _CODES[seen]
        self.sums, self.sums_2 = np.zeros(len(seen) + 1, np.uint64), np.zeros(len(seen) + 1, np.uint64)
        np.cumsum(codes * _UP[: len(seen)], out=self.sums[1:])
        np.cumsum(codes * _UP_2[: len(seen)], out=self.sums_2[1:])
        sizes = np.array([len(p) for p in parts], np.int64)
        self.heads = np.cumsum(sizes) - sizes
        self.sizes, self.length, self.gram = sizes, length, gram

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return _mixed((self.sums[ends] - self.sums[starts]) * _DOWN[starts])

    def hashes_2(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return _mixed((self.sums_2[ends] - self.sums_2[starts]) * _DOWN_2[starts])

    def runs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Part, anchor, first and last window of each run of windows with one anchor."""
        grams = len(self.sums) - self.gram
        places = np.arange(grams, dtype=np.uint64)
        least = (_mixed((self.sums[self.gram :] - self.sums[: -self.gram]) * _DOWN[:grams]) & ~_PLACE) | places
        width, have = self.length - self.gram + 1, 1
        while 2 * have <= width:
            least = np.minimum(least[:-have], least[have:])
            have *= 2
        if have < width:
            least = np.minimum(least[: have - width], least[width - have :])
        anchor = (least & _PLACE).astype(np.int64)
        part = np.repeat(np.arange(len(self.sizes)), self.sizes)[: len(anchor)]
        inside = np.arange(len(anchor)) <= (self.heads + self.sizes - self.length)[part]
        new = np.ones(len(anchor), bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (part[1:] != part[:-1])
        first = np.flatnonzero(new & inside)
        stops = np.append(np.flatnonzero(new), len(anchor))
        last = np.minimum(stops[np.searchsorted(stops, first, "right")] - 1, (self.heads + self.sizes - self.length)[part[first]])
        return part[first], anchor[first], first, last


def blocks(texts: list[str | None], length: int) -> Iterator[tuple[list[int], list[int], list[bytes]]]:
    """Row, offset and bytes of parts that together have about ``STEP`` bytes; long texts are cut with an overlap that keeps each window whole."""
    rows, offsets, parts, size = [], [], [], 0
    for row, text in enumerate(texts):
        data = text.encode() if text else b""
        for at in range(0, len(data) - length + 1, STEP):
            part = data[at : at + STEP + length - 1]
            rows.append(row)
            offsets.append(at)
            parts.append(part)
            size += len(part)
            if size >= STEP:
                yield rows, offsets, parts
                rows, offsets, parts, size = [], [], [], 0
    if rows:
        yield rows, offsets, parts


# kind 0: a piece, its weight and one of its places; 1: how many pieces of an anchor a task deals out by piece;
# 2: windows that are known to have a copy; 3: a piece that is dealt out so
FOUND = "kind int, fp long, h1 long, h2 long, rk long, low long, wide long, n long"
MET = "kind int, fp long, rk long, low long, wide long, n long"


def _batch(fields: str, *columns) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    named = [f.split() for f in fields.split(", ")]
    arrays = [c if isinstance(c, pa.Array) else pa.array(c, kinds[k]) for c, (_, k) in zip(columns, named)]
    return pa.RecordBatch.from_arrays(arrays, [n for n, _ in named])


def _changes(*columns: np.ndarray) -> np.ndarray:
    """Where a row differs from the one before it."""
    new = np.ones(len(columns[0]), bool)
    new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return new


def _marked(rk: np.ndarray, low: np.ndarray, wide: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows, put together where they touch in one text."""
    order = np.lexsort((low, rk))
    rk, low, stop = rk[order], low[order], (low + wide)[order]
    new = np.ones(len(rk), bool)
    new[1:] = (rk[1:] != rk[:-1]) | (low[1:] > stop[:-1])
    heads = np.flatnonzero(new)
    top = np.maximum.reduceat(stop, heads) if len(heads) else stop
    return rk[heads], low[heads], top - low[heads]


def _met(fp, h1, h2, rk, low, wide, n, spread: int) -> pa.RecordBatch:
    """What a task says of its pieces: each different one with its weight, and the places of those it has twice."""
    order = np.lexsort((h2, h1, fp))
    fp, h1, h2, rk, low, wide, n = (x[order] for x in (fp, h1, h2, rk, low, wide, n))
    heads = np.flatnonzero(_changes(fp, h1, h2))
    weight = np.add.reduceat(n, heads)
    own = fp[heads]
    firsts = np.flatnonzero(_changes(own))
    pieces = np.diff(np.append(firsts, len(own)))
    kind = np.where(np.repeat(pieces, pieces) > spread, 3, 0)
    many = pieces > spread
    twice = np.repeat(weight, np.diff(np.append(heads, len(fp)))) > 1
    known = _marked(rk[twice], low[twice], wide[twice])
    sizes = len(heads), int(many.sum()), len(known[0])
    none = [np.zeros(k, np.int64) for k in sizes]
    join = lambda *parts: np.concatenate(parts)
    return _batch(
        FOUND,
        join(kind, none[1] + 1, none[2] + 2).astype(np.int32),
        join(own, own[firsts][many], none[2]),
        join(h1[heads], none[1], none[2]),
        join(h2[heads], none[1], none[2]),
        join(rk[heads], none[1], known[0]),
        join(low[heads], none[1], known[1]),
        join(wide[heads], none[1], known[2]),
        join(weight, pieces[many], none[2]),
    )


def _flushed(held: list[tuple], spread: int) -> pa.RecordBatch:
    return _met(*(np.concatenate(x).view(np.int64) for x in zip(*held)), spread)


def _pieces(texts: DataFrame, length: int, gram: int, spread: int) -> DataFrame:
    """The pieces of all texts, as each task meets them."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            keys = batch.column("rk").to_numpy()
            for at, offsets, parts in blocks(batch.column("text").to_pylist(), length):
                block = Block(parts, length, gram)
                part, anchor, low, high = block.runs()
                shift = np.array(offsets, np.int64) - block.heads
                ends = high + length
                held.append((
                    block.hashes(anchor, anchor + gram), block.hashes(low, ends), block.hashes_2(low, ends),
                    keys[np.array(at)[part]], low + shift[part], high - low + 1, np.ones(len(low), np.int64),
                ))
                size += 56 * len(low)
                if size >= HELD:
                    yield _flushed(held, spread)
                    held, size = [], 0
        if held:
            yield _flushed(held, spread)

    return texts.select("rk", "text").mapInArrow(found, FOUND)


def _windows(rows: DataFrame, length: int, gram: int, spread: int) -> DataFrame:
    """The windows of the pieces in ``runs``, one by one."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for rk, text, runs in zip(*(batch.column(c).to_pylist() for c in ("rk", "text", "runs"))):
                data = text.encode()
                for run in runs:
                    low, wide = run["low"], run["wide"]
                    block = Block([data[low : low + wide - 1 + length]], length, gram)
                    at = np.arange(wide)
                    h1, h2 = block.hashes(at, at + length), block.hashes_2(at, at + length)
                    held.append((h1, h1, h2, np.full(wide, rk), low + at, np.ones(wide, np.int64), np.full(wide, run["n"])))
                    size += 56 * wide
                if size >= HELD:
                    yield _flushed(held, spread)
                    held, size = [], 0
        if held:
            yield _flushed(held, spread)

    return rows.select("id", "rk", "text", "runs").mapInArrow(found, FOUND)


def _repeated(found: DataFrame, group: int) -> DataFrame:
    """Pieces whose anchor is found elsewhere (kind 0), anchors of more than ``group`` pieces (1), and windows known to have a copy (2)."""

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for batch in batches:
            rows = [batch.column(c).to_numpy() for c in ("kind", "fp", "h1", "h2", "rk", "low", "wide", "n")]
            known = rows[0] == 2
            if known.any():
                kind, fp, _, _, rk, low, wide, n = (x[known] for x in rows)
                yield _batch(MET, kind, fp, rk, low, wide, n)
            held.append([x[~known] for x in rows])
        if not held or not sum(len(x[0]) for x in held):
            return
        rows = list(map(np.concatenate, zip(*held)))
        held.clear()
        order = np.lexsort((rows[3], rows[2], rows[0] == 1, rows[1]))
        kind, fp, h1, h2, rk, low, wide, n = (x[order] for x in rows)
        counted = kind == 1
        firsts = np.flatnonzero(_changes(fp))
        owner = np.cumsum(_changes(fp)) - 1
        new = _changes(fp, h1, h2, counted) & ~counted
        different = np.bincount(owner, np.where(counted, n, new), len(firsts))
        total = np.bincount(owner, n, len(firsts))
        full = fp[firsts][different > group]
        # of equal pieces the first goes on, the places of the others are known to have a copy
        copies = ~counted & ~new & (n == 1)
        heads = np.flatnonzero(new)
        weight = np.add.reduceat(np.where(counted, 0, n), heads) if len(heads) else n[:0]
        hit = (total[owner[heads]] > 1) | (kind[heads] == 3)
        heads, weight = heads[hit], weight[hit]
        none = np.zeros(len(full), np.int64)
        yield _batch(MET, np.zeros(len(heads), np.int32), fp[heads], rk[heads], low[heads], wide[heads], weight)
        yield _batch(MET, np.ones(len(full), np.int32), full, none, none, none, none)
        marks = _marked(rk[copies], low[copies], wide[copies])
        none = np.zeros(len(marks[0]), np.int64)
        yield _batch(MET, (none + 2).astype(np.int32), none, *marks, none)

    deal = F.when(F.col("kind") == 2, F.col("rk")).when(F.col("kind") == 3, F.col("h1")).otherwise(F.col("fp"))
    return found.repartition(deal).mapInArrow(meet, MET)


def _by_text(texts: DataFrame, hits: DataFrame, *fields: str, how: str = "inner") -> DataFrame:
    """Texts with what was found in them; a hit's row key stands for equal rows, so sets are enough."""
    runs = hits.groupBy("rk").agg(F.collect_set(F.struct(*fields)).alias("runs"))
    return texts.join(runs.hint("shuffle_hash"), "rk", how)


SLICES = "key long, text binary, weight long, rk long, start long"


def _slices(rows: DataFrame, length: int) -> DataFrame:
    """The bytes of the pieces in ``runs``."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, out = [], []
            for rk, text, runs in zip(*(batch.column(c).to_pylist() for c in ("rk", "text", "runs"))):
                data = text.encode()
                keys += [rk] * len(runs)
                out += [(r["fp"], data[r["low"] : r["low"] + r["wide"] - 1 + length], r["n"], r["low"]) for r in runs]
                if len(out) >= 20_000:
                    fp, piece, n, low = zip(*out)
                    yield _batch(SLICES, fp, piece, n, keys, low)
                    keys, out = [], []
            if out:
                fp, piece, n, low = zip(*out)
                yield _batch(SLICES, fp, piece, n, keys, low)

    return rows.select("id", "rk", "text", "runs").mapInArrow(cut, SLICES)


def suffix_order(symbols: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Suffixes in order, by doubled prefixes. ``left`` is how far each place is from its string's end, where the symbol is 0; ends are in order of place."""
    n = len(symbols)
    bits = max(int(symbols.max()).bit_length(), 1)

    def followed(key: np.ndarray, more: np.ndarray, have: int, add: int) -> np.ndarray:
        """Keys of ``have`` symbols, then ``add`` more; nothing follows an end."""
        out = key << np.uint64(add * bits)
        if have < n:
            out[:-have] |= np.where(left[:-have] >= have, more[have:], np.uint64(0))
        return out

    keys, first = {1: symbols.astype(np.uint64)}, 1
    while 2 * first * bits <= 63:
        keys[2 * first] = followed(keys[first], keys[first], first, first)
        first *= 2
    key = keys[first]
    for size in sorted(keys, reverse=True)[1:]:
        if (first + size) * bits <= 63:
            key, first = followed(key, keys[size], first, size), first + size
    order = np.argsort(key).astype(np.int32)
    key = key[order]
    new = _changes(key)
    ended = np.flatnonzero(left[order] < first)
    order[ended] = order[ended][np.lexsort((order[ended], key[ended]))]
    new[ended] = True
    rank = np.empty(n, np.int32)
    heads = np.flatnonzero(new).astype(np.int32)
    sizes = np.diff(np.append(heads, n))
    rank[order] = np.repeat(heads, sizes)
    slots = np.flatnonzero(np.repeat(sizes, sizes) > 1).astype(np.int32)
    done = first
    while len(slots):
        places = order[slots]
        key = (rank[places].astype(np.int64) << 32) | rank[places + done]
        by = np.argsort(key)
        places, key = places[by], key[by]
        order[slots] = places
        heads = np.flatnonzero(_changes(key))
        sizes = np.diff(np.append(heads, len(slots)))
        rank[places] = np.repeat(slots[heads], sizes)
        slots = slots[np.repeat(sizes, sizes) > 1]
        done *= 2
    return order


def bounded_edges(symbols: np.ndarray, order: np.ndarray, strings: int, length: int) -> np.ndarray:
    """Where neighbours in ``order`` share fewer than ``length`` symbols (True before a suffix), by backward extension."""
    n = len(symbols)
    before = np.where(order > 0, symbols[order - 1], 0).astype(symbols.dtype)
    by = np.argsort(before, kind="stable").astype(np.int32)
    step = np.empty(n, np.int32)
    step[by] = np.arange(n, dtype=np.int32)
    # the next and the last slot with the same symbol before it
    same = before[by[1:]] == before[by[:-1]]
    later, earlier = np.full(n, n, np.int32), np.full(n, -1, np.int32)
    later[by[:-1][same]] = by[1:][same]
    earlier[by[1:][same]] = by[:-1][same]
    live = before > 0
    edge = np.zeros(n + 1, bool)
    edge[[0, n]] = True
    # common prefix 0: every end of a string is a symbol of its own
    counts = np.bincount(symbols)
    ends = np.cumsum(counts)
    used = counts[1:] > 0
    low = np.concatenate([np.arange(strings), (ends - counts)[1:][used]]).astype(np.int32)
    high = np.concatenate([np.arange(strings), ends[1:][used] - 1]).astype(np.int32)
    edge[high + 1] = True
    alone = low == high
    lone, low, high = low[alone], low[~alone], high[~alone]
    for _ in range(1, length):
        if not len(lone) and not len(low):
            break
        lone = step[lone[live[lone]]]
        lone = lone[~edge[lone + 1]]
        edge[lone + 1] = True
        if not len(low):
            continue
        sizes = high - low + 1
        heads = np.cumsum(sizes) - sizes
        slot = np.arange(sizes.sum(), dtype=np.int32) + np.repeat((low - heads).astype(np.int32), sizes)
        use = live[slot]
        firsts = slot[use & (earlier[slot] < np.repeat(low, sizes))]
        lasts = slot[use & (later[slot] > np.repeat(high, sizes))]
        # one interval for each interval and symbol; both lists are in the same order
        low, high = np.sort(step[firsts]), np.sort(step[lasts])
        new = ~edge[high + 1]
        low, high = low[new], high[new]
        edge[high + 1] = True
        alone = low == high
        lone = np.concatenate([lone, low[alone]])
        low, high = low[~alone], high[~alone]
    return edge[:n]


def repeated_windows(strings: list[bytes], weights: list[int], length: int) -> tuple[np.ndarray, np.ndarray]:
    """Which places of the strings, one after the other with one place between, start a window found twice; and where each string starts.

    The strings differ; ``weights`` says how many places of the corpus each stands for.
    """
    sizes = np.array([len(s) + 1 for s in strings], np.int64)
    heads = np.cumsum(sizes) - sizes
    seen = np.frombuffer(b"\0".join(strings) + b"\0", np.uint8)
    numbers = np.cumsum(np.bincount(seen, minlength=256) > 0)
    symbols = numbers.astype(np.uint8 if numbers[-1] < 256 else np.uint16)[seen]
    symbols[heads + sizes - 1] = 0
    left = np.repeat(heads + sizes - 1, sizes) - np.arange(len(symbols))
    order = suffix_order(symbols, left)
    edge = bounded_edges(symbols, order, len(strings), length)
    names = np.cumsum(edge) - 1
    weight = np.where(left >= length, np.repeat(np.array(weights, np.int64), sizes), 0)[order]
    total = np.zeros(names[-1] + 1, np.int64)
    np.add.at(total, names, weight)
    out = np.empty(len(symbols), bool)
    out[order] = (weight > 0) & (total[names] > 1)
    return out, heads


def _searched(slices: DataFrame, length: int) -> DataFrame:
    """(rk, low, wide): runs of windows that are found elsewhere too, shard by shard."""
    fields = "rk long, low long, wide long"

    def shard(rows: list[tuple]) -> pa.RecordBatch:
        texts: dict[bytes, int] = {}
        weights, places = [], []
        for text, weight, rk, start in rows:
            at = texts.setdefault(text, len(texts))
            if at == len(weights):
                weights.append(0)
                places.append([])
            weights[at] += weight
            places[at].append((rk, start))
        twice, heads = repeated_windows(list(texts), weights, length)
        edges = np.flatnonzero(np.diff(np.concatenate([[False], twice, [False]]).astype(np.int8)))
        lows, highs = edges[::2], edges[1::2]
        owner = np.searchsorted(heads, lows, "right") - 1
        runs = zip(owner.tolist(), (lows - heads[owner]).tolist(), (highs - lows).tolist())
        out = [(rk, start + low, wide) for who, low, wide in runs for rk, start in places[who]]
        return _batch(fields, *zip(*out)) if out else _batch(fields, [], [], [])

    def expanded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, last = [], 0, None
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("key", "text", "weight", "rk", "start"))
            for key, *row in zip(*columns):
                if size >= SHARD and key != last:
                    yield shard(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[0])
                last = key
        if held:
            yield shard(held)

    return slices.repartition("key").sortWithinPartitions("key").mapInArrow(expanded, fields)


def _marks(texts: DataFrame, length: int, gram: int, group: int, spread: int) -> DataFrame:
    """(rk, low, wide): all windows that are found elsewhere too."""
    found = saved(_repeated(_pieces(texts, length, gram, spread), group))
    pieces, full = found.where("kind = 0"), found.where("kind = 1").select("fp")
    marks = found.where("kind = 2").select("rk", "low", "wide")
    fields = ("fp", "low", "wide", "n")
    if not fits(full, 0):
        if fits(full, BROADCAST_ROWS):
            split = pieces.join(F.broadcast(full.withColumn("alone", F.lit(True))), "fp", "left")
        else:
            salted = full.select("fp", F.lit(True).alias("alone"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
            split = pieces.withColumn("salt", F.pmod("rk", F.lit(SALTS)).cast("int")).join(salted, ["fp", "salt"], "left")
        # read twice, but not saved: as part of the one plan it meets the texts in their one exchange
        alone = _repeated(_windows(_by_text(texts, split.where("alone"), *fields), length, gram, spread), group)
        marks = marks.unionByName(alone.where("kind = 2").select("rk", "low", "wide"))
        pieces = split.where("alone IS NULL").select("rk", *fields).unionByName(alone.where("kind = 0").select("rk", *fields))
    return marks.unionByName(_searched(_slices(_by_text(texts, pieces, *fields), length), length))


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM, group: int = GROUP, spread: int = SPREAD
) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, spans, kept): removed runs as (start, stop) in bytes, and the bytes that are left."""
    if not 0 < gram <= length // 2:
        raise ValueError("gram must be at most half of length")
    bounded_batches(docs.sparkSession)
    texts = docs.select(F.col(id_col).alias("id"), row_key(id_col, text_col).alias("rk"), F.col(text_col).alias("text"))
    marked = _by_text(texts, _marks(texts, length, gram, group, spread), "low", "wide", how="left").select("id", "rk", "text", "runs")
    kind = marked.schema["id"].dataType.simpleString()

    def removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, runs in zip(batch.column("text").to_pylist(), batch.column("runs").to_pylist()):
                data = text.encode() if text else b""
                spans: list[list[int]] = []
                for start, stop in sorted((r["low"], r["low"] + r["wide"] - 1 + length) for r in runs or ()):
                    if spans and start <= spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], stop)
                    else:
                        spans.append([start, stop])
                gaps = zip([0, *(s[1] for s in spans)], [*(s[0] for s in spans), len(data)])
                kept = b"".join([data[a:b] for a, b in gaps])
                out.append((len(data), len(data) - len(kept), len(spans), [{"start": a, "stop": b} for a, b in spans], kept))
            span = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
            kinds = (pa.int64(), pa.int64(), pa.int64(), span, pa.binary())
            columns = [pa.array(list(c), k) for c, k in zip(zip(*out), kinds)] if out else [pa.array([], k) for k in kinds]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *columns], ["id", "n_bytes", "n_removed", "n_spans", "spans", "kept"])

    return marked.mapInArrow(removed, f"id {kind}, n_bytes long, n_removed long, n_spans long, spans array<struct<start: long, stop: long>>, kept binary")
