"""Fill-in-middle transformation of whole texts, cut through a learned rank index.

Method: the boundaries of a text's tokens, in order, are a function from rank to
offset. Each text gets piecewise-linear segments whose error is at most
``ERROR``: a segment is the line through its two ends, and one that is off by
more is halved, all segments of a batch at once, until none is. What the lines
miss is kept as one signed byte a boundary. A cut at a rank is the line's
prediction plus the stored residual, so it is exact.

Tokens are ``[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+``. Which ranks
are cut and which form a text takes come from SHA-256 of the seed and the id.

Rows are independent: no shuffle. A task holds one Arrow batch, its boundaries
and residuals; results leave in pieces of ``OUT_BYTES``.

Defined results: a null text is empty; a null id counts as the empty string;
equal rows get equal results. Only the id and the operator's own columns are
returned, so further columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textgauge.llm.common import bounded_batches

#: The marks of prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED, FIM_PERCENT, SPM_PERCENT = 42, 50, 80
#: Residuals fit into a signed byte.
ERROR = 127
BLOCK = 4 << 20
OUT_BYTES = 64 << 20
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_MARKS = tuple(m.encode() for m in (PREFIX, SUFFIX, MIDDLE))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and its n + 1 offsets; nulls are empty."""
    filled = pa.concat_arrays([column.fill_null("").cast(pa.large_string())])
    _, offsets, data = filled.buffers()
    bounds = np.frombuffer(offsets, np.int64, len(filled) + 1, filled.offset * 8)
    return np.frombuffer(data if data is not None else b"", np.uint8)[bounds[0] : bounds[-1]], bounds - bounds[0]


def token_ends(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets in ``data`` where tokens end, in order, and how many each text has."""
    found = []
    for at in range(0, len(data), BLOCK):
        blank = _BLANK[data[at : at + BLOCK + 1]]
        found.append(np.flatnonzero(~blank[:-1] & blank[1:]) + at + 1)
    full = bounds[1:][bounds[1:] > bounds[:-1]]
    ends = np.union1d(np.concatenate([*found, full]), full)
    return ends, np.diff(np.searchsorted(ends, bounds, "right"))


class RankIndex:
    """Error-bounded lines from rank to offset, for many texts at once.

    ``offsets`` holds the boundaries of one text after the other, each text's
    first being its start; ``firsts`` says where each begins.
    """

    def __init__(self, offsets: np.ndarray, firsts: np.ndarray):
        ends = np.append(firsts[1:], len(offsets))
        lows, highs = firsts[ends > firsts], ends[ends > firsts]
        starts, slopes, kept = [], [], []
        self.residuals = np.zeros(len(offsets), np.int8)
        while len(lows):
            sizes = highs - lows
            slope = (offsets[highs - 1] - offsets[lows]) / np.maximum(sizes - 1, 1)
            heads = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            ranks = np.arange(sizes.sum()) - np.repeat(heads, sizes)
            places = ranks + np.repeat(lows, sizes)
            missed = offsets[places] - np.repeat(offsets[lows], sizes) - np.rint(np.repeat(slope, sizes) * ranks).astype(np.int64)
            good = np.maximum.reduceat(np.abs(missed), heads) <= ERROR
            inside = np.repeat(good, sizes)
            self.residuals[places[inside]] = missed[inside]
            starts.append(lows[good])
            slopes.append(slope[good])
            kept.append(offsets[lows[good]])
            low, high = lows[~good], highs[~good]
            middle = (low + high) // 2
            lows, highs = np.concatenate([low, middle]), np.concatenate([middle, high])
        order = np.argsort(np.concatenate(starts)) if starts else np.zeros(0, np.int64)
        self.starts, self.slopes, self.bases = (np.concatenate(x)[order] if starts else np.zeros(0, np.int64) for x in (starts, slopes, kept))

    def offset(self, places: np.ndarray) -> np.ndarray:
        """Exact offsets at places (a text's first place plus the rank)."""
        segment = np.searchsorted(self.starts, places, "right") - 1
        predicted = self.bases[segment] + np.rint(self.slopes[segment] * (places - self.starts[segment])).astype(np.int64)
        return predicted + self.residuals[places]


def indexed(data: np.ndarray, bounds: np.ndarray) -> tuple[RankIndex, np.ndarray, np.ndarray]:
    """The index of a batch, each text's first place in it, and each text's number of tokens."""
    ends, counts = token_ends(data, bounds)
    firsts = np.concatenate([[0], np.cumsum(counts + 1)[:-1]]).astype(np.int64)
    offsets = np.zeros(len(ends) + len(counts), np.int64)
    starting = np.zeros(len(offsets), bool)
    starting[firsts] = True
    offsets[starting], offsets[~starting] = bounds[:-1], ends
    return RankIndex(offsets, firsts), firsts, counts


def _draws(id_col: str, seed: int) -> list[Column]:
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long").alias(f"h{k + 1}") for k in range(4)]


def transform(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED, fim_percent: int = FIM_PERCENT, spm_percent: int = SPM_PERCENT
) -> DataFrame:
    """(id, n, form, prefix_chars, middle_chars, output): tokens, form, lengths in code points and the text to train on."""
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), *_draws(id_col, seed))
    kind = rows.schema["id"].dataType.simpleString()

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield from _cut(batch, fim_percent, spm_percent)

    return rows.mapInArrow(made, f"id {kind}, n long, form string, prefix_chars long, middle_chars long, output string")


def _cut(batch: pa.RecordBatch, fim_percent: int, spm_percent: int) -> Iterator[pa.RecordBatch]:
    data, bounds = utf8(batch.column("text"))
    index, firsts, counts = indexed(data, bounds)
    h1, h2, h3, h4 = (batch.column(f"h{k}").to_numpy(zero_copy_only=False).astype(np.int64) for k in range(1, 5))
    one, two = h1 % (counts + 1), h2 % (counts + 1)
    cut_1, cut_2 = index.offset(firsts + np.minimum(one, two)), index.offset(firsts + np.maximum(one, two))
    view = memoryview(data)
    outputs, forms, prefixes, middles, done, size = [], [], [], [], 0, 0
    for i in range(batch.num_rows):
        text = bytes(view[bounds[i] : bounds[i + 1]])
        if not text or h3[i] % 100 >= fim_percent or any(m in text for m in _MARKS):
            form, out, lengths = "plain", text, (None, None)
        else:
            a, b = cut_1[i] - bounds[i], cut_2[i] - bounds[i]
            prefix, middle, suffix = text[:a], text[a:b], text[b:]
            form = "spm" if h4[i] % 100 < spm_percent else "psm"
            p, s, m = _MARKS
            out = b"".join((s, suffix, p, prefix, m, middle) if form == "spm" else (p, prefix, s, suffix, m, middle))
            lengths = len(prefix.decode()), len(middle.decode())
        outputs.append(out)
        forms.append(form)
        prefixes.append(lengths[0])
        middles.append(lengths[1])
        size += len(out)
        if size > OUT_BYTES or i + 1 == batch.num_rows:
            columns = [
                batch.column("id").slice(done, len(outputs)),
                pa.array(counts[done : i + 1], pa.int64()),
                pa.array(forms, pa.string()),
                pa.array(prefixes, pa.int64()),
                pa.array(middles, pa.int64()),
                pa.array(outputs, pa.binary()).cast(pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["id", "n", "form", "prefix_chars", "middle_chars", "output"])
            outputs, forms, prefixes, middles, done, size = [], [], [], [], i + 1, 0


def restored(output: str = "output", form: str = "form") -> Column:
    """The text, from what :func:`transform` made of it; a text with a mark in it stays plain, so each mark is there once."""
    parts = F.split(F.col(output), f"{PREFIX}|{SUFFIX}|{MIDDLE}")
    psm = F.concat(F.get(parts, F.lit(1)), F.get(parts, F.lit(3)), F.get(parts, F.lit(2)))
    spm = F.concat(F.get(parts, F.lit(2)), F.get(parts, F.lit(3)), F.get(parts, F.lit(1)))
    return F.when(F.col(form) == "psm", psm).when(F.col(form) == "spm", spm).otherwise(F.col(output))
