"""BPE encoding and decoding of whole texts with a given tokenizer file.

Method: tree concatenation. A text longer than ``LONG`` code points is cut into
halves, and these again, wherever the middle falls; all pieces are encoded in
parallel as rows of their own. Neighbouring pieces are then joined pairwise, up
the tree: a window of tokens around the join is re-encoded, and grows until it
shares a token (same id, same characters) with the left side and one with the
right side. Tokens between the two come from the window, all others stay.

That is exact. In BPE a sequence is the encoding of its text if each two
neighbours are the encoding of theirs, and every two neighbours of the result
stand side by side in a piece or in a window. Windows begin with more tokens
than the longest special token has characters, and no cut falls before a
combining mark, so normalisation and splitting see what they need.

Other texts are encoded word by word: white space always separates words for
these tokenizers, so words and the pieces they split into are kept in bounded
caches of two generations. ``encode`` requires a tokenizer that drops ASCII
white space.

Ids are little-endian unsigned 32-bit integers in a binary column: half the
size of an array of longs, and Spark can hash or cut it without Python.

Defined results: a null or empty text has no ids, no ids decode to an empty
text; lone surrogates cannot occur in Spark strings. Repeated rows give
repeated rows.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from textgauge.llm.common import bounded_batches, row_key

#: Code points beyond which a text is cut; pieces have at most half of that.
LONG = 32_768
#: Tokens on either side of a join at first; more than any special token's length.
WINDOW = 32
#: Words and pieces of words in each of two generations of a worker's cache, some 200 bytes each.
CACHED_WORDS, CACHED_PIECES = 150_000, 200_000
#: Fixed value: how the tokenizers that are split here split words.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: The same for lower-case printable ASCII and Latin letters that are one code point in every case.
_LETTERS = "\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f"
_PIECES = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[a-z{_LETTERS}]+|[0-9]|[^a-z0-9\n{_LETTERS}]+|\n")
_ASCII = re.compile(rb"[\x21-\x7e]+")
_PLAIN = re.compile(f"[\x21-\x7e{_LETTERS}]+")
#: Byte-level models show a byte as the character of its number, or, if that is not printable, as the next one from 256.
_HIDDEN = [b for b in range(256) if not (0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b)]
_SHOWN = {b: 256 + k for k, b in enumerate(_HIDDEN)}
BLANKS = " \t\n\r\x0b\f"
_BLANK = re.compile(f"[{BLANKS}]")


@lru_cache(maxsize=4)
def tokenizer(path: str) -> Tokenizer:
    """The tokenizer of a file, with truncation and padding off; once per worker."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    made = Tokenizer.from_file(path)
    made.no_truncation()
    made.no_padding()
    return made


class Recent(dict):
    """What was asked for lately: a full generation becomes the old one, and what is asked for again is kept."""

    def __init__(self, size: int):
        super().__init__()
        self.size, self.old = size, {}

    def missing(self, keys: set) -> set:
        """Keys of neither generation; the others are in this one afterwards."""
        if len(self) > self.size:
            self.old = dict(self)
            self.clear()
        new = keys - self.keys()
        again = new & self.old.keys()
        self.update((key, self.old[key]) for key in again)
        return new - again


class WordEncoder:
    """Encodes texts through their words, and new words through their pieces.

    Words of printable ASCII and precomposed Latin letters are lower-cased and
    split as the tokenizer does, if it is one that does, and their pieces are
    given to its merges alone; all other words are encoded whole.
    """

    def __init__(self, path: str):
        self.tokenizer = tokenizer(path)
        self.words, self.pieces = Recent(CACHED_WORDS), Recent(CACHED_PIECES)
        self.model = self.tokenizer.model if _splits_plainly(path) else None

    def _merged(self, piece: str) -> bytes:
        shown = piece if piece.isascii() else piece.encode("utf-8").decode("latin-1").translate(_SHOWN)
        return array("I", [t.id for t in self.model.tokenize(shown)]).tobytes()

    def _learn(self, words: set[bytes]) -> None:
        """Put the ids of new words into the cache."""
        plain, whole = [], []
        for word in words:
            fits = self.model and b"<|" not in word and (_ASCII.fullmatch(word) or _PLAIN.fullmatch(word.decode("utf-8")))
            (plain if fits else whole).append(word)
        # the pieces of all words, which line ends keep apart
        parts = _PIECES.findall(b"\n".join(plain).decode("utf-8").lower()) if plain else []
        known = self.pieces
        for piece in known.missing(set(parts) - {"\n"}):
            known[piece] = self._merged(piece)
        ids, at = [], 0
        for piece in parts:
            if piece == "\n":
                self.words[plain[at]] = b"".join(ids)
                ids, at = [], at + 1
            else:
                ids.append(known[piece])
        if plain:
            self.words[plain[at]] = b"".join(ids)
        for at in range(0, len(whole), 10_000):
            some = whole[at : at + 10_000]
            made = self.tokenizer.encode_batch_fast([w.decode("utf-8") for w in some], add_special_tokens=False)
            self.words.update((w, np.array(e.ids, "<u4").tobytes()) for w, e in zip(some, made))

    def _words(self, text: str | None) -> list[bytes]:
        if not text:
            return []
        # case and special tokens need a look only where a text has more than ASCII or a special token
        return (text.lower() if self.model and text.isascii() and "<|" not in text else text).encode("utf-8").split()

    def __call__(self, texts: list[str | None]) -> list[bytes]:
        split = list(map(self._words, texts))
        self._learn(self.words.missing({w for words in split for w in words}))
        return [b"".join(map(self.words.__getitem__, words)) for words in split]

    def over(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """``batches``; at their end the caches are emptied, as the worker goes on to other steps with what it holds."""
        try:
            yield from batches
        finally:
            self.words, self.pieces = Recent(CACHED_WORDS), Recent(CACHED_PIECES)


def _splits_plainly(path: str) -> bool:
    """Whether a tokenizer lower-cases and splits as ``_PIECES`` does."""
    with open(path, encoding="utf-8") as file:
        made = json.load(file)
    normal = [n["type"] for n in (made.get("normalizer") or {}).get("normalizers", [])]
    splits = [p for p in (made.get("pre_tokenizer") or {}).get("pretokenizers", []) if p["type"] == "Split"]
    return normal == ["NFC", "Replace", "Lowercase"] and [p["pattern"].get("Regex") for p in splits] == [SPLIT] and splits[0]["behavior"] == "Removed" and splits[0]["invert"] and made["model"]["type"] == "BPE" and not made["model"].get("unk_token")


@lru_cache(maxsize=4)
def word_encoder(path: str) -> WordEncoder:
    """One per worker; its caches last for a task."""
    return WordEncoder(path)


def cuts(text: str, most: int) -> list[str]:
    """Halves, of halves, until no piece has more than ``most`` code points."""
    if len(text) <= most:
        return [text]
    middle = len(text) // 2
    while middle > 1 and unicodedata.combining(text[middle]):
        middle -= 1
    if middle <= 1:
        return [text]
    return cuts(text[:middle], most) + cuts(text[middle:], most)


class Piece:
    """A text with its ids and the characters that each token covers."""

    def __init__(self, text: str, ids: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        self.text, self.ids, self.starts, self.ends = text, ids, starts, ends

    @classmethod
    def of(cls, text: str, by: Tokenizer) -> Piece:
        made = by.encode(text, add_special_tokens=False)
        places = np.array(made.offsets, np.int64).reshape(-1, 2)
        return cls(text, np.array(made.ids, np.int64), places[:, 0], places[:, 1])

    def tokens(self, low: int, high: int, shift: int) -> dict[tuple[int, int, int], int]:
        """Index of each token from ``low`` to ``high`` by place and id; tokens that share a character are left out."""
        out = {}
        for i in range(low, high):
            alone = (i == 0 or self.starts[i - 1] < self.starts[i]) and (i + 1 == len(self.ids) or self.starts[i] < self.starts[i + 1])
            if alone:
                out[int(self.starts[i]) + shift, int(self.ends[i]) + shift, int(self.ids[i])] = i
        return out


def joined(left: Piece, right: Piece, by: Tokenizer, window: int = WINDOW) -> Piece:
    """The encoding of both texts in a row."""
    width, text, cut = window, left.text + right.text, len(left.text)
    while True:
        a, b = max(0, len(left.ids) - width), min(len(right.ids), width)
        low = int(left.starts[a]) if a else 0
        high = int(right.ends[b - 1]) + cut if b < len(right.ids) else len(text)
        middle = Piece.of(text[low:high], by)
        seen = middle.tokens(0, len(middle.ids), low)
        x, i = 0, 0  # left.ids[:x], then the window from i
        if a:
            ours = left.tokens(a, len(left.ids), 0)
            place = min((p for p in seen if p in ours), default=None)
            x, i = (ours[place], seen[place]) if place else (None, None)
        y, j = len(right.ids), len(middle.ids)  # the window until j, then right.ids[y:]
        if b < len(right.ids):
            ours = right.tokens(0, b, cut)
            place = max((p for p in seen if p in ours), default=None)
            y, j = (ours[place], seen[place]) if place else (None, None)
        if x is not None and y is not None and i <= j:
            return Piece(
                text,
                np.concatenate([left.ids[:x], middle.ids[i:j], right.ids[y:]]),
                np.concatenate([left.starts[:x], middle.starts[i:j] + low, right.starts[y:] + cut]),
                np.concatenate([left.ends[:x], middle.ends[i:j] + low, right.ends[y:] + cut]),
            )
        width *= 2


class Run:
    """A cut piece, or several joined: its ids, and its text near both ends.

    ``head`` ends and ``tail`` begins at white space, where words are separate
    whatever follows; a text without such a place is ``whole``, both at once.
    """

    def __init__(self, ids: np.ndarray, head: str, tail: str, whole: bool):
        self.ids, self.head, self.tail, self.whole = ids, head, tail, whole


def ends(text: str, margin: int = 8 * WINDOW) -> tuple[str, str, bool]:
    """Head, tail and whether they are the whole text."""
    first = _BLANK.search(text, margin)
    last = max(text.rfind(c, 0, max(0, len(text) - margin)) for c in BLANKS)
    if not first or last < first.start():
        return text, text, True
    return text[: first.start()], text[last:], False


def joined_runs(left: Run, right: Run, by: Tokenizer, window: int = WINDOW) -> Run:
    tail, head = Piece.of(left.tail, by), Piece.of(right.head, by)
    middle = joined(tail, head, by, window).ids
    ids = np.concatenate([left.ids[: len(left.ids) - len(tail.ids)], middle, right.ids[len(head.ids) :]])
    return Run(
        ids,
        left.head + right.head if left.whole else left.head,
        left.tail + right.tail if right.whole else right.tail,
        left.whole and right.whole,
    )


def tree(runs: list[Run], by: Tokenizer, window: int = WINDOW) -> Run:
    """Join neighbours pairwise until one is left."""
    while len(runs) > 1:
        runs = [joined_runs(*runs[k : k + 2], by, window) if k + 1 < len(runs) else runs[k] for k in range(0, len(runs), 2)]
    return runs[0]


def _encode_long(docs: DataFrame, path: str, long: int) -> DataFrame:
    spark = docs.sparkSession

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rk, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                parts = cuts(text, long // 2)
                size = len(parts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([rk] * size, pa.int64()), pa.array(range(size), pa.int32()), pa.array(parts, pa.string())], names=["rk", "no", "text"]
                )

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by = word_encoder(path)
        for batch in by.over(batches):
            texts = batch.column("text").to_pylist()
            heads, tails, whole = zip(*map(ends, texts)) if texts else ([], [], [])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(by(texts), pa.binary()), pa.array(heads, pa.string()), pa.array(tails, pa.string()), pa.array(whole, pa.bool_())],
                names=["rk", "no", "ids", "head", "tail", "whole"],
            )

    def grown(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["no"])
        last = tree([Run(np.frombuffer(r["ids"], "<u4").astype(np.int64), r["head"], r["tail"], r["whole"]) for r in rows], tokenizer(path))
        return pa.table({"rk": pa.array([rows[0]["rk"]], pa.int64()), "ids": pa.array([last.ids.astype("<u4").tobytes()], pa.binary())})

    parts = docs.dropDuplicates(["rk"]).mapInArrow(cut, "rk long, no int, text string")
    spread = parts.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "rk", "no")
    pieces = spread.mapInArrow(encoded, "rk long, no int, ids binary, head string, tail string, whole boolean")
    return pieces.groupBy("rk").applyInArrow(grown, "rk long, ids binary")


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", long: int = LONG) -> DataFrame:
    """(id, ids) of every row of ``docs``.

    Pieces of one text meet in one task, as the text did before and its ids do
    after; nothing else is shuffled but long texts.
    """
    bounded_batches(docs.sparkSession, 200)
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    is_long = F.coalesce(F.length("text"), F.lit(0)) > long

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by = word_encoder(path)
        for batch in by.over(batches):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(by(batch.column(1).to_pylist()), pa.binary())], names=["id", "ids"])

    short = rows.where(~is_long).mapInArrow(encoded, f"id {kind}, ids binary")
    keyed = rows.where(is_long).withColumn("rk", row_key("id", "text"))
    made = _encode_long(keyed.select("rk", "text"), path, long)
    return short.unionByName(keyed.select("id", "rk").join(made, "rk").select("id", "ids"))


def decode(encoded: DataFrame, path: str, id_col: str = "id", ids_col: str = "ids") -> DataFrame:
    """(id, ids, decoded) of every row; null ids decode to an empty text.

    Without a decoder of its own, a tokenizer's tokens are joined by one space.
    """
    bounded_batches(encoded.sparkSession, 200)
    kind = encoded.schema[id_col].dataType.simpleString()

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by = tokenizer(path)
        names = [by.id_to_token(i) or "" for i in range(by.get_vocab_size())] if by.decoder is None else None
        for batch in batches:
            out = []
            for packed in batch.column(1).to_pylist():
                ids = np.frombuffer(packed or b"", "<u4").tolist()
                out.append(" ".join(map(names.__getitem__, ids)) if names else by.decode(ids, skip_special_tokens=False))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.string())], names=["id", "ids", "decoded"])

    return encoded.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids")).mapInArrow(decoded, f"id {kind}, ids binary, decoded string")
