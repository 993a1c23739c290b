"""Personal data: fixed patterns, and a character-level BiLSTM-CRF that adds spans.

Method: characters are mapped to classes (digit, letter kinds, each mark). A
bidirectional LSTM scores begin and inside tags of four kinds, and a linear
chain (CRF) with learned transitions ties them together. It is trained in numpy
from labelled spans: windows of the corpus with the spans of the patterns and
without any, and the same windows with written variants (other separators, no
country code, spaced signs) or look-alikes (dates, versions, amounts, keys) put
in. At most ``MAX_WINDOWS`` windows are collected for this.

Whole texts are read in windows of 128 characters, 64 apart. The tag scores of
overlapping windows are averaged, central characters counting most, and each
stretch of windows is decoded at once by one Viterbi pass, so a span may lie
across any number of windows. A window without a digit or "@" can hold no valid
span, as every kind needs one, and is not scored.

A decoded span counts if it is valid for its kind (``valid``) and touches no
span of the patterns; those always stay.

Defined results: a null or empty text has no spans. Repeated rows give repeated
rows. Positions are code points.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textgauge.llm.common import bounded_batches

KINDS = ("email", "ip", "card", "phone")
WINDOW, STEP = 128, 64
MAX_WINDOWS = 800
#: Windows that go through the network at once.
BATCH = 256

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NEEDED = re.compile(r"[0-9@]")


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def emails(text: str) -> list[tuple[int, int]]:
    """Each "@" with the local part before and the domain after it, in linear time."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1)
        if start < at and domain:
            done = domain.end()
            out.append((start, done))
        at = text.find("@", max(at + 1, done))
    return out


def ips(text: str) -> list[tuple[int, int]]:
    """Each four numbers of a dotted run, if none is over 255."""
    out = []
    for run in _DOTTED.finditer(text):
        if run[0].count(".") < 3:
            continue
        at = run.start()
        parts = run[0].split(".")
        for k in range(0, len(parts) - 3, 4):
            four = parts[k : k + 4]
            size = sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
                out.append((at, at + size))
            at += size + 1
    return out


def cards(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in _CARD.finditer(text) if m.end() - m.start() <= 40 and 13 <= len(d := _digits(m[0])) <= 19 and luhn(d)]


def phones(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in _PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]


def base_spans(text: str | None) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the patterns' matches, in order."""
    if not text or not _NEEDED.search(text):
        return []
    return [(k, a, b) for k, find in enumerate((emails, ips, cards, phones)) for a, b in find(text)]


def valid(kind: int, span: str) -> bool:
    """What a decoded span needs for its kind."""
    digits = _digits(span)
    if kind == 0:
        return span.count("@") == 1 and "." in span.partition("@")[2] and len(span) >= 5
    if kind == 1:
        four = re.split(r"[\s.]+", span)
        dotted = len(four) == 4 and all(p.isascii() and p.isdigit() and len(p) <= 3 and int(p) <= 255 for p in four)
        return dotted or (span.count(":") >= 4 and bool(re.fullmatch(r"[0-9A-Fa-f:]{8,39}", span)) and bool(digits))
    if kind == 2:
        return 13 <= len(digits) <= 19 and luhn(digits)
    return 9 <= len(digits) <= 15 and len(span) > len(digits)


# Classes of characters -------------------------------------------------------

_MARKS = " \n\t!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
CLASSES = 6 + len(_MARKS)


def _class_table() -> np.ndarray:
    table = np.zeros(128, np.int64)  # 0: other ASCII
    for c in range(128):
        s = chr(c)
        if s.isdigit():
            table[c] = 1
        elif "a" <= s <= "f":
            table[c] = 2
        elif "g" <= s <= "z":
            table[c] = 3
        elif "A" <= s <= "Z":
            table[c] = 4
        elif s in _MARKS:
            table[c] = 6 + _MARKS.index(s)
    return table


_TABLE = _class_table()
_BEYOND = 5


def classes(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    return np.where(codes < 128, _TABLE[np.minimum(codes, 127)], _BEYOND)


# The network -----------------------------------------------------------------

TAGS = 1 + 2 * len(KINDS)  # nothing; begin and inside of each kind
HIDDEN, EMBEDDED = 16, 10
#: Tags that may follow each other: inside only after begin or inside of its kind.
ALLOWED = np.array([[not (b and b % 2 == 0) or (a in (b - 1, b)) for b in range(TAGS)] for a in range(TAGS)])
_NO = np.float32(-1e4)


def tags_of(size: int, spans: list[tuple[int, int, int]]) -> np.ndarray:
    out = np.zeros(size, np.int64)
    for kind, a, b in spans:
        out[a:b] = 2 + 2 * kind
        out[a] = 1 + 2 * kind
    return out


def new_parameters(seed: int) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    make = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
    p = {"embed": make(CLASSES, EMBEDDED), "out": make(2 * HIDDEN, TAGS), "out_bias": np.zeros(TAGS, np.float32), "move": np.zeros((TAGS, TAGS), np.float32)}
    for side in "fb":
        p[f"{side}_in"], p[f"{side}_own"] = make(EMBEDDED, 4 * HIDDEN), make(HIDDEN, 4 * HIDDEN)
        p[f"{side}_bias"] = np.concatenate([np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)]).astype(np.float32)
    return p


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _lstm(x: np.ndarray, own: np.ndarray, keep: bool):
    """States of each step of (steps, batch, gates); with what the way back needs."""
    steps, batch, _ = x.shape
    h, c = np.zeros((batch, HIDDEN), np.float32), np.zeros((batch, HIDDEN), np.float32)
    states, kept = np.empty((steps, batch, HIDDEN), np.float32), []
    for t in range(steps):
        z = x[t] + h @ own
        gates = _sigmoid(z[:, : 3 * HIDDEN])
        i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN : 2 * HIDDEN], gates[:, 2 * HIDDEN :]
        g = np.tanh(z[:, 3 * HIDDEN :])
        last, c = c, f * c + i * g
        tc = np.tanh(c)
        if keep:
            kept.append((h, last, i, f, o, g, tc))
        h = o * tc
        states[t] = h
    return states, kept


def _lstm_back(d_states: np.ndarray, kept: list, own: np.ndarray):
    """Gradients of the gates' inputs and of the recurrent weights."""
    steps, batch, _ = d_states.shape
    dz, d_own = np.empty((steps, batch, 4 * HIDDEN), np.float32), np.zeros_like(own)
    dh, dc = np.zeros((batch, HIDDEN), np.float32), np.zeros((batch, HIDDEN), np.float32)
    for t in range(steps - 1, -1, -1):
        h, last, i, f, o, g, tc = kept[t]
        dh = dh + d_states[t]
        dc = dc + dh * o * (1 - tc * tc)
        dz[t] = np.concatenate([dc * g * i * (1 - i), dc * last * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - g * g)], axis=1)
        d_own += h.T @ dz[t]
        dh, dc = dz[t] @ own.T, dc * f
    return dz, d_own


def emissions(p: dict[str, np.ndarray], codes: np.ndarray, keep: bool = False):
    """Tag scores (steps, batch, tags) of class codes (batch, steps)."""
    x = p["embed"][codes.T]
    forward, kept_f = _lstm(x @ p["f_in"] + p["f_bias"], p["f_own"], keep)
    backward, kept_b = _lstm((x @ p["b_in"] + p["b_bias"])[::-1], p["b_own"], keep)
    states = np.concatenate([forward, backward[::-1]], axis=2)
    scores = states @ p["out"] + p["out_bias"]
    return (scores, (x, states, kept_f, kept_b)) if keep else scores


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def moves(p: dict[str, np.ndarray]) -> np.ndarray:
    return np.where(ALLOWED, p["move"], _NO)


def loss_and_gradients(p: dict[str, np.ndarray], codes: np.ndarray, tags: np.ndarray, weight: np.ndarray):
    """Negative log-likelihood of tag sequences under the chain, and its gradients."""
    scores, (x, states, kept_f, kept_b) = emissions(p, codes, keep=True)
    steps, batch, _ = scores.shape
    move, tags = moves(p), tags.T
    alpha, beta = np.empty_like(scores), np.zeros_like(scores)
    start = np.where(np.arange(TAGS) % 2 + (np.arange(TAGS) == 0), 0, _NO).astype(np.float32)  # no inside at first
    alpha[0] = scores[0] + start
    for t in range(1, steps):
        alpha[t] = _log_sum(alpha[t - 1][:, :, None] + move, 1) + scores[t]
    for t in range(steps - 2, -1, -1):
        beta[t] = _log_sum(move + (scores[t + 1] + beta[t + 1])[:, None, :], 2)
    total = _log_sum(alpha[-1], 1)
    rows = np.arange(batch)
    gold = scores[np.arange(steps)[:, None], rows, tags].sum(0) + move[tags[:-1], tags[1:]].sum(0)
    d_scores = np.exp(alpha + beta - total[:, None])
    d_scores[np.arange(steps)[:, None], rows, tags] -= 1
    d_scores *= weight[:, None]
    d_move = np.zeros_like(move)
    for t in range(1, steps):
        joint = alpha[t - 1][:, :, None] + move + (scores[t] + beta[t])[:, None, :] - total[:, None, None]
        d_move += (np.exp(joint) * weight[:, None, None]).sum(0)
    np.add.at(d_move, (tags[:-1], tags[1:]), -np.broadcast_to(weight, tags[1:].shape))
    out = {"move": np.where(ALLOWED, d_move, 0)}
    out["out"] = states.reshape(-1, 2 * HIDDEN).T @ d_scores.reshape(-1, TAGS)
    out["out_bias"] = d_scores.sum((0, 1))
    d_states = d_scores @ p["out"].T
    dz_f, out["f_own"] = _lstm_back(d_states[:, :, :HIDDEN], kept_f, p["f_own"])
    dz_b, out["b_own"] = _lstm_back(d_states[::-1, :, HIDDEN:], kept_b, p["b_own"])
    dz_b = dz_b[::-1]
    flat = x.reshape(-1, EMBEDDED)
    d_x = np.zeros_like(x)
    for side, dz in (("f", dz_f), ("b", dz_b)):
        out[f"{side}_in"], out[f"{side}_bias"] = flat.T @ dz.reshape(-1, 4 * HIDDEN), dz.sum((0, 1))
        d_x += dz @ p[f"{side}_in"].T
    out["embed"] = np.zeros_like(p["embed"])
    np.add.at(out["embed"], codes.T, d_x)
    return float(((total - gold) * weight).sum()), out


def viterbi(scores: np.ndarray, move: np.ndarray) -> np.ndarray:
    """Best tags of one sequence of scores (steps, tags)."""
    best = scores[0] + np.where(np.arange(TAGS) % 2 + (np.arange(TAGS) == 0), 0, _NO)
    back = np.empty(scores.shape, np.int64)
    for t in range(1, len(scores)):
        every = best[:, None] + move
        back[t] = every.argmax(0)
        best = every[back[t], np.arange(TAGS)] + scores[t]
    out = np.empty(len(scores), np.int64)
    out[-1] = best.argmax()
    for t in range(len(scores) - 1, 0, -1):
        out[t - 1] = back[t, out[t]]
    return out


# Training --------------------------------------------------------------------


def _variant(rnd: random.Random) -> tuple[int | None, str]:
    """A written form that the patterns miss, with its kind; or a look-alike, with none."""
    d = lambda n: "".join(rnd.choice("0123456789") for _ in range(n))
    word = lambda: "".join(rnd.choice("abcdefghilmnoprstu") for _ in range(rnd.randint(3, 9)))
    choice = rnd.randrange(16)
    if choice == 0:
        return 0, f"{word()}.{d(2)} @ {word()}{rnd.randint(1, 9)}.{word()}.com"
    if choice == 1:
        return 0, f"{word()}@{word()} .{rnd.choice(['com', 'org', 'net'])}"
    if choice == 2:
        return 1, " . ".join(str(rnd.randint(0, 255)) for _ in range(4))
    if choice == 3:
        return 1, ":".join("".join(rnd.choice("0123456789abcdef") for _ in range(4)) for _ in range(8))
    if choice == 4:
        body = rnd.choice("45") + d(14)
        full = next(body + c for c in "0123456789" if luhn(body + c))
        return 2, rnd.choice([".", "/", "_", "  "]).join(full[k : k + 4] for k in range(0, 16, 4))
    if choice in (5, 6, 7):
        a, b, c = d(3), d(3), d(4)
        return 3, rnd.choice([f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"00{rnd.randint(1, 99)} {a} {b} {c}", f"({a}){b}-{c}", f"1-{a}-{b}-{c}"])
    look = [
        f"{rnd.randint(1990, 2030)}-{rnd.randint(1, 12):02d}-{rnd.randint(1, 28):02d}",
        f"{rnd.randint(0, 20)}.{rnd.randint(0, 20)}.{rnd.randint(0, 99)}",
        d(rnd.randint(1, 24)),
        f'token = "{"".join(rnd.choice("0123456789abcdef") for _ in range(40))}"',
        f"{rnd.randint(1, 999)},{d(3)}.{d(2)}",
        f"@{word()}",
        f"{word()}{d(rnd.randint(1, 6))}",
        f"{rnd.randint(0, 23)}:{rnd.randint(0, 59):02d}",
        f"pp. {d(3)}-{d(3)}",
        f"{d(4)}-{d(4)}",
        f"ISBN {d(3)}-{d(1)}-{d(4)}-{d(4)}-{d(1)}",
        f"{d(1)}/{d(1)}, {d(2)}-{d(2)}, {d(3)}",
    ]
    return None, rnd.choice(look)


def examples(windows: list[str], seed: int = 5) -> list[tuple[str, list[tuple[int, int, int]]]]:
    """Windows with their labelled spans, as they are and with something put in."""
    rnd = random.Random(seed)
    plain = ["the of and to in is was for " * 5] * 20
    out = []
    for text in windows:
        if len(text) > 20:
            out.append((text, _apart(base_spans(text))))
    sources = [w for w in windows if len(w) > 60] or plain
    for _ in range(max(1600, 2 * len(windows))):
        text = rnd.choice(sources)
        kind, put = _variant(rnd)
        at = rnd.randrange(0, max(1, len(text) - 20))
        at = text.find(" ", at)
        if at < 0 or any(a < at < b for _, a, b in base_spans(text)):
            continue
        before, after = text[max(0, at - 90) : at + 1], text[at:]
        whole = (before + put + after)[:WINDOW]
        spans = base_spans(before) + [(k, a + len(before + put), b + len(before + put)) for k, a, b in base_spans(after)]
        spans = [(k, a, b) for k, a, b in spans if b <= len(whole)]
        end = len(before) + len(put)
        if kind is not None and end <= len(whole):
            spans.append((kind, len(before), end))
        elif kind is not None:
            continue
        else:
            spans += [(k, a + len(before), b + len(before)) for k, a, b in base_spans(put) if b + len(before) <= len(whole)]
        out.append((whole, _apart(spans)))
    return out


def _apart(spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Spans that overlap an earlier kind's left out, so that each character has one tag."""
    out: list[tuple[int, int, int]] = []
    for s in spans:
        if all(s[2] <= a or b <= s[1] for _, a, b in out):
            out.append(s)
    return out


def train(labelled: list[tuple[str, list[tuple[int, int, int]]]], steps: int = 360, batch: int = 64, rate: float = 0.015, seed: int = 11) -> dict[str, np.ndarray]:
    """Adam on random batches; texts are padded with line ends to the window."""
    p = new_parameters(seed)
    codes = np.stack([np.pad(classes(t), (0, WINDOW - len(t)), constant_values=6 + _MARKS.index("\n")) for t, _ in labelled])
    tags = np.stack([tags_of(WINDOW, s) for _, s in labelled])
    rng = np.random.default_rng(seed)
    m, v = {k: np.zeros_like(x) for k, x in p.items()}, {k: np.zeros_like(x) for k, x in p.items()}
    for step in range(1, steps + 1):
        at = rng.integers(0, len(codes), batch)
        _, g = loss_and_gradients(p, codes[at], tags[at], np.full(batch, 1 / batch, np.float32))
        norm = np.sqrt(sum(float((x * x).sum()) for x in g.values()))
        pace = rate * min(1.0, 2 * (1 - step / (steps + 1)))
        for k in p:
            x = g[k] * min(1.0, 5.0 / (norm + 1e-9))
            m[k] = 0.9 * m[k] + 0.1 * x
            v[k] = 0.99 * v[k] + 0.01 * x * x
            p[k] = (p[k] - pace * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return p


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_windows: int = MAX_WINDOWS) -> dict[str, np.ndarray]:
    """Train on windows of at most ``max_windows`` texts, those with the smallest hashes."""
    bounded_batches(docs.sparkSession)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text in batch.column(0).to_pylist():
                base = base_spans(text)
                place = base[len(text) % len(base)][1] if base else _NEEDED.search(text).start()
                start = max(0, place - 10 - len(text) % 80)
                out.append(text[start : start + WINDOW])
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], names=["window"])

    texts = docs.where(F.col(text_col).rlike("[0-9@]")).select(F.col(text_col).alias("text"), F.xxhash64(id_col, text_col).alias("_h"))
    # the choice is made by hash alone, before any text is moved
    chosen = texts.select("_h").distinct().orderBy("_h").limit(max_windows)
    # equal rows share a hash and count once
    once = texts.join(F.broadcast(chosen), "_h").groupBy("_h").agg(F.min("text").alias("text"))
    rows = once.select("text").mapInArrow(cut, "window string")
    return train(examples(sorted({r["window"] for r in rows.collect()})))


# Reading ---------------------------------------------------------------------


def stretches(text: str) -> list[tuple[int, int]]:
    """Parts of a text that can hold a span: runs of windows with a digit or "@"."""
    out: list[list[int]] = []
    for found in _NEEDED.finditer(text):
        at = found.start()
        if out and at < out[-1][1] - STEP // 2:
            continue
        first, last = max(0, (at - STEP) // STEP * STEP), min(len(text), at // STEP * STEP + WINDOW)
        if out and first <= out[-1][1]:
            out[-1][1] = last
        else:
            out.append([first, last])
    return [(a, b) for a, b in out]


_CENTRAL = (np.minimum(np.arange(WINDOW), np.arange(WINDOW)[::-1]) + 1).astype(np.float32)


class Reader:
    """Decodes texts with given parameters."""

    def __init__(self, p: dict[str, np.ndarray]):
        self.p, self.move = p, moves(p)

    def __call__(self, texts: list[str]) -> list[list[tuple[int, int, int]]]:
        parts = [(k, a, b) for k, t in enumerate(texts) for a, b in stretches(t)]
        places, codes = [], []
        for n, (k, a, b) in enumerate(parts):
            own = classes(texts[k][a:b])
            for start in range(0, max(1, len(own) - STEP), STEP):
                piece = own[start : start + WINDOW]
                places.append((n, start, len(piece)))
                codes.append(np.pad(piece, (0, WINDOW - len(piece)), constant_values=6 + _MARKS.index("\n")))
        sums = [np.zeros((b - a, TAGS), np.float32) for _, a, b in parts]
        weights = [np.zeros((b - a, 1), np.float32) for _, a, b in parts]
        for at in range(0, len(codes), BATCH):
            scores = emissions(self.p, np.stack(codes[at : at + BATCH]))
            for j, (n, start, size) in enumerate(places[at : at + BATCH]):
                w = _CENTRAL[:size, None]
                sums[n][start : start + size] += scores[:size, j] * w
                weights[n][start : start + size] += w
        out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        for (k, a, _), total, weight in zip(parts, sums, weights):
            tags = viterbi(total / np.maximum(weight, 1e-9), self.move)
            t = 0
            while t < len(tags):
                if tags[t] and tags[t] % 2:
                    end = t + 1
                    while end < len(tags) and tags[end] == tags[t] + 1:
                        end += 1
                    out[k].append(((int(tags[t]) - 1) // 2, a + t, a + end))
                    t = end
                else:
                    t += 1
        return out


def all_spans(texts: list[str | None], reader: Reader) -> list[tuple[list, list]]:
    """(spans of the patterns, all spans) of each text."""
    base = [base_spans(t) for t in texts]
    found = reader([t or "" for t in texts])
    out = []
    for text, own, more in zip(texts, base, found):
        added = [(k, a, b) for k, a, b in (_trimmed(text, s) for s in more) if valid(k, text[a:b]) and all(b <= x or y <= a for _, x, y in own)]
        out.append((own, sorted(own + added)))
    return out


def _trimmed(text: str, span: tuple[int, int, int]) -> tuple[int, int, int]:
    kind, a, b = span
    while a < b and text[a] in " \n\t.,;:":
        a += 1
    while b > a and text[b - 1] in " \n\t.,;:":
        b -= 1
    return kind, a, b


def find(docs: DataFrame, parameters: dict[str, np.ndarray], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, base, spans) of every row: arrays of (kind, start, end), by kind and start."""
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(parameters)  # 30 kB, whatever the data
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(shared.value)
        for batch in batches:
            found = all_spans(batch.column(1).to_pylist(), reader)
            packed = [pa.array([[(KINDS[k], s, e) for k, s, e in spans] for spans in side], span) for side in zip(*found)] or [pa.array([], span)] * 2
            yield pa.RecordBatch.from_arrays([batch.column(0), *packed], names=["id", "base", "spans"])

    kind = docs.schema[id_col].dataType.simpleString()
    each = "array<struct<kind:string,start:int,end:int>>"
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(read, f"id {kind}, base {each}, spans {each}")
