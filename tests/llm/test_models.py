"""Trained operators: against plain Python, and by held-out accuracy."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tests.llm.helpers import DOCS, FOLDER, documents, lower, split
from textgauge.llm import kneser_ney, pii, quality_classifier, quality_rules
from textgauge.llm.queries import QUERIES

# Language model ---------------------------------------------------------------


class PlainModel:
    """Interpolated modified Kneser-Ney over pairs, from dictionaries."""

    def __init__(self, texts):
        self.words, self.pairs = Counter(), Counter()
        for t in texts:
            sequence = [*split(lower(t or "")), None]
            self.words.update(sequence)
            self.pairs.update(zip(["<", *sequence], sequence))
        self.total, self.size = sum(self.words.values()), len(self.words)
        self.before, self.after = Counter(w for _, w in self.pairs), defaultdict(list)
        for (v, _), c in self.pairs.items():
            self.after[v].append(c)
        self.d2, self.d1 = self.discounts(self.pairs), self.discounts(self.before)
        self.n = len(self.pairs)
        self.rest = sum(self.discount(c, self.d1) for c in self.before.values()) / self.n

    @staticmethod
    def discounts(counts):
        return kneser_ney.discounts([sum(c == k for c in counts.values()) for k in range(1, 5)])

    @staticmethod
    def discount(c, d):
        return d[min(c, 3) - 1] if c else 0.0

    def single(self, w):
        c = self.before[w]
        return max(c - self.discount(c, self.d1), 0) / self.n + self.rest / (self.size + 1)

    def chance(self, w, v):
        if v not in self.after:
            return self.single(w)
        total, c = sum(self.after[v]), self.pairs[v, w]
        left = sum(self.discount(x, self.d2) for x in self.after[v]) / total
        return max(c - self.discount(c, self.d2), 0) / total + left * self.single(w)

    def score(self, text):
        sequence = [*split(lower(text or "")), None]
        return sum(math.log10(self.chance(w, v)) for v, w in zip(["<", *sequence], sequence))

    def base(self, text):
        return sum(math.log10((self.words[w] + 1) / (self.total + self.size + 1)) for w in [*split(lower(text or "")), None])


def texts(seed, n, size=60):
    rnd = random.Random(seed)
    vocabulary = ["w%d" % k for k in range(size)] + ["É", "The", "the"]
    return [" ".join(rnd.choices(vocabulary, weights=[1 / (k + 1) for k in range(len(vocabulary))], k=rnd.randint(0, 80))) for _ in range(n)]


@pytest.mark.parametrize("block", [kneser_ney.BLOCK, 7])
def test_model_against_plain_python(spark, block):
    train, test = texts(1, 60), [*texts(2, 30, 80), None, "", "  \n", "unknown words only", texts(1, 60)[0]]
    model = kneser_ney.train(documents(spark, train + [train[0], None]), block=block)
    plain = PlainModel(train + [train[0], None])
    assert (model.tokens, model.distinct) == (plain.total, plain.size)
    for v in ("<", "w0", "w59", "never"):
        assert sum(plain.chance(w, v) for w in [*plain.words, "unknown"]) == pytest.approx(1)
    rows = kneser_ney.score(documents(spark, test + [test[0]], [*range(len(test)), 0]), model).collect()
    assert len(rows) == len(test) + 1
    for r in rows:
        t = test[r["id"]]
        assert r["n_tokens"] == len(split(t)) + 1
        assert r["n_known"] == sum(w in plain.words for w in [*split(lower(t or "")), None])
        assert r["base_score"] == pytest.approx(plain.base(t)) and r["score"] == pytest.approx(plain.score(t))
        assert r["perplexity"] == pytest.approx(10 ** (-plain.score(t) / r["n_tokens"]))


def test_model_of_nothing(spark):
    model = kneser_ney.train(spark.createDataFrame([], DOCS))
    row = kneser_ney.score(documents(spark, ["a b"]), model).first()
    assert (row["n_tokens"], row["n_known"], row["score"], row["base_score"]) == (3, 0, 0.0, 0.0)
    assert kneser_ney.score(spark.createDataFrame([], DOCS), model).count() == 0


def test_packing():
    values = np.sort(np.random.default_rng(0).integers(0, 2**63, 1000, dtype=np.uint64) * np.uint64(2))
    assert (kneser_ney.unpack(kneser_ney.pack(values)) == values).all()
    assert len(kneser_ney.unpack(kneser_ney.pack(values[:0]))) == 0


def test_held_out_text_is_likelier_than_by_single_words(spark):
    rows = [r for r in QUERIES["op4_kneser_ney"](spark, FOLDER).collect() if r["held_out"]]
    assert rows and sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows)


# Quality ----------------------------------------------------------------------


def plain_signals(text):
    w, text = split(text), text or ""
    seen, repeated = set(), 0
    for line in text.split("\n"):
        if split(line):
            repeated += line in seen
            seen.add(line)
    windows = Counter(tuple(w[k : k + 8]) for k in range(len(w) - 7))
    inside = {j for k in range(len(w) - 7) if windows[tuple(w[k : k + 8])] > 1 for j in range(k, k + 8)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), repeated, len(inside)


def test_signals_against_plain_python():
    rnd = random.Random(3)
    for _ in range(300):
        text = "".join(rnd.choice(["a ", "b ", "É", "#", "|x", "\n", " \t", "a b a b a b a b a b ", "same line\n", " "]) for _ in range(rnd.randint(0, 60)))
        assert quality_rules.signals(text) == plain_signals(text)
    assert quality_rules.signals(None) == quality_rules.signals("") == (0, 0, 0, 0, 0)
    assert quality_rules.repeated_words([b"a"] * 100_000) == 100_000


def labelled(spark, n, seed=0):
    """Texts of two kinds, told apart by words and marks."""
    rnd = random.Random(seed)
    good = lambda: " ".join(rnd.choice(["river", "stone", "walks", "evening", "of", "the"]) + str(rnd.randint(0, 400)) for _ in range(40))
    bad = lambda: " ".join(rnd.choice(["BUY", "now!!", "cheap$$", "win|"]) + str(rnd.randint(0, 400)) for _ in range(40))
    kinds = [rnd.random() < 0.6 for _ in range(n)]
    docs = documents(spark, [good() if k else bad() for k in kinds] + [None, ""], [*range(n), None, n + 1])
    labels = spark.createDataFrame([(k, int(v), 0) for k, v in enumerate(kinds) if k % 3] + [(1, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    return kinds, docs, labels


def test_rules_keep_good_texts(spark):
    kinds, docs, labels = labelled(spark, 240)
    rows = {r["id"]: r for r in quality_rules.judge(docs, quality_rules.fit(docs, labels)).collect()}
    assert len(rows) == 242 and not rows[None]["kept"] and rows[None]["base_failed"]
    assert sum(rows[k]["kept"] == kinds[k] for k in range(0, 240, 3)) >= 76
    again = {r["id"]: r for r in quality_rules.judge(docs, quality_rules.fit(docs, labels)).collect()}
    assert all(again[k]["probability"] == rows[k]["probability"] for k in rows)
    neutral = quality_rules.fit(docs, labels.where("false"))
    assert all(r["kept"] != r["base_failed"] for r in quality_rules.judge(docs, neutral).collect())
    assert quality_rules.judge(docs.where("false"), neutral).count() == 0


def test_calibrated_probabilities_match_frequencies():
    rng = np.random.default_rng(1)
    x = rng.normal(0, 3, 4000)
    y = (rng.random(4000) < 1 / (1 + np.exp(-(0.7 * x + 0.4)))).astype(float)
    a, b = quality_rules._platt(x, y)
    assert a == pytest.approx(0.7, abs=0.1) and b == pytest.approx(0.4, abs=0.15)
    a, b = quality_rules._platt(np.array([-1.0, 1.0] * 50), np.array([0.02, 0.98] * 50))
    assert np.isfinite([a, b]).all()


def test_classifier_on_held_out_rows(spark):
    kinds, docs, labels = labelled(spark, 240, 5)
    weights = quality_classifier.fit(docs, labels)
    rows = {r["id"]: r["score"] for r in quality_classifier.score(docs, weights).collect()}
    assert len(rows) == 242 and all(0 <= s <= 1 for s in rows.values())
    assert sum((rows[k] >= 0.5) == kinds[k] for k in range(0, 240, 3)) >= 77
    assert rows[None] == rows[241]
    alone = quality_classifier.fit(docs, labels.where("quality = 1"))
    assert {round(r["score"], 3) for r in quality_classifier.score(docs, alone).collect()} == {0.999}
    nothing = quality_classifier.fit(docs, labels.where("false"))
    assert {r["score"] for r in quality_classifier.score(docs, nothing).collect()} == {0.5}


def test_classifier_on_the_given_labels(spark):
    folder = FOLDER.replace("sf0.001", "sf0.01")
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = [r for r in QUERIES["op6_quality_classifier"](spark, folder).collect() if r["held_out"] and r["doc_id"] in labels]
    good, bad = ([r["score"] for r in rows if labels[r["doc_id"]] == k] for k in (1, 0))
    assert sum(g > b for g in good for b in bad) / (len(good) * len(bad)) > 0.9


# Personal data ------------------------------------------------------------------

PATTERNS = {
    0: r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    1: r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    2: r"[0-9]([\x20-]?[0-9])+",
    3: r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            n = len(re.sub("[^0-9]", "", m[0]))
            good = {
                0: True,
                1: kind == 1 and all(int(x) <= 255 for x in m[0].split(".")) if kind == 1 else None,
                2: 13 <= n <= 19 and pii.luhn(re.sub("[^0-9]", "", m[0])),
                3: 9 <= n <= 15,
            }[kind]
            if good:
                out.append((kind, *m.span()))
    return out


def test_patterns_against_regular_expressions():
    rnd = random.Random(8)
    parts = ["a", "B.c", "@", "x@y.z", ".", "-", "+1", "255", "256.", "1.2.3.4", "0", "00", " ", "(", ")", "4111111111111111", "4111 1111 1111 1111", "+44 20 7946 0958", "é", "\n", "%", "_"]
    for _ in range(4000):
        text = "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 14)))
        assert pii.base_spans(text) == plain_spans(text), text
    assert pii.base_spans(None) == []


def test_span_query(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    rows = QUERIES["op1_pii"](spark, FOLDER).collect()
    assert len(rows) == len(texts)
    for r in rows:
        own = plain_spans(texts[r["doc_id"]])
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(s[0] == k for s in own) for k in range(4)]
        listed = ["%s:%d:%d" % (pii.KINDS[k], a, b) for k, a, b in own]
        assert r["base_sha256"] == hashlib.sha256(",".join(listed).encode()).hexdigest()
        assert set(listed) <= set(r["spans"].split(",")) | {""}


def test_patterns_take_linear_time():
    for text in ("a" * 300_000, "a@" * 150_000, "1." * 150_000, "1" * 300_000, "+1" * 150_000, "@" * 300_000):
        pii.base_spans(text)


def test_gradients():
    rng = np.random.default_rng(0)
    p, codes, tags = pii.new_parameters(1), rng.integers(0, pii.CLASSES, (3, 12)), np.zeros((3, 12), np.int64)
    tags[0, 3:6] = [1, 2, 2]
    _, gradient = pii.loss_and_gradients(p, codes, tags, np.ones(3, np.float32))
    for name, g in gradient.items():
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        sides = []
        for step in (0.01, -0.01):
            moved = {k: v.astype(np.float64) for k, v in p.items()}
            moved[name][at] += step
            sides.append(pii.loss_and_gradients(moved, codes, tags, np.ones(3))[0])
        assert (sides[0] - sides[1]) / 0.02 == pytest.approx(g[at], rel=0.01), name


@pytest.fixture(scope="module")
def trained():
    examples = pii.examples([])
    return pii.train(examples[:-120]), examples[-120:]


def test_held_out_spans(trained):
    parameters, held = trained
    found = pii.Reader(parameters)([t for t, _ in held])
    right = sum(len(set(s) & set(f)) for (_, s), f in zip(held, found))
    assert 2 * right / (sum(len(s) for _, s in held) + sum(map(len, found))) > 0.85


def test_windows_give_the_same_spans_wherever_they_fall(trained):
    reader = pii.Reader(trained[0])
    for shift in range(0, 200, 23):
        text = "the of and to " * (shift // 14) + " " * (shift % 14) + "the of and (415) 555-0199 to the of the and in was " * 6
        base, spans = pii.all_spans([text], reader)[0]
        assert base == [] and [text[a:b] for _, a, b in spans].count("(415) 555-0199") >= 5


def test_spans_of_documents(spark, trained):
    plain = "no digits here at all, ever"
    docs = [None, "", plain, "write to a.b@c.de or +44 20 7946 0958", "order 123456789012345 of 2024-05-06", "x" * 50_000 + " 10.0.0.1"]
    rows = {r["id"]: r for r in pii.find(documents(spark, docs + [docs[3]], [None, *range(1, 6), 3]), trained[0]).collect()}
    assert rows[None]["spans"] == rows[1]["spans"] == rows[2]["spans"] == rows[4]["spans"] == []
    assert [(s["kind"], docs[3][s["start"] : s["end"]]) for s in rows[3]["spans"]] == [("email", "a.b@c.de"), ("phone", "+44 20 7946 0958")]
    assert [tuple(s) for s in rows[5]["base"]] == [("ip", 50_001, 50_009)]
    assert pii.find(spark.createDataFrame([], DOCS), trained[0]).count() == 0


def test_fitting_samples_are_bounded_in_rows(spark, monkeypatch):
    from textgauge.llm import hashed, pii

    docs = documents(spark, ["one two 3"] * 40 + ["four 5"] * 40 + ["six 7"], [1] * 80 + [2])
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, 0)], "doc_id long, quality int")
    rows = hashed.labelled_counts(docs, labels, "doc_id", "text", "quality", 3, hashed.word_grams)
    assert sorted((r["id"], r["label"]) for r in rows) == [(1, 1), (2, 0)]
    collected = []
    kind = type(docs)
    collect = kind.collect
    monkeypatch.setattr(kind, "collect", lambda self: collected.append(collect(self)) or collected[-1])
    monkeypatch.setattr(pii, "train", lambda made: made)
    monkeypatch.setattr(pii, "examples", lambda windows: windows)
    assert len(pii.fit(docs)) == 3
    assert [len(x) for x in collected] == [3]
