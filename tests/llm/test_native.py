"""Line deduplication and winnowing against plain Python."""

import random
import re

from tests.llm.helpers import DOCS, documents, lower
from textgauge.llm.line_dedup import dedup_lines
from textgauge.llm.winnowing import contaminated_words

BLANKS = " \t\n\x0b\f\r"


def plain_dedup(rows):
    holders = {}
    for i, text in rows:
        for line in (text or "").split("\n"):
            key = lower(line).strip(BLANKS)
            if len(key) >= 20:
                holders.setdefault(key, set()).add(i)
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        keys = [lower(x).strip(BLANKS) for x in lines]
        last = lambda ids: max((x for x in ids if x is not None), default=None)
        gone = [k in holders and len(holders[k]) >= 3 and last(holders[k]) != i for k in keys]
        out.append((i, len(lines), sum(gone), "\n".join(x for x, g in zip(lines, gone) if not g)))
    return sorted(out, key=repr)


def test_lines_against_plain_python(spark):
    rnd = random.Random(4)
    common = ["A line that is long enough, É", "another line that is long enough", "short", "", "x" * 20]
    texts = [None, "", "\n\n", "  A LINE that is long enough, É\t"] + ["\n".join(rnd.choices(common + ["own line number %d" % k], k=rnd.randint(1, 9))) for k in range(40)]
    ids = [None, *range(1, len(texts))]
    rows = list(zip(ids, texts)) + [(5, texts[5]), (5, "A line that is long enough, É")]
    found = dedup_lines(documents(spark, [t for _, t in rows], [i for i, _ in rows]))
    assert found.columns == ["doc_id", "text", "rk", "id", "n_lines", "n_dropped", "kept_text"]
    got = sorted(((r["doc_id"], r["n_lines"], r["n_dropped"], r["kept_text"]) for r in found.collect()), key=repr)
    assert got == plain_dedup(rows)


def test_lines_of_an_empty_table_and_a_long_text(spark):
    assert dedup_lines(spark.createDataFrame([], DOCS)).count() == 0
    long = "\n".join(["the same line again and again"] * 30_000)
    got = {r["doc_id"]: r["n_dropped"] for r in dedup_lines(documents(spark, [long, long, long])).select("doc_id", "n_dropped").collect()}
    assert got == {0: 30_000, 1: 30_000, 2: 0}


def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text or ""))


def plain_contamination(docs, items):
    windows = {}
    for i, text in items:
        w = plain_words(text)
        size = min(10, len(w))
        for k in range(len(w) - size + 1 if w else 0):
            windows.setdefault(tuple(w[k : k + size]), set()).add(str(i))
    out = []
    for i, text in docs:
        w, hit, found = plain_words(text), set(), set()
        for size in {len(x) for x in windows}:
            for k in range(len(w) - size + 1):
                if own := windows.get(tuple(w[k : k + size])):
                    hit |= set(range(k, k + size))
                    found |= own
        out.append((i, len(w), len(hit), sorted(found)))
    return sorted(out, key=repr)


def contamination(spark, docs, items):
    table = spark.createDataFrame([(i, t, "z") for i, t in items], "item_id long, text string, id string")
    found = contaminated_words(documents(spark, [t for _, t in docs], [i for i, _ in docs]), table)
    return sorted(((r["id"], r["n_words"], r["n_hit"], r["items"]) for r in found.collect()), key=repr)


def test_windows_against_plain_python(spark):
    for seed in range(3):
        rnd = random.Random(seed)
        vocabulary = [chr(97 + k) for k in range(2 + seed)] + ["É", "9"]
        text = lambda n: " ,".join(rnd.choice(vocabulary).upper() if rnd.random() < 0.2 else rnd.choice(vocabulary) for _ in range(n))
        items = [(k, text(rnd.choice([3, 7, 9, 10, 11, 25, 40]))) for k in range(12)] + [(90, None), (91, "..."), (0, "a b c d e f")]
        docs = [(k, text(rnd.choice([0, 2, 8, 10, 30, 80]))) for k in range(25)] + [(None, items[0][1]), (3, items[1][1]), (7, None)]
        docs += [docs[4], (50, text(20) + " " + items[5][1] + " " + text(20))]
        assert contamination(spark, docs, items) == plain_contamination(docs, items)


def test_windows_of_empty_tables(spark):
    assert contamination(spark, [], [(1, "a b")]) == []
    assert contamination(spark, [(1, "a b c")], []) == [(1, 3, 0, [])]
