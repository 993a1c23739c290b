"""Registered queries on tables with nulls, empty and very long texts and equal rows, against SQL or plain versions."""

import random
import zlib

import duckdb
import numpy as np
import pytest

from tests.compare import differences
from tests.llm.helpers import Groups, lower, split
from textgauge.llm import hashed, quality_classifier, simhash
from textgauge.llm.queries import QUERIES, SQL


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Own tables: no null ids and no id twice, which the SQL could not tell apart."""
    rnd = random.Random(6)
    words = [f"{a}{b}" for a in ("ba", "Do", "ké", "lu", "x9") for b in ("", "mi", "ra", "to-da", "漢")]
    prose = lambda n: " ".join(rnd.choices(words, k=n))
    shared, item = "a line that many documents have, Ä", prose(14)
    long = "\n".join(prose(40) for _ in range(130)) + "\n" + shared + "\n" + item
    texts = [None, "", " \t\n", long, long, long + " end", prose(300), prose(300), item, "word", shared, "\n".join([shared, shared, "x"])]
    texts += [prose(rnd.randint(1, 80)) + rnd.choice(["", "\n" + shared, " " + item + " and more"]) for _ in range(40)]
    texts += [texts[6]] * 3 + [texts[20].upper(), "é" * 50_000]
    path = str(tmp_path_factory.mktemp("tables"))
    frames = {
        "documents": spark.createDataFrame([(i, t, "en", "own", len(t or "")) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long"),
        "benchmark": spark.createDataFrame([(1, item), (2, None), (3, ""), (4, "word"), (5, prose(30)), (6, item)], "item_id long, text string"),
        "labels": spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(0, len(texts), 2)], "doc_id long, quality int, toxic int"),
        "pages": spark.createDataFrame(
            [(1, "http://a/b?x=1", "<article><p>One, two.</p></article>"), (2, None, None), (3, "http://a/", ""), (4, "http://c/", f"<article><p>{long * 40}</p></article>"), (5, "http://A/b", "<article><p>One, two.</p></article>")],
            "page_id long, url string, html string",
        ),
    }
    for name, df in frames.items():
        df.repartition(3).write.parquet(f"{path}/{name}.parquet")
    return path


@pytest.fixture(scope="module")
def connection(folder):
    made = duckdb.connect()
    for name in ("documents", "benchmark", "labels", "pages"):
        made.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet/*.parquet'")
    return made


@pytest.mark.parametrize("name", ["op7_decontamination", "op9_warc", "op10_line_dedup", "op11_suffix_repeats", "op12_fill_middle", "op13_importance"])
def test_query_equals_sql_on_odd_tables(spark, folder, connection, name):
    assert differences(QUERIES[name](spark, folder), connection, SQL[name]) == []


def texts_of(spark, folder):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}


def test_simhash_query(spark, folder):
    texts = texts_of(spark, folder)
    prints = {}
    for i, text in texts.items():
        words = [w.encode() for w in split(lower(text or ""))]
        prints[i] = simhash.fingerprint(simhash.shingle_hashes(words, 3))
    groups = Groups(sorted(texts))
    for a in texts:
        for b in texts:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= 3:
                groups.join(a, b)
    found = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in QUERIES["op2_simhash"](spark, folder).collect()}
    assert found == {i: (f"{prints[i]:016x}", groups.find(i)) for i in texts}


def test_quality_rules_query(spark, folder):
    texts = texts_of(spark, folder)
    found = QUERIES["op5_quality_rules"](spark, folder).collect()
    assert sorted(r["doc_id"] for r in found) == sorted(texts)
    for r in found:
        text = texts[r["doc_id"]] or ""
        words = split(text)
        lines = [x for x in text.split("\n") if split(x)]
        assert (r["n_words"], r["word_chars"], r["n_dup_lines"]) == (len(words), sum(map(len, words)), len(lines) - len(set(lines)))
        assert not (r["kept"] and r["base_failed"]) and (r["base_failed"] or len(words) >= 20)


def test_classifier_query(spark, folder):
    found = QUERIES["op6_quality_classifier"](spark, folder).collect()
    assert sorted(r["doc_id"] for r in found) == sorted(texts_of(spark, folder))
    for r in found:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)


def test_classifier_without_rows(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").where("doc_id < 0")
    weights = quality_classifier.fit(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    assert quality_classifier.score(docs, weights).collect() == []


def test_ftrl_equals_plain_updates():
    """Dictionaries and loops instead of arrays, one coordinate at a time."""
    rnd = random.Random(4)
    pool = [f"w{k}" for k in range(30)]
    texts = [(" ".join(rnd.choices(pool[:20] if k % 2 else pool[10:], k=rnd.randint(1, 12))), k % 2) for k in range(40)]
    rows = [{"label": y, "counts": hashed.packed_counts(hashed.word_grams(t))} for t, y in texts]
    alpha, beta, l1, l2, size = 0.5, 1.0, 0.02, 0.5, 1 << hashed.BITS
    z, n = {}, {}

    def weight(i):
        if abs(z.get(i, 0.0)) <= l1:
            return 0.0
        sign = 1 if z[i] > 0 else -1
        return -(z[i] - sign * l1) / ((beta + n[i] ** 0.5) / alpha + l2)

    order = np.random.default_rng(7)
    for _ in range(3):
        for k in order.permutation(len(rows)):
            index, value = quality_classifier.vector(texts[k][0])
            x = dict(zip(index.tolist(), value.tolist())) | {size: 1.0}
            w = {i: weight(i) for i in x}
            margin = sum(w[i] * v for i, v in x.items())
            error = 1 / (1 + np.exp(-margin)) - texts[k][1]
            for i, v in x.items():
                g = error * v
                step = ((n.get(i, 0.0) + g * g) ** 0.5 - n.get(i, 0.0) ** 0.5) / alpha
                z[i] = z.get(i, 0.0) + g - step * w[i]
                n[i] = n.get(i, 0.0) + g * g
    found, _ = quality_classifier.fit_ftrl(rows)
    assert np.flatnonzero(found).tolist() == sorted(i for i in z if weight(i))
    assert all(found[i] == pytest.approx(weight(i), rel=1e-4, abs=1e-6) for i in z)
