"""Governance operators against plain Python and on edge cases."""

import random
import re

import pytest
from pyspark.sql import functions as F

from textgauge.operators import governance
from textgauge.operators.lexicon import Lexicon


def test_representation(spark):
    df = spark.createDataFrame([("a",)] * 8 + [("b",)] + [(None,)], "g string")
    rows = {r.g: (r.n, r.share, r.under_represented) for r in governance.representation(df, ["g"]).collect()}
    assert rows == {"a": (8, 0.8, False), "b": (1, 0.1, True), None: (1, 0.1, True)}
    assert governance.representation(df.where("false"), ["g"]).count() == 0


def test_error_rates(spark):
    rows = [("a", 0, 1), ("a", 0, 0), ("a", 1, 1), ("b", 1, 0), ("b", 1, 1), (None, 1, 0), ("a", None, 1), ("b", 1, None)]
    rates = governance.error_rates(spark.createDataFrame(rows, "g string, label int, prediction int"), "g")
    assert {r.group: (r.fpr, r.fnr) for r in rates.collect()} == {"a": (0.5, 0.0), "b": (0.0, 0.5)}
    gaps = governance.error_gaps(rates).first()
    assert (gaps.groups, gaps.fpr_gap, gaps.fnr_gap) == (2, 0.5, 0.5)


def test_effects_over_runs(spark):
    runs = spark.createDataFrame([("m", 1, 0.5), ("m", 2, 0.25), ("m", 9, 0.75), ("n", 1, None)], "s string, t int, v double")
    rows = governance.mitigation_effects(runs, "s", "t", "v").orderBy("s", "t").collect()
    assert [(r.change, r.since_first) for r in rows] == [(None, 0.0), (-0.25, -0.25), (0.5, 0.25), (None, None)]


def test_masks_equal_plain_patterns(spark):
    from textgauge.workload.governance import PLAIN_PATTERNS

    rnd = random.Random(4)
    parts = ["a", "b.c", "@", "x@y.z", "%d", ".", "-", "+1 (743) 555-3824", "1.2.3.4", "4111 1111 1111 1111", " ", "é", "\n", "99"]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 12))) for _ in range(500)] + ["a" * 200_000, None]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    for r in governance.masked(df).collect():
        want = texts[r.id]
        for kind, pattern in PLAIN_PATTERNS.items():
            found = len(re.findall(pattern, want or ""))
            want = want if want is None else re.sub(pattern, f"[{kind}]", want)
            assert r[f"n_{kind}"] == found, (texts[r.id], kind)
        assert r.text == want


def test_retention(spark):
    df = spark.createDataFrame([("2024-01-01",), ("2024-03-01",), (None,)], "d string").select(F.to_date("d").alias("d"))
    kept = governance.retained(df, "d", "2024-03-10", 30).collect()
    assert {str(r.d) for r in kept} == {"2024-03-01", "None"}
    assert [r.purged for r in governance.purged_counts(df, "d", "2024-03-10", 30).collect()] == [1]


@pytest.mark.parametrize("limit, kept", [(0.1, {2, 3}), (10.0, {1, 2, 3})])
def test_safe_texts(spark, limit, kept):
    df = spark.createDataFrame([(1, "bad bad"), (2, "fine"), (3, None)], "id int, text string")
    lexicon = Lexicon([]).overlay([("bad", "x", 1.0)])
    assert {r.id for r in governance.safe_texts(df, lexicon, limit).collect()} == kept
