"""Fairness, metrics, ranks and features against plain Python."""

import math
import random

import pytest
from pyspark.sql import functions as F

from textgauge.operators import fairness, features, metrics
from textgauge.operators.ranking import running_totals


def test_group_rates_and_weights(spark):
    rows = [("a", 1), ("a", 0), ("a", 0), ("b", 1), ("b", 1), ("c", 0), (None, 1)]
    df = spark.createDataFrame(rows, "g string, y int")
    rates = {r.group: (r.positive_rate, r.n) for r in fairness.group_rates(df, "y", "g").collect()}
    assert rates == {"a": (1 / 3, 3), "b": (1.0, 2), "c": (0.0, 1)}
    gap = fairness.disparity(fairness.group_rates(df, "y", "g")).first()
    assert (gap.groups, gap.dir_ratio, gap.abs_diff) == (3, 0.0, 1.0)
    # The target is the rate of all rows, those without a group included.
    target = 4 / 7
    weights = {r.group: r.weight for r in fairness.reweighting(df, "y", "g").collect()}
    assert weights == pytest.approx({"a": target * 3, "b": target, "c": 2.0})
    weights_df = fairness.reweighting(df, "y", "g")
    after = {r.group: r.w_positive_rate for r in fairness.weighted_rates(df, weights_df, "y", "g").collect()}
    assert after == pytest.approx({"a": 1 / 3, "b": 1.0, "c": 0.0})
    attached = fairness.attach_weights(df, weights_df, "g").where("g is null").first()
    assert attached.weight is None


def test_rows_without_an_outcome_weigh_as_well(spark):
    rows = [("a", 1), ("a", 0), ("a", None), ("b", 1), ("c", None)]
    df = spark.createDataFrame(rows, "g string, y int")
    weights = fairness.reweighting(df, "y", "g")
    assert {r.group for r in weights.collect()} == {"a", "b"}
    after = {r.group: r.w_positive_rate for r in fairness.weighted_rates(df, weights, "y", "g").collect()}
    assert after == pytest.approx({"a": 1 / 3, "b": 1.0, "c": 0.0})


def test_one_group_has_no_disparity(spark):
    df = spark.createDataFrame([("a", 1), ("a", 0)], "g string, y int")
    gap = fairness.disparity(fairness.group_rates(df, "y", "g")).first()
    assert math.isnan(gap.dir_ratio) and math.isnan(gap.abs_diff)


def test_flag_terms_are_compared_as_written(spark):
    df = spark.createDataFrame([("Pregnant, age 62, member of X group",), (None,)], "text string")
    assert [r.bias_score for r in fairness.flag_texts(df).collect()] == [2, 0]


def pairwise_auc(rows):
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    won = sum((p > n) + (p == n) / 2 for p in pos for n in neg)
    return won / (len(pos) * len(neg))


@pytest.mark.parametrize("buckets", [1, 3, 8])
@pytest.mark.parametrize("digits", [1, 6])
def test_auc_equals_all_pairs(spark, buckets, digits):
    rng = random.Random(digits)
    rows = [(int(rng.random() < 0.4), round(rng.random() ** 3, digits)) for _ in range(300)]
    df = spark.createDataFrame(rows, "label int, score double")
    assert metrics.roc_auc(df, buckets=buckets).first().roc_auc == pytest.approx(pairwise_auc(rows), abs=1e-12)


def test_auc_edge_cases(spark):
    tied = spark.createDataFrame([(1, 0.5), (0, 0.5), (0, 0.5)], "label int, score double")
    assert metrics.roc_auc(tied).first().roc_auc == 0.5
    one_class = spark.createDataFrame([(1, 0.5), (1, 0.7)], "label int, score double")
    assert metrics.roc_auc(one_class).first().roc_auc is None


@pytest.mark.parametrize("buckets", [1, 4])
def test_roc_curve(spark, buckets):
    rows = [(1, 0.9), (1, 0.8), (0, 0.8), (1, 0.7), (0, 0.6), (0, 0.5), (1, 0.4), (0, 0.3), (0, 0.2)]
    df = spark.createDataFrame(rows, "label int, score double")
    full = metrics.roc_curve(df, thin=False, buckets=buckets).orderBy(F.desc("threshold")).collect()
    assert [round(r.threshold, 1) for r in full] == [math.inf, 0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2]
    assert [(r.fpr, r.tpr) for r in full][-1] == (1.0, 1.0)
    points = [(r.fpr, r.tpr) for r in full]
    kept = [(r.fpr, r.tpr) for r in metrics.roc_curve(df, buckets=buckets).orderBy(F.desc("threshold")).collect()]
    steps = [(round(b[0] - a[0], 9), round(b[1] - a[1], 9)) for a, b in zip(points, points[1:])]
    corners = [p for i, p in enumerate(points) if i in (0, 1, len(points) - 1) or steps[i - 1] != steps[i]]
    assert kept == corners


def test_running_totals(spark):
    rows = [(i, float(v), v % 5) for i, v in enumerate(random.Random(1).sample(range(1000), 200))]
    df = spark.createDataFrame(rows, "id int, v double, n int")
    for descending in (False, True):
        out = {r.v: (r.cum_n, r.next_n) for r in running_totals(df, "v", ["n"], descending, True, buckets=7).collect()}
        total, ordered = 0, sorted(rows, key=lambda r: r[1], reverse=descending)
        for i, (_, v, n) in enumerate(ordered):
            total += n
            assert out[v] == (total, ordered[i + 1][2] if i + 1 < len(ordered) else None)


def test_classification_report(spark):
    rows = [(0, 0)] * 5 + [(0, 1)] * 2 + [(1, 1)] * 3 + [(1, 0)]
    report = {r["class"]: r for r in metrics.classification_report(
        spark.createDataFrame(rows, "label int, prediction int")).collect()}
    assert report["1"].precision == 3 / 5 and report["1"].recall == 3 / 4 and report["1"].support == 4
    assert report["accuracy"].f1 == 8 / 11
    assert report["macro avg"].recall == pytest.approx((5 / 7 + 3 / 4) / 2)
    assert report["weighted avg"].recall == pytest.approx(8 / 11)
    never = spark.createDataFrame([(1, 0), (0, 0)], "label int, prediction int")
    assert metrics.classification_report(never).where("class = '1'").first().precision == 0.0


def test_hardest_errors(spark):
    df = spark.createDataFrame([(1, 1, 0, 0.45), (2, 0, 1, 0.9), (3, 1, 1, 0.6), (4, 0, 1, 0.52)],
                               "id int, label int, prediction int, score double")
    wrong = metrics.misclassified(df)
    assert [r.id for r in metrics.hardest(wrong, "id", 2).collect()] == [4, 1]


def python_tfidf(texts, n_max, min_df, stop=()):
    docs = []
    for text in texts:
        import re
        toks = [t for t in re.findall(r"\w\w+", text.lower()) if t not in stop]
        grams = [" ".join(toks[i:i + n]) for n in range(1, n_max + 1) for i in range(len(toks) - n + 1)]
        docs.append({g: grams.count(g) for g in grams})
    df = {}
    for d in docs:
        for g in d:
            df[g] = df.get(g, 0) + 1
    out = {}
    for i, d in enumerate(docs):
        w = {g: c * (math.log((1 + len(docs)) / (1 + df[g])) + 1) for g, c in d.items() if df[g] >= min_df}
        norm = math.sqrt(sum(v * v for v in w.values()))
        out |= {(i, g): v / norm for g, v in w.items()}
    return out


@pytest.mark.parametrize("n_max,min_df,stop", [(1, 1, ()), (2, 1, ()), (3, 2, ("the",))])
def test_tfidf(spark, n_max, min_df, stop):
    texts = ["The cat and the dog", "the élan of the cat, a cat", "", "I", "dog dog dog cat and the dog"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    rows = features.tfidf(df, "id", n_max=n_max, min_df=min_df, stop_words=stop).collect()
    assert {(r.id, r.term): r.weight for r in rows} == pytest.approx(python_tfidf(texts, n_max, min_df, stop))


def test_max_features_keeps_the_most_frequent(spark):
    df = spark.createDataFrame([(1, "bb bb aa cc"), (2, "aa bb dd")], "id int, text string")
    assert {r.term for r in features.tfidf(df, "id", max_features=2).collect()} == {"bb", "aa"}


def test_class_weights(spark):
    df = spark.createDataFrame([(1,), (0,), (0,), (0,)], "label int")
    assert {r.label: r.weight for r in features.balanced_class_weights(df).collect()} == {1: 2.0, 0: 4 / 6}


@pytest.mark.parametrize("n0,n1,test_size,val_size", [(50, 30, 0.2, 0.0), (7, 2, 0.2, 0.1), (101, 13, 0.1, 0.1)])
def test_split_sizes(spark, n0, n1, test_size, val_size):
    df = spark.range(n0 + n1).select("id", (F.col("id") >= n0).cast("int").alias("label"))
    cuts = features.fit_split(df, "id", test_size=test_size, val_size=val_size)
    counts = {(r.label, r.split): r["count"] for r in
              features.apply_split(df, cuts, "id").groupBy("label", "split").count().collect()}
    for label, n in ((0, n0), (1, n1)):
        held = math.ceil(n * (test_size + val_size))
        test = math.ceil(held * (1 - val_size / (test_size + val_size))) if val_size else held
        assert counts.get((label, "test"), 0) == test
        assert counts.get((label, "val"), 0) == held - test
        assert counts.get((label, "train"), 0) == n - held


def test_folds_are_even_and_independent_of_layout(spark):
    df = spark.range(103).select("id", (F.col("id") % 3 == 0).cast("int").alias("label"))
    placed = []
    for parts in (1, 16):
        cuts = features.fit_folds(df.repartition(parts), "id")
        placed.append(sorted(map(tuple, features.apply_folds(df, cuts, "id").select("id", "fold").collect())))
    assert placed[0] == placed[1]
    cuts = features.fit_folds(df, "id")
    for label in (0, 1):
        sizes = [r["count"] for r in features.apply_folds(df, cuts, "id").where(f"label = {label}").groupBy("fold").count().collect()]
        assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1




def test_few_features_are_counted_without_writing_all_terms(spark, monkeypatch):
    """Terms that are frequent in too few texts make room for others; rare terms are not written."""
    rnd = random.Random(4)
    texts = [" ".join(rnd.choice(["aa", "bb", "cc", "dd", "ee", "ff"]) for _ in range(rnd.randint(0, 12))) for _ in range(40)]
    texts += [f"w{k}w " * (100 + k) + f"x{k}x" for k in range(30)] + [None, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    written, real = {}, features.materialise

    def kept_table(rows, label):
        written[label] = real(rows, label)
        return written[label]

    monkeypatch.setattr(features, "materialise", kept_table)
    for n_max in (1, 2):
        written.clear()
        found = features.tfidf(df, "id", n_max=n_max, min_df=3, max_features=4).collect()
        full = features.tf_table(df, "id", n_max=n_max)
        kept = {r.term for r in features.vocabulary(full, F.lit(len(texts)), 3, 4).collect()}
        assert len(kept) == 4 and not any(t.startswith("w") for t in kept)
        assert written["terms"].select("term").distinct().count() < full.select("term").distinct().count()
        tf = {(r.id, r.term): r.tf for r in full.collect() if r.term in kept}
        df_of = {t: sum(1 for _, u in tf if u == t) for t in kept}
        w = {k: n * (math.log((1 + len(texts)) / (1 + df_of[k[1]])) + 1) for k, n in tf.items()}
        length = {i: math.sqrt(sum(v * v for (j, _), v in w.items() if j == i)) for i, _ in w}
        assert {(r.id, r.term) for r in found} == set(w)
        assert all(abs(r.weight - w[r.id, r.term] / length[r.id]) < 1e-12 for r in found)
