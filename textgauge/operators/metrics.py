"""Classifier metrics over (label, prediction, score) tables.

Rows are first counted per (label, prediction) or per distinct score, so the
steps that need an order see few rows; those run in buckets, see ``ranking``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textgauge.functions.numbers import ratio_or_zero
from textgauge.operators.ranking import running_totals

THRESHOLD = 0.5


def predict(score: Column, threshold: float = THRESHOLD) -> Column:
    return (score >= F.lit(threshold)).cast("int")


def confusion_matrix(df: DataFrame, label_col: str = "label", pred_col: str = "prediction") -> DataFrame:
    """One row per true class with the counts of predicted 0 and 1."""
    return df.groupBy(F.col(label_col).alias("label")).agg(
        F.count_if(F.col(pred_col) == 0).alias("predicted_0"), F.count_if(F.col(pred_col) == 1).alias("predicted_1")
    )


def class_counts(df: DataFrame, label_col: str, pred_col: str) -> DataFrame:
    """Hits, predictions and support per class seen as label or prediction."""
    pairs = df.groupBy(F.col(label_col).alias("label"), F.col(pred_col).alias("pred")).agg(F.count(F.lit(1)).alias("n"))
    zero, n = F.lit(0).cast("long"), F.col("n")
    hit = F.when(F.col("label") == F.col("pred"), n).otherwise(zero)
    sides = F.array(
        F.struct(F.col("label").cast("string").alias("class"), hit.alias("hits"), zero.alias("predicted"), n.alias("support")),
        F.struct(F.col("pred").cast("string").alias("class"), zero.alias("hits"), n.alias("predicted"), zero.alias("support")),
    )
    return pairs.select(F.inline(sides)).groupBy("class").agg(
        F.sum("hits").alias("hits"), F.sum("predicted").alias("predicted"), F.sum("support").alias("support")
    )


def classification_report(df: DataFrame, label_col: str = "label", pred_col: str = "prediction") -> DataFrame:
    """Precision, recall, F1 and support per class, then the averages.

    Undefined ratios are 0. The accuracy stands in the ``f1`` column of its row.
    """
    counts = class_counts(df, label_col, pred_col)
    per_class = counts.select(
        "class",
        ratio_or_zero(F.col("hits"), F.col("predicted")).alias("precision"),
        ratio_or_zero(F.col("hits"), F.col("support")).alias("recall"),
        ratio_or_zero(2 * F.col("hits"), F.col("predicted") + F.col("support")).alias("f1"),
        "support",
        "hits",
    )
    total = F.sum("support")

    def weighted(column: str) -> Column:
        return ratio_or_zero(F.sum(F.col(column) * F.col("support")), total)

    names = ("precision", "recall", "f1")
    averages = per_class.agg(
        F.struct(F.lit("accuracy").alias("class"), F.lit(None).cast("double").alias("precision"),
                 F.lit(None).cast("double").alias("recall"), ratio_or_zero(F.sum("hits"), total).alias("f1"),
                 total.alias("support")).alias("accuracy"),
        F.struct(F.lit("macro avg").alias("class"), *[F.avg(c).alias(c) for c in names],
                 total.alias("support")).alias("macro"),
        F.struct(F.lit("weighted avg").alias("class"), *[weighted(c).alias(c) for c in names],
                 total.alias("support")).alias("weighted"),
    ).select(F.inline(F.array("accuracy", "macro", "weighted")))
    return per_class.drop("hits").unionByName(averages)


def score_counts(df: DataFrame, label_col: str, score_col: str) -> DataFrame:
    """Positives and negatives per distinct score."""
    return df.groupBy(F.col(score_col).cast("double").alias("score")).agg(
        F.count_if(F.col(label_col) == 1).alias("pos"), F.count_if(F.col(label_col) == 0).alias("neg")
    )


def roc_auc(df: DataFrame, label_col: str = "label", score_col: str = "score", buckets: int | None = None) -> DataFrame:
    """Exact area under the ROC curve, ties counted half; null with one class."""
    ranked = running_totals(score_counts(df, label_col, score_col), "score", ["pos", "neg"], buckets=buckets)
    below = (F.col("cum_neg") - F.col("neg")).cast("double")
    won = F.sum(F.col("pos").cast("double") * (below + F.col("neg") / 2))
    positives, negatives = F.sum("pos"), F.sum("neg")
    return ranked.agg(
        positives.alias("positives"),
        negatives.alias("negatives"),
        F.try_divide(won, positives.cast("double") * negatives.cast("double")).alias("roc_auc"),
    )


def roc_curve(
    df: DataFrame, label_col: str = "label", score_col: str = "score", thin: bool = True, buckets: int | None = None
) -> DataFrame:
    """False and true positive rates per threshold, from (0, 0) at infinity.

    ``thin`` leaves out a point when the step after it repeats the step to it,
    since it then lies on the line between its neighbours.
    """
    counts = score_counts(df, label_col, score_col)
    ranked = running_totals(counts, "score", ["pos", "neg"], descending=True, lookahead=thin, buckets=buckets)
    # the counts were written for the ranks: the totals come from there, not from the source
    totals = ranked.agg(F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    points = ranked
    if thin:
        is_first = (F.col("cum_pos") == F.col("pos")) & (F.col("cum_neg") == F.col("neg"))
        is_last = F.col("next_pos").isNull()
        turns = (F.col("next_pos") != F.col("pos")) | (F.col("next_neg") != F.col("neg"))
        points = ranked.where(is_first | is_last | turns)
    rates = points.select(
        F.col("score").alias("threshold"),
        ratio_or_zero(F.col("cum_neg"), totals.select("n").scalar()).alias("fpr"),
        ratio_or_zero(F.col("cum_pos"), totals.select("p").scalar()).alias("tpr"),
    )
    start = totals.select(F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return start.unionByName(rates)


def misclassified(
    df: DataFrame, label_col: str = "label", pred_col: str = "prediction", score_col: str = "score"
) -> DataFrame:
    """Wrong rows with their distance from the threshold."""
    wrong = df.where(F.col(pred_col) != F.col(label_col))
    return wrong.withColumn("margin", F.abs(F.col(score_col) - F.lit(THRESHOLD)))


def hardest(wrong: DataFrame, id_col: str, limit: int = 10) -> DataFrame:
    """The wrong rows closest to the threshold."""
    return wrong.orderBy("margin", id_col).limit(limit)
