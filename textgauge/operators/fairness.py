"""Group fairness: rates, disparity, naive flags and reweighting."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textgauge.functions.numbers import clip

# The naive flag terms.
FLAG_TERMS = ("pregnant", "age 62", "member of X group", "religion")

# Floors against division by zero and the range of weights.
RATE_FLOOR = 1e-9
WEIGHT_RATE_FLOOR = 1e-6
WEIGHT_RANGE = (0.5, 2.0)


def group_sums(df: DataFrame, y_col: str, group_col: str) -> DataFrame:
    """Sum and count of outcomes, and rows, per group; null group included."""
    return df.groupBy(F.col(group_col).alias("group")).agg(
        F.sum(F.col(y_col).cast("double")).alias("sum_y"), F.count(y_col).alias("n"), F.count(F.lit(1)).alias("n_rows")
    )


def group_rates(df: DataFrame, y_col: str, group_col: str) -> DataFrame:
    """Positive rate and size per group; rows without a group are left out."""
    sums = group_sums(df.where(F.col(group_col).isNotNull()), y_col, group_col)
    return sums.select("group", F.try_divide("sum_y", "n").alias("positive_rate"), "n")


def disparity(rates: DataFrame, rate_col: str = "positive_rate") -> DataFrame:
    """Disparate-impact ratio and absolute difference; NaN below two groups."""
    low, high, groups = F.min(rate_col), F.max(rate_col), F.count(F.lit(1))
    enough, nan = groups >= 2, F.lit(float("nan"))
    return rates.agg(
        groups.alias("groups"),
        F.when(enough, low / F.greatest(high, F.lit(RATE_FLOOR))).otherwise(nan).alias("dir_ratio"),
        F.when(enough, high - low).otherwise(nan).alias("abs_diff"),
    )


def bias_score(text: Column, terms: Sequence[str] = FLAG_TERMS) -> Column:
    """How many terms occur in the lower-cased text.

    Terms are compared as written, so one with capitals never occurs.
    """
    low = F.lower(text)
    return sum((F.contains(low, F.lit(term)).cast("int") for term in terms), F.lit(0))


def flag_texts(df: DataFrame, text_col: str = "text", terms: Sequence[str] = FLAG_TERMS) -> DataFrame:
    """Append ``bias_score`` and the 0/1 ``has_sensitive_flag``."""
    return df.withColumn("bias_score", F.coalesce(bias_score(F.col(text_col), terms), F.lit(0))).withColumn(
        "has_sensitive_flag", (F.col("bias_score") > 0).cast("int")
    )


def flag_rates(flagged: DataFrame, group_col: str) -> DataFrame:
    return (
        flagged.where(F.col(group_col).isNotNull())
        .groupBy(F.col(group_col).alias("group"))
        .agg(F.avg("has_sensitive_flag").alias("flag_rate"))
    )


def reweighting(df: DataFrame, y_col: str, group_col: str) -> DataFrame:
    """A weight per group that moves its rate towards the global rate.

    A group without any outcome has no rate and so no weight.

    The global rate comes from the grouped sums, so the table is aggregated
    once and no row-level join is needed.
    """
    sums = group_sums(df, y_col, group_col)
    target = sums.select(F.try_divide(F.sum("sum_y"), F.sum("n")).alias("target")).scalar()
    share = F.try_divide("sum_y", "n")
    weight = clip(target / F.greatest(share, F.lit(WEIGHT_RATE_FLOOR)), *WEIGHT_RANGE)
    # Filtering on the weight keeps the filter above the aggregate, which the
    # target can then share.
    named = F.when(F.col("group").isNotNull() & share.isNotNull(), weight).alias("weight")
    return sums.select("group", named).where("weight is not null")


def attach_weights(df: DataFrame, weights: DataFrame, group_col: str) -> DataFrame:
    """Each row with the weight of its group, null for an unknown group.

    One row per group: adaptive execution measures that side and chooses the join.
    """
    named = weights.select(F.col("group").alias("_group"), "weight")
    return df.join(named, F.col(group_col) == F.col("_group"), "left").drop("_group")


def weighted_rates(df: DataFrame, weights: DataFrame, y_col: str, group_col: str) -> DataFrame:
    """Weighted positive rate per group: rows without an outcome weigh as well.

    A group's weight is constant, so it is applied to the group's sums instead
    of its rows. For the same reason it cancels out of the ratio.
    """
    sums = group_sums(df.where(F.col(group_col).isNotNull()), y_col, group_col).alias("s")
    joined = sums.join(weights.alias("w"), F.col("s.group") == F.col("w.group"), "left")
    weight = F.coalesce(F.col("w.weight"), F.lit(0.0))
    positive = F.coalesce(F.col("s.sum_y"), F.lit(0.0))
    weighted = weight * positive / F.greatest(weight * F.col("s.n_rows"), F.lit(RATE_FLOOR))
    return joined.select(F.col("s.group").alias("group"), weighted.alias("w_positive_rate"))
