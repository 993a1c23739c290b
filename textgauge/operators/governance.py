"""Governance of data sets: representation, error rates, trends, masks, retention, safety.

All are expressions or aggregates that combine in each task first; nothing but
grouped rows is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textgauge.functions.numbers import ratio_or_zero
from textgauge.operators.lexicon import Lexicon
from textgauge.operators.scoring import MIN_SCORE, score_rows

# Kinds of personal data, in the order they are masked. ``\G`` lets a match
# begin where the last one ended; without it or the look-behind, a long run of
# letters would be tried from each of its places.
LOCAL = r"[A-Za-z0-9._%+-]"
PERSONAL_DATA = {
    "email": rf"(?:\G|(?<!{LOCAL})){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "card": r"[0-9](?:[ -]?[0-9]){12,18}",
    "ip": r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}",
    "phone": r"\+[0-9][ ().0-9-]{7,20}[0-9]",
}


def representation(df: DataFrame, group_cols: Sequence[str], floor: float = 0.5) -> DataFrame:
    """Rows and share per group; ``under_represented`` is less than ``floor`` of an even share.

    Null groups count as groups.
    """
    counts = df.groupBy(*group_cols).agg(F.count(F.lit(1)).alias("n"))
    total = counts.select(F.sum("n")).scalar()
    groups = counts.select(F.count(F.lit(1))).scalar()
    share = F.col("n") / total
    return counts.select(*group_cols, "n", share.alias("share"), (share * groups < F.lit(floor)).alias("under_represented"))


def error_rates(df: DataFrame, group_col: str, label_col: str = "label", pred_col: str = "prediction") -> DataFrame:
    """False positive and false negative rate per group; 0 where a group has no such rows.

    Rows without a group, label or prediction are left out.
    """
    y, p = F.col(label_col), F.col(pred_col)
    known = df.where(F.col(group_col).isNotNull() & y.isNotNull() & p.isNotNull())
    sums = known.groupBy(F.col(group_col).alias("group")).agg(
        F.count_if(y == 0).alias("negatives"),
        F.count_if(y == 1).alias("positives"),
        F.count_if((y == 0) & (p == 1)).alias("false_positives"),
        F.count_if((y == 1) & (p == 0)).alias("false_negatives"),
    )
    return sums.select(
        "*",
        ratio_or_zero(F.col("false_positives"), F.col("negatives")).alias("fpr"),
        ratio_or_zero(F.col("false_negatives"), F.col("positives")).alias("fnr"),
    )


def error_gaps(rates: DataFrame) -> DataFrame:
    """How far the groups' error rates are apart."""
    return rates.agg(
        F.count(F.lit(1)).alias("groups"),
        (F.max("fpr") - F.min("fpr")).alias("fpr_gap"),
        (F.max("fnr") - F.min("fnr")).alias("fnr_gap"),
    )


def mitigation_effects(runs: DataFrame, series_col: str, time_col: str, metric_col: str) -> DataFrame:
    """Each run's metric beside the run before and the first of its series.

    A run table has one row per run, so a series is short.
    """
    order = Window.partitionBy(series_col).orderBy(time_col)
    before, first = F.lag(metric_col).over(order), F.first(metric_col).over(order)
    return runs.withColumns({"change": F.col(metric_col) - before, "since_first": F.col(metric_col) - first})


def mask_personal_data(text: Column) -> Column:
    """The text with each find replaced by its kind in brackets."""
    for kind, pattern in PERSONAL_DATA.items():
        text = F.regexp_replace(text, pattern, f"[{kind}]")
    return text


def masked(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Mask ``text_col`` and append the finds per kind; a null text has none and stays null."""
    counts, text = {}, F.col(text_col)
    for kind, pattern in PERSONAL_DATA.items():
        # kinds masked before are not counted again
        counts[f"n_{kind}"] = F.coalesce(F.regexp_count(text, F.lit(pattern)), F.lit(0))
        text = F.regexp_replace(text, pattern, f"[{kind}]")
    return df.withColumns(counts).withColumn(text_col, text)


def retained(df: DataFrame, date_col: str, as_of: str, days: int) -> DataFrame:
    """Rows not older than ``days`` on a day; a predicate that files are pruned by.

    Rows without a date are kept: nothing says they are old.
    """
    oldest = F.date_sub(F.lit(as_of).cast("date"), days)
    return df.where(F.col(date_col).isNull() | (F.col(date_col) >= oldest))


def purged_counts(df: DataFrame, date_col: str, as_of: str, days: int, *group_cols: str) -> DataFrame:
    """What a purge removes, per group, for its log."""
    oldest = F.date_sub(F.lit(as_of).cast("date"), days)
    return df.where(F.col(date_col) < oldest).groupBy(*group_cols).agg(
        F.count(F.lit(1)).alias("purged"), F.min(date_col).alias("oldest"), F.max(date_col).alias("newest")
    )


def safe_texts(df: DataFrame, lexicon: Lexicon, max_score: float = MIN_SCORE, **options) -> DataFrame:
    """Rows whose lexicon score stays under ``max_score``, with the score."""
    return score_rows(df, lexicon, **options).where(F.col("score") < max_score)
