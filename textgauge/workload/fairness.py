"""Fairness queries: ``documents`` with ``labels``, by language."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textgauge.operators import fairness
from textgauge.session import scratch_path
from textgauge.sources import sinks
from textgauge.workload.registry import documents, labelled, query

FLAGS = ("worthless", "license", "of the", "Member of")

FRAME = "WITH f AS (SELECT d.doc_id, d.text, d.lang, d.source, l.quality, l.toxic FROM documents d JOIN labels l USING (doc_id)) "
RATES = (
    "rates AS (SELECT lang AS g, avg({y}) AS r, count({y}) AS n, CAST(sum({y}) AS DOUBLE) AS s FROM f "
    "WHERE lang IS NOT NULL GROUP BY lang) "
)
DISPARITY = (
    "SELECT count(*) AS groups, round(CASE WHEN count(*) >= 2 THEN min({r}) / greatest(max({r}), 1e-9) ELSE 'nan'::DOUBLE "
    "END, 9) AS dir_ratio, round(CASE WHEN count(*) >= 2 THEN max({r}) - min({r}) ELSE 'nan'::DOUBLE END, 9) AS abs_diff "
)
WEIGHTS = (
    "weights AS (SELECT g, least(greatest((SELECT avg({y}) FROM f) / greatest(r, 1e-6), 0.5), 2.0) AS w FROM rates "
    "WHERE r IS NOT NULL) "
)


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 9) for c in columns})


@query("A12_group_rates", FRAME + ", " + RATES.format(y="quality")
       + 'SELECT g AS "group", round(r, 9) AS positive_rate, n FROM rates')
def group_rates(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(fairness.group_rates(labelled(spark, sf), "label", "lang"), "positive_rate")


@query("A13_disparity", FRAME + ", " + RATES.format(y="toxic") + DISPARITY.format(r="r") + "FROM rates")
def disparity(spark: SparkSession, sf: str) -> DataFrame:
    rates = fairness.group_rates(labelled(spark, sf, "toxic"), "label", "lang")
    return rounded(fairness.disparity(rates), "dir_ratio", "abs_diff")


@query("A13_disparity_of_one_group", "SELECT CAST(1 AS BIGINT) AS groups, 'nan'::DOUBLE AS dir_ratio, 'nan'::DOUBLE AS abs_diff")
def disparity_of_one_group(spark: SparkSession, sf: str) -> DataFrame:
    """With all rows in one group there is nothing to compare."""
    rows = labelled(spark, sf).withColumn("everyone", F.lit("all"))
    return fairness.disparity(fairness.group_rates(rows, "label", "everyone"))


BIAS = " + ".join(f"CAST(contains(lower(text), '{t}') AS INTEGER)" for t in FLAGS)


@query("A14_naive_bias_score", f"SELECT doc_id, {BIAS} AS bias_score FROM documents")
def naive_bias_score(spark: SparkSession, sf: str) -> DataFrame:
    return fairness.flag_texts(documents(spark, sf), terms=FLAGS).select("doc_id", "bias_score")


@query("P10_presence_flag", f"SELECT doc_id, CAST({BIAS} > 0 AS INTEGER) AS has_sensitive_flag FROM documents")
def presence_flag(spark: SparkSession, sf: str) -> DataFrame:
    return fairness.flag_texts(documents(spark, sf), terms=FLAGS).select("doc_id", "has_sensitive_flag")


@query("A15_flag_rates", f'SELECT lang AS "group", round(avg(CAST({BIAS} > 0 AS INTEGER)), 9) AS flag_rate FROM documents '
       "WHERE lang IS NOT NULL GROUP BY lang")
def flag_rates(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(fairness.flag_rates(fairness.flag_texts(documents(spark, sf), terms=FLAGS), "lang"), "flag_rate")


@query("A16_reweighting", FRAME + ", " + RATES.format(y="toxic") + ", " + WEIGHTS.format(y="toxic")
       + 'SELECT g AS "group", round(w, 9) AS weight FROM weights')
def reweighting(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(fairness.reweighting(labelled(spark, sf, "toxic"), "label", "lang"), "weight")


@query("J10_rows_with_weights", FRAME + ", " + RATES.format(y="toxic") + ", " + WEIGHTS.format(y="toxic")
       + "SELECT doc_id, lang, round(w, 9) AS weight FROM f LEFT JOIN weights ON lang = g")
def rows_with_weights(spark: SparkSession, sf: str) -> DataFrame:
    rows = labelled(spark, sf, "toxic")
    weights = fairness.reweighting(rows, "label", "lang")
    return rounded(fairness.attach_weights(rows, weights, "lang").select("doc_id", "lang", "weight"), "weight")


WEIGHTED = ("weighted AS (SELECT lang AS g, coalesce(sum(toxic * w), 0) / greatest(coalesce(sum(w), 0), 1e-9) AS wr "
            "FROM f LEFT JOIN weights ON lang = g GROUP BY lang) ")


GAPS = FRAME.replace("l.toxic FROM", "CASE WHEN doc_id % 9 > 0 AND d.lang <> 'es' THEN l.toxic END AS toxic FROM")


def with_gaps(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of which some, and all of one language, have no outcome."""
    known = (F.col("doc_id") % 9 > 0) & (F.col("lang") != "es")
    return labelled(spark, sf, "toxic").withColumn("label", F.when(known, F.col("label")))


@query("A17_weighted_rates", GAPS + ", " + RATES.format(y="toxic") + ", " + WEIGHTS.format(y="toxic") + ", " + WEIGHTED
       + 'SELECT g AS "group", round(wr, 9) AS w_positive_rate FROM weighted')
def weighted_rates(spark: SparkSession, sf: str) -> DataFrame:
    rows = with_gaps(spark, sf)
    weights = fairness.reweighting(rows, "label", "lang")
    return rounded(fairness.weighted_rates(rows, weights, "label", "lang"), "w_positive_rate")


@query("A17_weighted_disparity", FRAME + ", " + RATES.format(y="toxic") + ", " + WEIGHTS.format(y="toxic") + ", " + WEIGHTED
       + DISPARITY.format(r="wr") + "FROM weighted")
def weighted_disparity(spark: SparkSession, sf: str) -> DataFrame:
    rows = labelled(spark, sf, "toxic")
    weights = fairness.reweighting(rows, "label", "lang")
    after = fairness.disparity(fairness.weighted_rates(rows, weights, "label", "lang"), "w_positive_rate")
    return rounded(after, "dir_ratio", "abs_diff")


RUN = ("SELECT '{y}' AS run_id, (SELECT count({y}) FROM f WHERE lang IS NOT NULL) AS n_rows, groups, dir_ratio, abs_diff "
       "FROM ({d} FROM (SELECT avg({y}) AS r FROM f WHERE lang IS NOT NULL GROUP BY lang))")


@query("K6_run_table", FRAME + " UNION ALL ".join(RUN.format(y=y, d=DISPARITY.format(r="r")) for y in ("quality", "toxic")))
def run_table(spark: SparkSession, sf: str) -> DataFrame:
    """Two audits appended to one run table, then read back."""
    path = scratch_path(spark, "runs")
    for label in ("quality", "toxic"):
        rates = fairness.group_rates(labelled(spark, sf, label), "label", "lang")
        audit = rounded(fairness.disparity(rates), "dir_ratio", "abs_diff")
        n = rates.select(F.sum("n")).scalar()
        sinks.append_run(audit.select(F.lit(label).alias("run_id"), n.alias("n_rows"), "*"), path)
    return spark.read.parquet(path)
