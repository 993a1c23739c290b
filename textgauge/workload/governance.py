"""Governance queries over ``documents``, ``labels`` and ``orders``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textgauge.operators import governance
from textgauge.operators.metrics import predict
from textgauge.sources.tables import table
from textgauge.workload.audit import FULL, LEXICON, OPTIONS
from textgauge.workload.registry import documents, labelled, query


@query(
    "X1_representation",
    "WITH c AS (SELECT lang, source, count(*) AS n FROM documents GROUP BY ALL) SELECT lang, source, n, "
    "round(n / sum(n) OVER (), 9) AS share, n / sum(n) OVER () * count(*) OVER () < 0.5 AS under_represented FROM c",
)
def representation(spark: SparkSession, sf: str) -> DataFrame:
    return governance.representation(documents(spark, sf), ["lang", "source"]).withColumn("share", F.round("share", 9))


ERRORS = (
    "WITH s AS (SELECT d.lang AS g, l.quality AS y, CAST(d.n_chars / (d.n_chars + 1000.0::DOUBLE) >= 0.5 AS INTEGER) AS p "
    "FROM documents d JOIN labels l USING (doc_id) WHERE d.lang IS NOT NULL), "
    'e AS (SELECT g AS "group", count(*) FILTER (y = 0) AS negatives, count(*) FILTER (y = 1) AS positives, '
    "count(*) FILTER (y = 0 AND p = 1) AS false_positives, count(*) FILTER (y = 1 AND p = 0) AS false_negatives FROM s GROUP BY g), "
    "r AS (SELECT *, round(coalesce(false_positives / nullif(negatives, 0), 0), 9) AS fpr, "
    "round(coalesce(false_negatives / nullif(positives, 0), 0), 9) AS fnr FROM e) "
)


def rates(spark: SparkSession, sf: str) -> DataFrame:
    score = F.col("n_chars") / (F.col("n_chars") + F.lit(1000.0))
    rows = labelled(spark, sf).withColumn("prediction", predict(score))
    return governance.error_rates(rows, "lang").withColumns({c: F.round(c, 9) for c in ("fpr", "fnr")})


@query("X2_error_rates", ERRORS + "SELECT * FROM r")
def error_rates(spark: SparkSession, sf: str) -> DataFrame:
    return rates(spark, sf)


@query("X2_error_gaps", ERRORS + "SELECT count(*) AS groups, round(max(fpr) - min(fpr), 9) AS fpr_gap, "
       "round(max(fnr) - min(fnr), 9) AS fnr_gap FROM r")
def error_gaps(spark: SparkSession, sf: str) -> DataFrame:
    gaps = governance.error_gaps(rates(spark, sf))
    return gaps.withColumns({c: F.round(c, 9) for c in ("fpr_gap", "fnr_gap")})


@query(
    "X3_mitigation_effects",
    "WITH r AS (SELECT o_orderpriority AS series, strftime(o_orderdate, '%Y-%m') AS month, "
    "avg(CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END) AS rate FROM orders GROUP BY ALL) "
    "SELECT series, month, round(rate, 9) AS rate, round(rate - lag(rate) OVER w, 9) AS change, "
    "round(rate - first(rate) OVER w, 9) AS since_first FROM r WINDOW w AS (PARTITION BY series ORDER BY month)",
)
def mitigation_effects(spark: SparkSession, sf: str) -> DataFrame:
    """Monthly runs per priority; the rate of finished orders is what changes."""
    finished = F.when(F.col("o_orderstatus") == "F", 1.0).otherwise(0.0)
    runs = table(spark, sf, "orders").groupBy(
        F.col("o_orderpriority").alias("series"), F.date_format("o_orderdate", "yyyy-MM").alias("month")
    ).agg(F.avg(finished).alias("rate"))
    effects = governance.mitigation_effects(runs, "series", "month", "rate")
    return effects.withColumns({c: F.round(c, 9) for c in ("rate", "change", "since_first")})


# The same patterns without the marks that only save time.
PLAIN_PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "card": governance.PERSONAL_DATA["card"],
    "ip": governance.PERSONAL_DATA["ip"],
    "phone": governance.PERSONAL_DATA["phone"],
}
MASKED_SQL, _text, _counts = "", "text", []
for _kind, _pattern in PLAIN_PATTERNS.items():
    _counts.append(f"CAST(len(regexp_extract_all({_text}, '{_pattern}')) AS INTEGER) AS n_{_kind}")
    _text = f"regexp_replace({_text}, '{_pattern}', '[{_kind}]', 'g')"
MASKED_SQL = f"SELECT doc_id, {', '.join(_counts)}, {_text} AS text FROM documents"


@query("X4_masked_texts", MASKED_SQL)
def masked_texts(spark: SparkSession, sf: str) -> DataFrame:
    return governance.masked(documents(spark, sf).select("doc_id", "text"))


@query("X5_retained_orders", "SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= DATE '1998-08-02' - 1000")
def retained_orders(spark: SparkSession, sf: str) -> DataFrame:
    return governance.retained(table(spark, sf, "orders"), "o_orderdate", "1998-08-02", 1000).select("o_orderkey", "o_orderdate")


@query(
    "X5_purge_log",
    "SELECT o_orderpriority, count(*) AS purged, min(o_orderdate) AS oldest, max(o_orderdate) AS newest FROM orders "
    "WHERE o_orderdate < DATE '1998-08-02' - 1000 GROUP BY o_orderpriority",
)
def purge_log(spark: SparkSession, sf: str) -> DataFrame:
    return governance.purged_counts(table(spark, sf, "orders"), "o_orderdate", "1998-08-02", 1000, "o_orderpriority")


@query("X6_safe_texts", FULL + "SELECT doc_id, score, text FROM scored WHERE score < 2.0")
def safe_texts(spark: SparkSession, sf: str) -> DataFrame:
    return governance.safe_texts(documents(spark, sf), LEXICON, 2.0, **OPTIONS).select("doc_id", "score", "text")
