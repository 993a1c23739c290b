"""Run-table queries: each order stands for a run with its steps and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textgauge.functions.time import utc_text
from textgauge.operators import runs
from textgauge.session import scratch_path
from textgauge.sources.manifests import read_manifests
from textgauge.sources.tables import table
from textgauge.workload.registry import query, spread

STEPS = list(runs.REPORTS.values())


def manifests(spark: SparkSession, sf: str) -> DataFrame:
    """Nested manifests, built inside each order row.

    Urgent runs keep their reports in an archive. Open ones never trained, some
    runs have no steps, some repeat a step's name, and some list plain paths.
    """
    key = F.col("o_orderkey")
    folder = F.when(F.col("o_orderpriority") == "1-URGENT", "archive/").otherwise("runs/")

    def artifact(name: str) -> Column:
        path = F.concat(folder, key.cast("string"), F.lit("/" + name))
        known = F.struct(
            path.alias("path"),
            (F.col("o_orderstatus") != "P").alias("exists"),
            F.round("o_totalprice").cast("bigint").alias("bytes"),
        )
        return F.when(key % 7 == 0, path).otherwise(F.to_json(known))

    def step(name: str, artifacts: list[Column]) -> Column:
        return F.struct(
            F.lit(name).alias("name"),
            F.array(F.lit("run"), F.lit(name)).alias("command"),
            F.lit("").alias("stdout"),
            F.lit("").alias("stderr"),
            F.array(*artifacts).alias("artifacts"),
        )

    steps = [step(name, [artifact("summary.md"), artifact(report)]) for name, report in STEPS]
    trained = F.when(F.col("o_orderstatus") == "O", F.array(*steps[:2])).otherwise(F.array(*steps))
    again = F.array(step(STEPS[0][0], [artifact("summary.md")]))
    trained = F.when(key % 5 == 0, F.concat(trained, again)).otherwise(trained)
    trained = F.when(key % 22 == 0, F.slice(trained, 1, 0)).when(key % 11 != 0, trained)
    return spread(table(spark, sf, "orders")).select(
        F.col("o_orderkey").cast("string").alias("generated_at_utc"),
        F.when(F.col("o_orderstatus") == "P", "failed").otherwise("passed").alias("status"),
        trained.alias("steps"),
    )


def artifacts(spark: SparkSession, sf: str) -> DataFrame:
    run_id = F.col("generated_at_utc").cast("bigint").alias("run_id")
    flat = manifests(spark, sf).select(run_id, "steps", F.concat(F.lit("runs/"), "generated_at_utc").alias("base_dir"))
    return runs.artifact_rows(flat, "run_id", "base_dir")


NAMED = ", ".join(f"({i}, '{step}', '{report}')" for i, (step, report) in enumerate(STEPS))
FLAT = (
    f"WITH s AS (SELECT * FROM (VALUES {NAMED}) AS v(no, step, report)), "
    "k AS (SELECT *, CASE WHEN o_orderkey % 11 = 0 THEN 0 WHEN o_orderstatus = 'O' THEN 2 ELSE 3 END AS n FROM orders), "
    "t AS (SELECT k.*, no, step, report FROM k JOIN s ON no < n UNION ALL "
    f"SELECT k.*, n, '{STEPS[0][0]}', NULL FROM k WHERE n > 0 AND o_orderkey % 5 = 0), "
    "a AS (SELECT o_orderkey AS run_id, no, step, CASE WHEN o_orderpriority = '1-URGENT' THEN 'archive/' ELSE 'runs/' END || "
    "o_orderkey || '/' || f AS path, CASE WHEN o_orderkey % 7 <> 0 THEN o_orderstatus <> 'P' END AS ok, "
    "CASE WHEN o_orderkey % 7 <> 0 THEN CAST(round(o_totalprice) AS BIGINT) END AS bytes "
    "FROM t, LATERAL (SELECT 'summary.md' AS f UNION ALL SELECT report) x WHERE f IS NOT NULL) "
)


@query("S11_manifests", FLAT + "SELECT o_orderkey AS run_id, CASE WHEN o_orderstatus <> 'P' THEN 'passed' ELSE 'failed' END AS status, "
       "CAST(no AS INTEGER) AS step_no, step, path, ok AS \"exists\", bytes FROM orders LEFT JOIN a ON run_id = o_orderkey")
def manifest_rows(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "manifests")
    manifests(spark, sf).write.json(path)
    back = read_manifests(spark, path, multi_line=False).withColumn("run_id", F.col("generated_at_utc").cast("bigint"))
    return runs.artifact_rows(back, "run_id", "status").drop("artifact_no")


@query("A22_run_summary", FLAT + "SELECT o_orderkey AS run_id, count(DISTINCT no) AS steps, count(path) AS artifacts, "
       "count(*) FILTER (NOT ok) AS missing, CAST(coalesce(sum(bytes), 0) AS BIGINT) AS bytes "
       "FROM orders LEFT JOIN a ON run_id = o_orderkey GROUP BY o_orderkey")
def run_summary(spark: SparkSession, sf: str) -> DataFrame:
    return runs.run_summary(artifacts(spark, sf), "run_id")


@query("A22_missing_artifacts", FLAT + "SELECT run_id, path FROM a WHERE NOT ok")
def missing_artifacts(spark: SparkSession, sf: str) -> DataFrame:
    return runs.missing_artifacts(artifacts(spark, sf)).select("run_id", "path")


REPORTS = (
    FLAT + ", r AS (SELECT * FROM (VALUES "
    + ", ".join(f"('{name}', '{step}', '{suffix}')" for name, (step, suffix) in runs.REPORTS.items())
    + ") AS v(report, step, suffix)), "
    "paths AS (SELECT o_orderkey AS run_id, r.report, coalesce(min(a.path), 'runs/' || o_orderkey || '/' || r.suffix) AS path "
    "FROM orders CROSS JOIN r LEFT JOIN a ON a.run_id = o_orderkey AND a.step = r.step AND a.path LIKE '%' || r.suffix "
    "GROUP BY o_orderkey, r.report, r.suffix) "
)


@query("F16_report_paths", REPORTS + "SELECT run_id, report, path FROM paths")
def report_paths(spark: SparkSession, sf: str) -> DataFrame:
    return runs.report_paths(artifacts(spark, sf), "run_id", "base_dir")


@query(
    "J11_attached_reports",
    REPORTS + "SELECT run_id, report, CASE WHEN o_orderstatus = 'F' AND path LIKE 'runs/%' AND report = 'bias_report' "
    "THEN 'rows of ' || o_custkey END AS content FROM paths JOIN orders ON run_id = o_orderkey",
)
def attached_reports(spark: SparkSession, sf: str) -> DataFrame:
    """Only some runs left a bias report, and none in the archive."""
    stored = table(spark, sf, "orders").where("o_orderstatus = 'F'").select(
        F.concat(F.lit("file:///lab/runs/"), "o_orderkey", F.lit("/" + runs.REPORTS["bias_report"][1])).alias("path"),
        F.concat(F.lit("rows of "), "o_custkey").alias("content"),
    )
    stored = stored.withColumn("path", runs.uri(F.col("path")))
    paths = runs.report_paths(artifacts(spark, sf), "run_id", "base_dir", root="/lab")
    return runs.attach_reports(paths, stored).select("run_id", "report", "content")


@query(
    "P13_model_card_facts",
    "SELECT CASE WHEN o_orderstatus = 'P' THEN 'unknown' ELSE CAST(o_orderkey AS VARCHAR) END AS run_id, "
    "CASE WHEN o_orderpriority = '5-LOW' THEN 'unknown' ELSE 'models/' || o_orderkey END AS model_path, "
    "CASE WHEN o_orderstatus = 'P' THEN 0 ELSE o_custkey END AS train_rows, CAST(0 AS BIGINT) AS val_rows, "
    "CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_totalprice END AS test_roc_auc FROM orders",
)
def model_card_facts(spark: SparkSession, sf: str) -> DataFrame:
    """Training summaries with gaps."""
    status, nothing = F.col("o_orderstatus"), F.lit(None)
    summaries = table(spark, sf, "orders").select(
        F.when(status != "P", F.col("o_orderkey").cast("string")).alias("run_id"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("timestamp_utc"),
        F.struct(
            F.when(F.col("o_orderpriority") != "5-LOW", F.concat(F.lit("models/"), "o_orderkey")).alias("model_path")
        ).alias("artifacts"),
        nothing.cast("string").alias("data_path"),
        nothing.cast("string").alias("data_sha256"),
        nothing.cast("bigint").alias("rows"),
        nothing.cast("map<string,bigint>").alias("class_dist"),
        F.when(
            status != "P",
            F.struct(
                F.col("o_custkey").alias("train"), nothing.cast("bigint").alias("val"), F.lit(8).alias("test")
            ),
        ).alias("splits"),
        F.struct(
            F.when(status != "F", F.col("o_totalprice")).alias("roc_auc"),
            nothing.cast("array<array<bigint>>").alias("confusion_matrix"),
        ).alias("test"),
    )
    return runs.model_card_facts(summaries).select("run_id", "model_path", "train_rows", "val_rows", "test_roc_auc")


@query("F13_run_times", "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS at FROM events")
def run_times(spark: SparkSession, sf: str) -> DataFrame:
    """Timestamps become text only on output."""
    return table(spark, sf, "events").select("event_id", utc_text(F.col("ts")).alias("at"))
