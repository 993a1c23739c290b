"""Run tables: manifests, their artifacts and the reports they lead to.

The working form is flat, one row per artifact, so a run with very many
artifacts is never gathered into one row.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The nested form of a manifest. An artifact is an object or a
# plain path; read as text, an object is its own JSON.
MANIFEST_SCHEMA = (
    "generated_at_utc string, status string, steps array<struct<name string, command array<string>, stdout string, "
    "stderr string, artifacts array<string>>>"
)
ARTIFACT = "path string, exists boolean, bytes bigint"

# Which step of a run leaves which report.
REPORTS = {
    "prompt_eval": ("evaluate_prompts", "prompt_evaluation.json"),
    "bias_report": ("bias_detection", "sample_bias_report.json"),
    "model_summary": ("train_sentiment_baseline", "sentiment_model_summary.json"),
}

UNKNOWN = "unknown"


def artifact_rows(manifests: DataFrame, *run_cols: str) -> DataFrame:
    """One row per artifact of nested manifests.

    Steps without artifacts and runs without steps are kept, with nulls. Of a
    plain path, neither existence nor size is known.
    """
    steps = manifests.select(*run_cols, F.posexplode_outer("steps").alias("step_no", "step"))
    rows = steps.select(
        *run_cols, "step_no", F.col("step.name").alias("step"), F.posexplode_outer("step.artifacts").alias("artifact_no", "artifact")
    )
    text = F.col("artifact")
    parsed = F.when(F.startswith(F.ltrim(text), F.lit("{")), F.from_json(text, ARTIFACT)).when(
        text.isNotNull(), F.struct(text.alias("path"), F.lit(None).cast("boolean").alias("exists"), F.lit(None).cast("bigint").alias("bytes"))
    )
    return rows.withColumn("artifact", parsed).select(
        *run_cols, "step_no", "step", "artifact_no", "artifact.path", "artifact.exists", "artifact.bytes"
    )


def step_summary(artifacts: DataFrame, *run_cols: str) -> DataFrame:
    """Artifacts, artifacts recorded as missing, and bytes per run and step.

    A step is its place in the run, as names may repeat.
    """
    present = F.col("path").isNotNull()
    return artifacts.groupBy(*run_cols, "step_no", "step").agg(
        F.count_if(present).alias("artifacts"),
        F.count_if(present & ~F.coalesce("exists", F.lit(True))).alias("missing"),
        F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"),
    )


def run_summary(artifacts: DataFrame, *run_cols: str) -> DataFrame:
    """Steps, artifacts and missing artifacts per run, from the step sums."""
    return (
        step_summary(artifacts, *run_cols)
        .groupBy(*run_cols)
        .agg(
            F.count("step_no").alias("steps"),
            F.sum("artifacts").alias("artifacts"),
            F.sum("missing").alias("missing"),
            F.sum("bytes").alias("bytes"),
        )
    )


def missing_artifacts(artifacts: DataFrame) -> DataFrame:
    return artifacts.where(F.col("path").isNotNull() & ~F.coalesce("exists", F.lit(True)))


def uri(path: Column, root: str | None = None) -> Column:
    """A path in one absolute form: ``file:/...`` or another scheme.

    A relative path is taken below ``root``; without a root it stays as it is.
    """
    below = path if root is None else F.concat(F.lit(root.rstrip("/") + "/"), path)
    placed = F.when(path.rlike("^([A-Za-z][A-Za-z0-9+.-]*:|/)"), path).otherwise(below)
    named = F.when(F.startswith(placed, F.lit("/")), F.concat(F.lit("file:"), placed)).otherwise(placed)
    return F.regexp_replace(named, "^file:/+", "file:/")


def report_paths(
    artifacts: DataFrame,
    run_col: str,
    base_dir_col: str,
    reports: Mapping[str, tuple[str, str]] = REPORTS,
    root: str | None = None,
) -> DataFrame:
    """(run, report, path): the step's artifact with the suffix, else the file
    of that name in the run's own folder.

    All reports of a run are found in one row, which alone is shuffled. The
    first step of the name counts, and its first matching artifact. Paths
    are absolute, in the form the readers give; relative artifacts lie below
    ``root``.
    """
    aggregates, rows = [F.min(base_dir_col).alias("base_dir")], []
    for k, (report, (step, suffix)) in enumerate(reports.items()):
        named = F.col("step") == step
        matches = named & F.endswith("path", F.lit(suffix))
        aggregates.append(F.min(F.when(matches, F.struct("step_no", "artifact_no", "path"))).alias(f"found_{k}"))
        aggregates.append(F.min(F.when(named, F.col("step_no"))).alias(f"first_{k}"))
        found = F.when(F.col(f"found_{k}.step_no") == F.col(f"first_{k}"), F.col(f"found_{k}.path"))
        rows.append(F.struct(F.lit(report).alias("report"), F.coalesce(found, F.concat_ws("/", "base_dir", F.lit(suffix))).alias("path")))
    per_run = artifacts.select(run_col, base_dir_col, "step_no", "step", "artifact_no", "path").groupBy(run_col).agg(*aggregates)
    return per_run.select(run_col, F.inline(F.array(*rows))).select(run_col, "report", uri(F.col("path"), root).alias("path"))


def attach_reports(paths: DataFrame, reports: DataFrame, path_col: str = "path") -> DataFrame:
    """Each wanted report with its content, null when no such file exists."""
    return paths.join(reports, path_col, "left")


def model_card_facts(summaries: DataFrame) -> DataFrame:
    """What a model card states about each training run, with stand-ins for gaps."""

    def known(column: str) -> Column:
        return F.coalesce(F.col(column).cast("string"), F.lit(UNKNOWN))

    def count_of(column: str) -> Column:
        return F.coalesce(F.col(column).cast("long"), F.lit(0).cast("long"))

    return summaries.select(
        known("run_id").alias("run_id"),
        known("timestamp_utc").alias("created"),
        known("artifacts.model_path").alias("model_path"),
        known("data_path").alias("data_path"),
        known("data_sha256").alias("data_sha256"),
        known("rows").alias("rows"),
        F.coalesce(F.to_json("class_dist"), F.lit("{}")).alias("class_dist"),
        count_of("splits.train").alias("train_rows"),
        count_of("splits.val").alias("val_rows"),
        count_of("splits.test").alias("test_rows"),
        F.col("test.roc_auc").alias("test_roc_auc"),
        F.to_json("test.confusion_matrix").alias("confusion_matrix"),
    )
