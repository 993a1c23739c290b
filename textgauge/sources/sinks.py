"""Writers. All of them write a folder of part files, one per task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_prompts(df: DataFrame, path: str, with_metadata: bool = True, mode: str = "errorifexists") -> None:
    """Prompt records as JSONL; without metadata each line holds the prompt alone."""
    fields = [c for c in df.columns if c in PROMPT_FIELDS] if with_metadata else ["prompt"]
    df.select(*fields).write.mode(mode).json(path)


# The fields of a prompt record, in their order.
PROMPT_FIELDS = ("topic", "prompt", "style", "audience", "level", "source_template")


def write_details(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "errorifexists") -> None:
    """Rows with their nested hits and category sums."""
    df.write.mode(mode).format(fmt).save(path)


def write_flagged_csv(
    scored: DataFrame, path: str, id_col: str, text_col: str = "text", mode: str = "errorifexists"
) -> None:
    """The flagged rows as CSV, category sums as JSON text."""
    flagged = scored.where("flagged").select(
        F.col(id_col).alias("id"), "score", F.to_json("per_category").alias("per_category"),
        F.col(text_col).alias("text"),
    )
    flagged.write.mode(mode).options(header=True, quote='"', escape='"').csv(path)


def write_scored_prompts(scored: DataFrame, path: str, mode: str = "errorifexists", compression: str | None = None) -> None:
    """Scored prompts as JSONL, rubric and advice nested; ``compression`` is a codec Spark knows, such as gzip."""
    scored.write.mode(mode).json(path, compression=compression)


def append_run(summary: DataFrame, path: str) -> None:
    """Add the one-row summary of a run to the run table."""
    summary.write.mode("append").parquet(path)
