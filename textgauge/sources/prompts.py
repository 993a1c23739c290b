"""Prompt batches: mixed JSON arrays of strings and objects."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textgauge.sources import ranges
from textgauge.sources.configs import read_documents

FIELDS = ("topic", "style", "audience", "level", "source_template")


def parse_prompt_batches(df: DataFrame, column: str = "document", *kept: str) -> DataFrame:
    """One row per item of each JSON array, in order.

    A string is a prompt; an object must have a string ``prompt`` and may carry
    the known fields. Anything else is an error.
    """
    parsed = df.select(*kept, F.parse_json(column).alias("batch"))
    is_array = F.startswith(F.schema_of_variant("batch"), F.lit("ARRAY"))
    checked = parsed.select(
        *kept,
        F.when(is_array, F.col("batch"))
        .otherwise(F.raise_error(F.lit("a prompt batch is a list")).cast("variant"))
        .alias("batch"),
    )
    items = checked.lateralJoin(
        df.sparkSession.tvf.variant_explode(F.col("batch").outer()).select(F.col("pos"), F.col("value").alias("item"))
    )
    return parsed_items(items, *kept)


def parsed_items(items: DataFrame, *kept: str) -> DataFrame:
    """Prompts of (pos, item as variant)."""
    kind = F.schema_of_variant("item")
    inner = F.variant_get("item", "$.prompt", "variant")
    is_object = F.startswith(kind, F.lit("OBJECT")) & (F.schema_of_variant(inner) == "STRING")
    prompt = (
        F.when(kind == "STRING", F.try_variant_get("item", "$", "string"))
        .when(is_object, F.try_variant_get("item", "$.prompt", "string"))
        .otherwise(F.raise_error(F.lit("a prompt is a text or has one under prompt")))
    )
    extra = [
        F.when(F.startswith(kind, F.lit("OBJECT")), F.try_variant_get("item", f"$.{f}", "string")).alias(f)
        for f in FIELDS
    ]
    return items.select(*kept, "pos", prompt.alias("prompt"), *extra)


def read_prompts(spark: SparkSession, path: str, ranged: bool | None = None) -> DataFrame:
    """Batches from files; those larger than a task's share (or all, if ``ranged``) are read in ranges."""
    if not (ranges.has_large_files(spark, path) if ranged is None else ranged):
        return parse_prompt_batches(read_documents(spark, path))
    found = ranges.records(spark, path, ranges.JSON_ARRAY)
    text = F.trim("text", F.lit(" \t\r\n"))
    first, last = F.col("number") == 0, F.col("last")
    no_list = (first & ~F.startswith(text, F.lit("["))) | (last & ~F.endswith(text, F.lit("]")))
    inner = F.substr(text, F.when(first, 2).otherwise(1), F.length(text) - F.when(first, 1).otherwise(0) - F.when(last, 1).otherwise(0))
    checked = F.when(no_list, F.raise_error(F.lit("a prompt batch is a list")).cast("string")).otherwise(F.trim(inner, F.lit(" \t\r\n")))
    items = found.select(F.col("number").cast("int").alias("pos"), checked.alias("item")).where("item <> ''")
    return parsed_items(items.select("pos", F.parse_json("item").alias("item")))


def read_prompts_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """Prompts, one object per line; the schema is given, so files are read once."""
    return spark.read.schema(", ".join(f"{c} STRING" for c in ("prompt", *FIELDS))).json(path)
