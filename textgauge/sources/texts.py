"""Text, topic and labelled-text files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from textgauge.sources import ranges

CSV_OPTIONS = {"header": True, "quote": '"', "escape": '"', "multiLine": True, "encoding": "UTF-8"}

# How one record is read whose lines are together already.
TEXT_OPTIONS = {"quote": '"', "escape": '"', "multiLine": "true"}


def read_csv(spark: SparkSession, path: str, schema: str | None = None, ranged: bool | None = None) -> DataFrame:
    """A CSV table with a header, all strings unless a schema is given.

    Quoted texts may span lines. Spark gives such a file to one task; files
    larger than a task's share (or all, if ``ranged``) are read in ranges.
    """
    reader = spark.read.options(**CSV_OPTIONS)
    plain = reader.schema(schema).csv(path) if schema else reader.csv(path)
    if not (ranges.has_large_files(spark, path) if ranged is None else ranged):
        return plain
    # the first record of a file is its header; empty lines are no records
    found = ranges.records(spark, path, ranges.CSV).where("number > 0")
    record = found.select(F.col("text").alias("record")).where("record <> ''")
    # a struct of one field would be null as a whole
    wanted = StructType([*plain.schema.fields, StructField("_none", StringType())])
    ddl = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in wanted.fields)
    parsed = record.select(F.from_csv("record", ddl, TEXT_OPTIONS).alias("_row"))
    return parsed.select("_row.*").drop("_none")


def read_csv_texts(
    spark: SparkSession,
    path: str,
    text_col: str = "text",
    id_col: str | None = None,
    group_col: str | None = None,
    schema: str | None = None,
    ranged: bool | None = None,
) -> DataFrame:
    """A CSV table of free texts; an absent id or group column is left out."""
    return select_texts(read_csv(spark, path, schema, ranged), text_col, id_col, group_col)


def select_texts(
    df: DataFrame, text_col: str = "text", id_col: str | None = None, group_col: str | None = None
) -> DataFrame:
    """The text column as string with the id and group columns that exist."""
    if text_col not in df.columns:
        raise ValueError(f"no column {text_col!r} to read texts from")
    extra = [c for c in dict.fromkeys([id_col, group_col]) if c and c in df.columns and c != text_col]
    return df.select(*extra, F.col(text_col).cast("string").alias(text_col))


def read_topics(spark: SparkSession, path: str, ranged: bool | None = None) -> DataFrame:
    """A CSV of topics, header names and values trimmed, empty cells kept as ''."""
    return trim_topics(read_csv(spark, path, ranged=ranged))


def trim_topics(df: DataFrame) -> DataFrame:
    return df.select([F.trim(F.coalesce(F.col(f"`{c}`"), F.lit(""))).alias(c.strip()) for c in df.columns])


def read_column_json(spark: SparkSession, path: str, ranged: bool | None = None) -> DataFrame:
    """Labelled texts kept as two parallel arrays, one object per file.

    Files larger than a task's share (or all, if ``ranged``) are read in ranges,
    and the arrays' items are paired by their place; no row holds a file.
    """
    if not (ranges.has_large_files(spark, path) if ranged is None else ranged):
        return pair_columns(spark.read.option("multiLine", True).json(path))
    return pair_items(column_items(spark, path))


# The beginning of an object's member that is a list.
MEMBER = r'^\s*\{?\s*"((?:[^"\\]|\\.)*)"\s*:\s*\['


def column_items(spark: SparkSession, path: str) -> DataFrame:
    """(file, column, place, item) of the lists in each file's object, items as JSON."""
    found = ranges.records(spark, path, ranges.JSON_COLUMNS)
    # one small row a member of the object
    bounds = found.groupBy("file", "member").agg(
        F.min("number").alias("first"), F.max("number").alias("final"), F.min_by("text", "number").alias("head")
    )
    named = bounds.select("file", "member", "first", "final", F.regexp_extract("head", MEMBER, 1).alias("column")).where("column IN ('text', 'label')")
    place = F.col("number") - F.col("first")
    opened = F.when(place == 0, F.regexp_replace("text", MEMBER, "")).otherwise(F.col("text"))
    closed = F.when(F.col("number") == F.col("final"), F.regexp_replace(opened, r"\]\s*(\}\s*)?\z", "")).otherwise(opened)
    items = found.join(F.broadcast(named), ["file", "member"]).select("file", "column", place.alias("place"), F.trim(closed, F.lit(" \t\r\n")).alias("item"))
    return items.where("item <> ''")


def pair_items(items: DataFrame) -> DataFrame:
    """Texts and labels with the same place in their lists; an item without its counterpart is an error."""
    texts, labels = (items.where(F.col("column") == c).select("file", "place", F.col("item").alias(c)) for c in ("text", "label"))
    both = texts.join(labels, ["file", "place"], "full")
    lone = F.raise_error(F.lit("text and label differ in length")).cast("string")
    text = F.when(F.col("text").isNull() | F.col("label").isNull(), lone).otherwise(F.try_variant_get(F.parse_json("text"), "$", "string"))
    return both.select(text.alias("text"), F.try_variant_get(F.parse_json("label"), "$", "bigint").alias("label"))


def pair_columns(df: DataFrame) -> DataFrame:
    """Two parallel arrays to rows; arrays of different length are an error."""
    if not {"text", "label"} <= set(df.columns):
        raise ValueError("a column file has a list of texts and a list of labels")
    same = F.size("text") == F.size("label")
    paired = F.when(same, F.arrays_zip("text", "label")).otherwise(
        F.raise_error(F.lit("text and label differ in length"))
    )
    return df.select(F.inline(paired))


JSONL_SCHEMA = "text STRING, prompt STRING, label STRING, _broken STRING"


def read_jsonl_texts(spark: SparkSession, path: str) -> DataFrame:
    """Labelled texts, one JSON object per line; ``prompt`` stands in for ``text`` where a row has none.

    The schema is given, so files are read once. A line that is no JSON object
    and a label that is no number are errors.
    """
    df = spark.read.schema(JSONL_SCHEMA).option("columnNameOfCorruptRecord", "_broken").json(path)
    broken = F.raise_error(F.concat(F.lit("not a JSON object: "), F.substring("_broken", 1, 200))).cast("string")
    text = F.when(F.col("_broken").isNotNull(), broken).otherwise(F.coalesce("text", "prompt"))
    return df.select(text.alias("text"), F.col("label").cast("double").cast("long").alias("label"))
