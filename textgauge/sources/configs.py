"""Lexicons, word lists and templates.

The parsers work on a column of JSON documents, so the same code reads one
configuration file or a table of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textgauge.operators.lexicon import DEFAULT_CATEGORY, DEFAULT_WEIGHT

# Weights are read as text, so that a number in quotes counts and other text is
# an error instead of a missing weight.
SPEC = "struct<category:string,weight:string>"
LISTED = "struct<terms:array<struct<pattern:string,term:string,category:string,weight:string>>>"


def read_documents(spark: SparkSession, path: str, column: str = "document") -> DataFrame:
    """Each file as one row; for configuration files, which are small."""
    return spark.read.text(path, wholetext=True).select(F.col("value").alias(column))


def parse_lexicons(df: DataFrame, column: str = "document", *kept: str) -> DataFrame:
    """(term, category, weight, pos) from either lexicon shape.

    ``{"terms": [...]}`` lists entries whose term may be called pattern; the
    shorthand maps terms to their category and weight. Entries without a term
    are skipped.
    """
    in_list = F.from_json(column, LISTED).getField("terms")
    mapped = F.map_entries(F.from_json(column, f"map<string,{SPEC}>"))
    is_listed = F.get_json_object(column, "$.terms[0]").isNotNull() | (
        F.get_json_object(column, "$.terms") == "[]"
    )
    from_list = F.transform(
        in_list,
        lambda e, i: F.struct(
            F.coalesce(F.nullif(e.pattern, F.lit("")), e.term).alias("term"), e.category, e.weight, i.alias("pos")
        ),
    )
    from_map = F.transform(
        F.filter(mapped, lambda e: e.value.isNotNull()),
        lambda e, i: F.struct(e.key.alias("term"), e.value.category, e.value.weight, i.alias("pos")),
    )
    entries = (
        F.when(is_listed, from_list)
        .when(mapped.isNotNull(), from_map)
        .otherwise(F.raise_error(F.lit("a lexicon is a list of terms or a map of them")))
    )
    return (
        df.select(*kept, F.inline(entries).alias("term", "category", "weight", "pos"))
        .where("term <> ''")
        .select(
            *kept,
            "term",
            F.coalesce("category", F.lit(DEFAULT_CATEGORY)).alias("category"),
            number(F.col("weight")).alias("weight"),
            "pos",
        )
    )


def number(text: Column) -> Column:
    """A weight given as text; absent means the default, anything else must be a number."""
    value = text.try_cast("double")
    bad = F.raise_error(F.concat(F.lit("not a weight: "), text)).cast("double")
    return F.when(text.isNull(), F.lit(DEFAULT_WEIGHT)).otherwise(F.coalesce(value, bad))


def read_lexicon(spark: SparkSession, path: str) -> DataFrame:
    return parse_lexicons(read_documents(spark, path))


def clean_terms(lines: DataFrame, column: str = "value") -> DataFrame:
    """Trimmed, non-blank lines."""
    return lines.withColumn(column, F.trim(F.col(column))).where(F.col(column) != "")


def read_terms(spark: SparkSession, path: str | None) -> DataFrame:
    """(value, pos): an allowlist or denylist, one term per line; none when there is no file.

    ``pos`` grows with the place in the file, as an allowlist is applied in order.
    """
    if not path or not path_exists(spark, path):
        return spark.range(0).select(F.lit("").alias("value"), F.col("id").alias("pos"))
    return clean_terms(spark.read.text(path).withColumn("pos", F.monotonically_increasing_id()))


def listed(df: DataFrame, column: str, order_col: str | None = "pos") -> list[str]:
    """A configuration table as a list, in its order.

    The lists go into an expression, so they are held by the driver whole; that
    is for configuration, whatever its length.
    """
    ordered = df.orderBy(order_col) if order_col else df
    return [r[0] for r in ordered.select(column).collect()]


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def parse_templates(df: DataFrame, column: str = "document", *kept: str) -> DataFrame:
    """(tmpl_i, tmpl) from a bare list or ``{"templates": [...]}``.

    A blank or missing template, or another shape, is an error.
    """
    bare = F.from_json(column, "array<string>")
    wrapped = F.from_json(column, "struct<templates:array<string>>").getField("templates")
    found = F.when(F.startswith(F.ltrim(F.col(column)), F.lit("[")), bare).otherwise(wrapped)
    good = found.isNotNull() & F.forall(found, lambda t: t.isNotNull() & (F.trim(t) != ""))
    checked = F.when(good, found).otherwise(
        F.raise_error(F.lit("expected a list of templates, none of them blank"))
    )
    return df.select(*kept, F.posexplode(checked).alias("tmpl_i", "tmpl"))


def read_templates(spark: SparkSession, path: str) -> DataFrame:
    return parse_templates(read_documents(spark, path))
