"""Line deduplication over a whole corpus, with SQL functions only.

Method: explode the normalised lines, hash them, count the distinct documents
of each hash, drop lines over the threshold and put the others together again
by position.

Only (hash, document) pairs are shuffled to be counted, first by both and then
by the hash with partial sums; lines that hold a thousandth of all rows are then
joined by broadcast, so a line that every document holds never gathers in one
task. A document meets the list of its dropped positions by row key;
texts without dropped lines are passed on as they are.

Defined results: a null or empty text is one empty line, kept. Documents are
told apart by id; rows of one id count once, and the null id is a document of
its own that comes before all others. Repeated rows get equal results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textgauge.llm.common import ascii_lower, join_hot, packed, row_key, saved, unpacked
from textgauge.session import once

BLANKS = " \t\n\x0b\f\r"
MIN_CHARS = 20
MIN_DOCUMENTS = 3


def line_key(line: Column) -> Column:
    """The part of a (lower-cased) line that is compared."""
    return F.btrim(line, F.lit(BLANKS))


def _keyed_lines(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """(id, rk, pos, h1, h2) of the lines long enough to be compared.

    Two hashes of different seeds make 128 bits, so different lines do not meet.
    """
    lines = F.split(ascii_lower(F.coalesce(F.col(text_col), F.lit(""))), "\n")
    found = docs.select(F.col(id_col).alias("id"), row_key(id_col, text_col).alias("rk"), F.posexplode(lines).alias("pos", "line"))
    keyed = found.select("id", "rk", "pos", line_key(F.col("line")).alias("key"))
    return keyed.where(F.length("key") >= min_chars).select(
        "id", "rk", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), F.col("key")).alias("h2")
    )


def repeated_lines(lines: DataFrame, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """(h1, h2, n_documents, keeper) of keyed lines found in enough documents."""
    counted = lines.groupBy("h1", "h2", "id").agg(F.lit(1).alias("one")).groupBy("h1", "h2")
    return counted.agg(F.count("one").alias("n_documents"), F.max("id").alias("keeper")).where(F.col("n_documents") >= min_documents)


def dedup_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, min_documents: int = MIN_DOCUMENTS
) -> DataFrame:
    """All rows and columns of ``docs``, plus n_lines, n_dropped and kept_text (in place of columns of these names)."""
    lines = saved(_keyed_lines(docs, id_col, text_col, min_chars))
    repeated = saved(repeated_lines(lines, min_documents))
    drops = (
        join_hot(lines, repeated, ["h1", "h2"], "n_documents", "inner")
        .where(~F.col("id").eqNullSafe(F.col("keeper")))
        .groupBy("rk")
        .agg(F.collect_set("pos").alias("drops"))
    )
    joined = packed(docs, rk=row_key(id_col, text_col), text=F.coalesce(F.col(text_col), F.lit(""))).join(drops, "rk", "left")
    split = once(joined, lines=F.split("text", "\n"))
    # array_except is linear and keeps the order of its first argument
    left = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("drops"))
    put = F.array_join(F.transform(left, lambda i: F.col("lines")[i]), "\n")
    return split.select(
        *unpacked(split, [c for c in docs.columns if c not in ("n_lines", "n_dropped", "kept_text")]),
        F.size("lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("drops"), F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("drops").isNull(), F.col("text")).otherwise(put).alias("kept_text"),
    )
