"""Benchmark decontamination by winnowing, with SQL functions only.

Method: hash every k-gram of words, keep the smallest hash of each window of w
consecutive k-grams, join the kept fingerprints of documents and benchmark
items, and extend each hit. Any shared span of k + w - 1 = 10 words has a whole
window of k-grams in common and so a common fingerprint at the same place;
looking at the 5 words before and 9 after a hit therefore finds every window
of 10 words. Items of fewer words are one window each: for each such length L
(at most 9 of them) all L-grams are fingerprints (w = 1).

Words are compared by their 64-bit hash. A fingerprint row carries the hashes
around it, never the text; document rows are not shuffled before the join if
the benchmark's fingerprints were counted to be few (``BROADCAST_ROWS``), and
are joined by shuffle otherwise. Only hits are then grouped by document.

Defined results: null and empty texts have no words and no hits. Repeated
document rows give repeated result rows. Items without words are ignored; a
null item id is left out of the list of ids.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textgauge.llm.common import ascii_lower, row_key
from textgauge.session import fits, once

SPAN = 10
K = 5
#: A fingerprint row takes about 200 bytes: at most 20 MB are broadcast.
BROADCAST_ROWS = 100_000
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Runs of ASCII letters, digits and anything beyond ASCII; A-Z lower-cased."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), SEPARATORS), "")


def word_hashes(df: DataFrame, text_col: str) -> DataFrame:
    """Append ``_h``, the hashes of a text's words."""
    return once(df, _h=F.transform(words(F.col(text_col)), lambda w: F.xxhash64(w)))


def _indexes(size: Column) -> Column:
    """0 .. size - 1, or nothing."""
    return F.when(size > 0, F.sequence(F.lit(0), size - 1)).otherwise(F.array().cast("array<int>"))


def fingerprints(df: DataFrame, span: int, k: int, out: str) -> DataFrame:
    """Append ``out``: array of (span, pos, fp, before, around) of the kept k-grams.

    ``around`` holds the word hashes of every window of ``span`` words that
    contains the k-gram; ``before`` of them stand before it.
    """
    w = span - k + 1
    grams = F.transform(_indexes(F.size("_h") - (k - 1)), lambda i: F.xxhash64(F.lit(span), *[F.get("_h", i + j) for j in range(k)]))
    df = once(df, _g=F.when(F.size("_h") >= span, grams).otherwise(F.array().cast("array<bigint>")))
    kept = _indexes(F.size("_g"))
    if w > 1:
        df = once(df, _m=F.transform(_indexes(F.size("_g") - (w - 1)), lambda i: F.array_min(F.slice("_g", i + 1, w))))
        kept = F.filter(kept, lambda p: F.array_contains(F.slice("_m", F.greatest(p - (w - 2), F.lit(1)), F.least(p + 1, F.lit(w))), F.get("_g", p)))

    def entry(p: Column) -> Column:
        before = F.least(p, F.lit(w - 1))
        return F.struct(
            F.lit(span).alias("span"),
            p.alias("pos"),
            F.get("_g", p).alias("fp"),
            before.alias("before"),
            F.slice("_h", p - before + 1, before + span).alias("around"),
        )

    return once(df, **{out: F.transform(kept, entry)}).drop("_g", "_m")


def _entries(df: DataFrame, spans: list[int], k: int) -> tuple[DataFrame, Column]:
    names = []
    for span in spans:
        df = fingerprints(df, span, k if span == SPAN else span, f"_e{span}")
        names.append(f"_e{span}")
    return df, F.concat(*names)


def contaminated_words(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """One row per document: id, n_words, windows (start, span), items (ids as text), n_hit."""
    item_words = word_hashes(items.select(F.col(item_col).cast("string").alias("item"), F.col(item_text_col).alias("_t")), "_t")
    lengths = item_words.select(F.least(F.size("_h"), F.lit(SPAN)).alias("n")).where("n > 0").distinct()
    spans = sorted(r[0] for r in lengths.collect())  # at most SPAN numbers
    rows = docs.select(F.col(id_col).alias("id"), row_key(id_col, text_col).alias("rk"), F.col(text_col).alias("_t"))
    rows = word_hashes(rows, "_t").drop("_t")
    entry = "struct<span:int,pos:int,fp:bigint,before:int,around:array<bigint>>"
    nothing = F.array().cast(f"array<{entry}>")
    rows, found = _entries(rows, spans, K) if spans else (rows, nothing)
    # one further entry per document, so that rows without hits stay; its key is spread
    none = F.array(F.struct(F.lit(0), F.lit(-1), F.col("rk"), F.lit(0), F.array().cast("array<bigint>")).cast(entry))
    exploded = rows.select("id", "rk", F.size("_h").cast("long").alias("n_words"), F.explode(F.concat(none, found)).alias("d"))
    exploded = exploded.select("id", "rk", "n_words", "d.*")
    # an item shorter than the span is one window: its own length only
    sides = []
    for span in spans:
        of_span = item_words.where(F.size("_h") >= SPAN) if span == SPAN else item_words.where(F.size("_h") == span)
        made, entries = _entries(of_span, [span], K)
        sides.append(made.select("item", F.explode(entries).alias("i")).select("item", F.col("i.fp").alias("fp"), F.col("i.before").alias("i_before"), F.col("i.around").alias("i_around")))
    if sides:
        bench = sides[0]
        for side in sides[1:]:
            bench = bench.unionByName(side)
        bench = bench.distinct()
        exploded = exploded.join(F.broadcast(bench) if fits(bench, BROADCAST_ROWS) else bench, "fp", "left")
    else:
        exploded = exploded.select("*", F.lit(None).cast("string").alias("item"), F.lit(0).alias("i_before"), F.col("around").alias("i_around"))
    hits = exploded.where((F.col("pos") < 0) | F.col("i_around").isNotNull())

    def same(j: Column) -> Column:
        mine = F.slice("around", F.col("before") - j + 1, F.col("span"))
        its = F.slice("i_around", F.col("i_before") - j + 1, F.col("span"))
        return (F.size(mine) == F.col("span")) & (mine == its)

    shifts = F.filter(F.sequence(F.lit(0), F.least("before", "i_before")), same)
    starts = F.when(F.col("pos") >= 0, F.transform(shifts, lambda j: F.struct((F.col("pos") - j).alias("start"), F.col("span").alias("span"))))
    hits = once(hits, _starts=starts).where((F.col("pos") < 0) | (F.size("_starts") > 0))
    grouped = hits.groupBy("rk", "id").agg(
        F.count(F.when(F.col("pos") < 0, 1)).alias("_copies"),
        F.max("n_words").alias("n_words"),
        F.array_distinct(F.flatten(F.collect_set("_starts"))).alias("windows"),
        F.array_sort(F.collect_set(F.when(F.col("pos") >= 0, F.col("item")))).alias("items"),
    )
    covered = F.flatten(F.transform("windows", lambda s: F.sequence(s["start"], s["start"] + s["span"] - 1)))
    return once(grouped, n_hit=F.size(F.array_distinct(covered)).cast("long")).select(
        "id", "n_words", "windows", "items", "n_hit", F.explode(F.expr("array_repeat(0, int(_copies))")).alias("_copy")
    ).drop("_copy")
