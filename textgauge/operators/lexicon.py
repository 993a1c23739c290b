"""Weighted lexicons: built-in terms, overlays and category caps."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textgauge.functions.constants import rows_of
from textgauge.functions.text import is_plain_word, term_pattern

# The built-in terms with category and weight. Their order breaks
# ties between equally frequent terms.
BUILTIN_TERMS = (
    ("pregnant", "gender", 1.0),
    ("female", "gender", 0.5),
    ("male", "gender", 0.5),
    ("she", "gender", 0.25),
    ("he", "gender", 0.25),
    ("age 62", "age", 1.0),
    ("elderly", "age", 0.75),
    ("too young", "age", 0.75),
    ("religion", "religion", 0.75),
    ("christian", "religion", 1.0),
    ("muslim", "religion", 1.0),
    ("jewish", "religion", 1.0),
    ("hindu", "religion", 1.0),
    ("atheist", "religion", 0.5),
    ("race", "race", 0.75),
    ("ethnicity", "race", 0.75),
    ("disability", "disability", 1.0),
    ("pregnancy", "gender", 1.0),
    ("nationality", "nationality", 0.75),
)

# The most a category adds to a row's score.
CATEGORY_CAPS = {
    "gender": 3.0,
    "religion": 3.0,
    "age": 3.0,
    "race": 3.0,
    "disability": 3.0,
    "nationality": 3.0,
    "uncat": 2.0,
}

# What a lexicon entry without a category or weight gets.
DEFAULT_CATEGORY = "uncat"
DEFAULT_WEIGHT = 1.0

# How denylist hits are reported.
DENY_CATEGORY = "denylist"
DENY_WEIGHT = 1.0

FRAME_SCHEMA = "term string, category string, weight double, pos int"


@dataclass(frozen=True)
class Entry:
    term: str
    category: str
    weight: float
    pos: int
    key: str

    @property
    def plain(self) -> bool:
        return is_plain_word(self.key)


class Lexicon:
    """An ordered list of terms that is compiled into expressions.

    The terms travel inside the query, so its size and the work per text grow
    with them; lexicons of many thousands are better left as tables and joined,
    see ``matching.match_terms``.
    """

    def __init__(self, terms: Iterable[tuple[str, str, float]], case_sensitive: bool = False):
        merged: dict[str, tuple[str, float]] = {}
        for term, category, weight in terms:
            merged[term] = (category, float(weight))
        self.case_sensitive = case_sensitive
        # Texts are always lower-cased before matching. A case-sensitive term is
        # compared as written, so one with capitals never matches.
        self.entries = [
            Entry(term, category, weight, pos, term if case_sensitive else term.lower())
            for pos, (term, (category, weight)) in enumerate(merged.items())
        ]

    @classmethod
    def builtin(cls, case_sensitive: bool = False) -> Lexicon:
        return cls(BUILTIN_TERMS, case_sensitive)

    @classmethod
    def from_frame(cls, frame: DataFrame, case_sensitive: bool = False) -> Lexicon:
        """Read a lexicon table to the driver, in its order."""
        rows = frame.orderBy("pos", "term").collect()
        return cls([(r.term, r.category, r.weight) for r in rows], case_sensitive)

    def overlay(self, terms: Iterable[tuple[str, str, float]]) -> Lexicon:
        """Entries with a known term replace it in place; new ones are appended."""
        own = [(e.term, e.category, e.weight) for e in self.entries]
        return Lexicon([*own, *terms], self.case_sensitive)

    def frame(self, spark: SparkSession) -> DataFrame:
        """The entries as a table, made from constants without a Python worker."""
        if not self.entries:
            return spark.createDataFrame([], FRAME_SCHEMA)
        return spark.range(1, numPartitions=1).select(F.inline(self.literal())).select("term", "category", "weight", "pos")

    def plain_keys(self) -> list[str]:
        return sorted({e.key for e in self.entries if e.plain})

    def categories(self) -> list[str]:
        return sorted({e.category for e in self.entries})

    def literal(self, entries: Iterable[Entry] | None = None) -> Column:
        """The entries as one constant array of structs."""
        chosen = self.entries if entries is None else list(entries)
        rows = [(e.term, e.key, e.category, e.weight, e.pos, term_pattern(e.key)) for e in chosen]
        return rows_of(rows, "term", "key", "category", "weight", "pos", "pattern")


def overlay_frames(base: DataFrame, custom: DataFrame) -> DataFrame:
    """Overlay one lexicon table on another: full outer join on the term."""
    b, c = base.alias("b"), custom.alias("c")
    last = F.coalesce(F.max("pos"), F.lit(-1)) + 1
    joined = b.join(c, F.col("b.term") == F.col("c.term"), "full_outer")
    return joined.select(
        F.coalesce("b.term", "c.term").alias("term"),
        F.when(F.col("c.term").isNotNull(), F.col("c.category")).otherwise(F.col("b.category")).alias("category"),
        F.when(F.col("c.term").isNotNull(), F.col("c.weight")).otherwise(F.col("b.weight")).alias("weight"),
        F.coalesce(F.col("b.pos"), F.col("c.pos") + base.select(last).scalar()).cast("int").alias("pos"),
    )
