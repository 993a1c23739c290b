r"""Text matching expressions.

A word character is a letter, a digit-like character or ``_`` in any script.
The class is spelled out because the meaning of a bare ``\b`` differs between
regex engines and JDK versions.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from textgauge.functions.constants import array_of

WORD = r"[\p{L}\p{N}_]"
# In a look-behind, Java steps back by UTF-16 units unless the pattern allows for
# wider characters. The optional noncharacter does that and matches no real text.
BEHIND = rf"\x{{10FFFF}}?{WORD}"
BOUNDARY = rf"(?:(?<={BEHIND})(?!{WORD})|(?<!{BEHIND})(?={WORD}))"

# Width of the blocks in ``running_sum``; about the cube root of a million.
BLOCK = 128

# Characters per piece in ``chunks``.
CHUNK = 256


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind ``value`` to a name inside an expression so it is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words(low: Column, min_length: int = 1) -> Column:
    """All maximal runs of word characters, in order."""
    return F.regexp_extract_all(low, F.lit(f"{WORD}{{{min_length},}}"), F.lit(0))


def is_plain_word(key: str) -> bool:
    """True when a term is one run of word characters, so tokens can be compared."""
    return bool(re.fullmatch(r"\w+", key))


def quoted(key: str) -> str:
    """A regex that matches ``key`` literally."""
    return "\\Q" + key.replace("\\E", "\\E\\\\E\\Q") + "\\E"


def term_pattern(key: str) -> str:
    """The regex for one term: phrases match anywhere, words at word boundaries."""
    literal = quoted(key)
    if " " in key:
        return literal
    if is_plain_word(key):
        # The literal comes first so that the look-around runs on candidates only.
        return f"{literal}(?!{WORD})(?<!{BEHIND}{literal})"
    return f"{BOUNDARY}{literal}{BOUNDARY}"


def quoted_column(key: Column) -> Column:
    """``quoted`` for a term held in a column."""
    return F.concat(F.lit("\\Q"), F.replace(key, F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit("\\E"))


def term_pattern_column(key: Column) -> Column:
    """``term_pattern`` for a term held in a column."""
    literal = quoted_column(key)
    return F.when(F.contains(key, F.lit(" ")), literal).otherwise(
        F.concat(F.lit(BOUNDARY), literal, F.lit(BOUNDARY))
    )


def strip_terms(low: Column, terms: Sequence[str]) -> Column:
    """Replace each listed substring by one space, in list order."""
    if not terms:
        return low
    return F.aggregate(
        array_of(term.lower() for term in terms), low, lambda text, term: F.replace(text, term, F.lit(" "))
    )


def occurrence_count(low: Column, pattern: Column) -> Column:
    """Number of non-overlapping matches of a never-empty pattern."""
    return (F.size(F.split(low, pattern, -1)) - 1).cast("long")


def running_sum(values: Column) -> Column:
    """Inclusive running sum of an INT array.

    Two levels of blocks keep a text with a million hits near linear; folding an
    ever-growing array would copy it once per element.
    """
    zero = F.lit(0)

    def add(total: Column, value: Column) -> Column:
        return total + value

    def block_of(position: Column) -> Column:
        return F.floor(position / BLOCK).cast("int")

    def with_blocks(bases: Column) -> Column:
        return F.transform(
            values,
            lambda _, i: F.get(bases, block_of(i))
            + F.aggregate(F.slice(values, block_of(i) * BLOCK + 1, i % BLOCK + 1), zero, add),
        )

    def bases_of(sums: Column) -> Column:
        return F.transform(sums, lambda _, b: F.aggregate(F.slice(sums, F.lit(1), b), zero, add))

    last_block = block_of(F.greatest(F.size(values) - 1, F.lit(0)))
    sums = F.transform(
        F.sequence(F.lit(0), last_block),
        lambda b: F.aggregate(F.slice(values, b * BLOCK + 1, F.lit(BLOCK)), zero, add),
    )
    return let(sums, lambda s: let(bases_of(s), with_blocks))


def occurrence_starts(low: Column, pattern: Column, key: Column) -> Column:
    """Zero-based start offsets of every non-overlapping match, in order."""
    width = F.length(key)

    def starts(parts: Column) -> Column:
        steps = F.transform(F.slice(parts, F.lit(1), F.size(parts) - 1), lambda part: F.length(part) + width)
        return let(steps, lambda s: F.transform(running_sum(s), lambda end: end - width))

    return let(F.split(low, pattern, -1), starts)


def chunks(text: Column) -> Column:
    """A text as pieces of ``CHUNK`` characters.

    Cutting a piece out of a string walks from its start; with chunks, many
    contexts of a long text cost as little as those of a short one.
    """
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0))


def context(pieces: Column, length: Column, start: Column, end: Column, window: int) -> Column:
    """The text around a hit, clamped at both ends, from the chunks of the text."""
    left = F.greatest(start - window, F.lit(0))
    right = F.least(length, end + window)
    first = F.floor(left / CHUNK).cast("int")
    count = F.floor((right - 1) / CHUNK).cast("int") - first + 1
    near = F.array_join(F.slice(pieces, first + 1, F.greatest(count, F.lit(0))), "")
    return F.when(right > left, F.substr(near, left - first * CHUNK + 1, right - left)).otherwise("")


def term_frequencies(terms: Column) -> Column:
    """``array<struct<term, tf>>`` of one text, counted by run lengths.

    A text's terms are all in its row, so they need no shuffle by (row, term):
    after sorting, a term's count is the distance between two run starts.
    """

    def count(ordered: Column) -> Column:
        positions = F.sequence(F.lit(0), F.greatest(F.size(ordered) - 1, F.lit(0)))

        def starts_run(i: Column) -> Column:
            return (i == 0) | (F.get(ordered, i) != F.get(ordered, i - 1))

        def pairs(starts: Column) -> Column:
            return F.transform(
                starts,
                lambda s, k: F.struct(
                    F.get(ordered, s).alias("term"),
                    (F.coalesce(F.get(starts, k + 1), F.size(ordered)) - s).alias("tf"),
                ),
            )

        return F.when(F.size(ordered) > 0, let(F.filter(positions, starts_run), pairs)).otherwise(
            F.array().cast("array<struct<term:string,tf:int>>")
        )

    return let(F.sort_array(terms), count)


def contains_any(low: Column, needles: Sequence[str]) -> Column:
    """True when at least one literal substring occurs."""
    found = F.lit(False)
    for needle in needles:
        found = found | F.contains(low, F.lit(needle))
    return found
