"""Prompt templates compiled to ``concat`` expressions."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from string import Formatter

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the placeholder syntax.
PLACEHOLDER = r"\{([a-zA-Z0-9_]+)\}"

# What an absent optional field is filled with.
FIELD_DEFAULTS = {
    "style": "concise",
    "audience": "general reader",
    "length": "short",
    "domain": "general",
    "constraint": "none",
    "examples": "",
    "goal": "",
}


def placeholders(template: Column) -> Column:
    """Distinct placeholder names of a template held in a column."""
    return F.array_distinct(F.regexp_extract_all(template, F.lit(PLACEHOLDER), F.lit(1)))


def parse(template: str) -> list[tuple[str, str | None]]:
    """Split a template into (literal, field) pairs; doubled braces are literals."""
    pieces = []
    for literal, field, spec, conversion in Formatter().parse(template):
        if field is not None and (spec or conversion or not field.replace("_", "").isalnum()):
            raise ValueError(f"only plain {{name}} placeholders are supported: {template!r}")
        pieces.append((literal, field))
    return pieces


def fields_of(template: str) -> set[str]:
    return {field for _, field in parse(template) if field is not None}


def render(template: str, value_of: Callable[[str], Column]) -> Column:
    """Fill one template. Values are never scanned for placeholders again."""
    pieces: list[Column] = []
    for literal, field in parse(template):
        if literal:
            pieces.append(F.lit(literal))
        if field is not None:
            pieces.append(value_of(field))
    return F.concat(*pieces) if pieces else F.lit("")


def field_lookup(columns: Mapping[str, Column]) -> Callable[[str], Column]:
    """Row values over defaults; a field known to neither becomes empty text.

    A default steps in for an absent or null value only: a present empty string
    is kept.
    """

    def value_of(field: str) -> Column:
        default = F.lit(FIELD_DEFAULTS.get(field, ""))
        if field not in columns:
            return default
        return F.coalesce(columns[field].cast("string"), default)

    return value_of
