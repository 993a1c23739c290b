"""Ratios that are safe under ANSI arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rate(part: Column, whole: Column, digits: int | None = None) -> Column:
    """``part / max(1, whole)``, rounded on request."""
    value = part.cast("double") / F.greatest(whole, F.lit(1)).cast("double")
    return value if digits is None else F.round(value, digits)


def ratio_or_zero(numerator: Column, denominator: Column) -> Column:
    """A ratio that is 0 when its denominator is 0."""
    return F.coalesce(F.try_divide(numerator.cast("double"), denominator.cast("double")), F.lit(0.0))


def clip(value: Column, low: float, high: float) -> Column:
    return F.least(F.greatest(value, F.lit(low)), F.lit(high))
