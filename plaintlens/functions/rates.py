"""Ratios and conditional counts whose undefined case is NULL, never 0."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(numerator: Column, denominator: Column, digits: int | None = None) -> Column:
    """numerator / denominator as double, NULL when the denominator is 0."""
    value = F.try_divide(numerator.cast("double"), denominator.cast("double"))
    return value if digits is None else F.round(value, digits)


def era_rate(hit: Column, in_era: Column, digits: int | None = None) -> Column:
    """Share of in-era rows that hit (aggregate); NULL when no row is in the era."""
    return ratio(F.count_if(hit & in_era), F.count_if(in_era), digits)


def era_count(hit: Column, in_era: Column) -> Column:
    """In-era hits (aggregate); NULL when no row is in the era."""
    return F.when(F.count_if(in_era) > 0, F.count_if(in_era & hit))


def percent(part: Column, whole: Column, digits: int) -> Column:
    return ratio(part.cast("double") * 100, whole, digits)
