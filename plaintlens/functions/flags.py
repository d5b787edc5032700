"""Eras, buckets and day arithmetic."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Era:
    """Half-open period [start, end) in which a source field was collected."""

    name: str
    start: str | None = None
    end: str | None = None


def as_date(value: str | dt.date) -> Column:
    return F.lit(dt.date.fromisoformat(value) if isinstance(value, str) else value)


def era_flag(c: Column, era: Era) -> Column:
    """Whether a date lies in the era; a NULL date gives NULL, not false."""
    bounds = []
    if era.start is not None:
        bounds.append(c >= as_date(era.start))
    if era.end is not None:
        bounds.append(c < as_date(era.end))
    return reduce(lambda a, b: a & b, bounds)


def in_full_years(c: Column, lo: int, hi: int) -> Column:
    return F.year(c).between(lo, hi)


def days_between_clamped(start: Column, end: Column) -> Column:
    """Days from start to end, negatives as 0; NULL stays NULL (Spark's greatest would skip it)."""
    days = F.datediff(end, start)
    return F.when(days.isNotNull(), F.greatest(days, F.lit(0)))


_COMPARE = {
    "<=": lambda c, v: c <= v,
    "<": lambda c, v: c < v,
    ">=": lambda c, v: c >= v,
    ">": lambda c, v: c > v,
}


def bucketize(c: Column, cuts: Sequence, labels: Sequence[str], op: str = "<=") -> Column:
    """Label of the first cut for which `c op cut` holds; the last label takes the rest and NULL."""
    if len(labels) != len(cuts) + 1:
        raise ValueError("need one label more than cuts")
    test = _COMPARE[op]
    out = F.when(test(c, F.lit(cuts[0])), labels[0])
    for cut, label in zip(cuts[1:], labels[1:-1]):
        out = out.when(test(c, F.lit(cut)), label)
    return out.otherwise(labels[-1])


def bucket_rank(c: Column, labels: Sequence[str]) -> Column:
    """Ordinal of a label, counted from 1 in the given order; unknown labels give NULL."""
    out = F.when(c == labels[0], 1)
    for i, label in enumerate(labels[1:], start=2):
        out = out.when(c == label, i)
    return out


def week_of_year_sunday(c: Column) -> Column:
    """Week number 0-53 with weeks starting on Sunday (Spark's weekofyear is ISO)."""
    return F.floor((F.dayofyear(c) + 7 - F.dayofweek(c)) / 7).cast("int")
