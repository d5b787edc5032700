"""Data-quality checks. Each returns the violating rows; an empty result passes."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plaintlens.functions.flags import Era, as_date, era_flag
from plaintlens.functions.rates import percent


def _scope(df: DataFrame, where: Column | str | None) -> DataFrame:
    return df if where is None else df.where(where)


def not_null(df: DataFrame, col: str, where: Column | str | None = None) -> DataFrame:
    return _scope(df, where).where(F.col(col).isNull())


def unique(df: DataFrame, cols: Sequence[str], where: Column | str | None = None) -> DataFrame:
    """Key values that occur more than once. A single NULL key never counts; in a composite key it does."""
    rows = _scope(df, where)
    if len(cols) == 1:
        rows = rows.where(F.col(cols[0]).isNotNull())
    return rows.groupBy(*cols).agg(F.count("*").alias("n_rows")).where(F.col("n_rows") > 1)


def accepted(df: DataFrame, col: str, values: Sequence, where: Column | str | None = None) -> DataFrame:
    """Values outside the list, with counts; NULL passes."""
    bad = _scope(df, where).where(~F.col(col).isin(list(values)))
    return bad.groupBy(F.col(col).alias("value")).agg(F.count("*").alias("n_rows"))


def relationship(child: DataFrame, col: str, parent: DataFrame, parent_col: str) -> DataFrame:
    """Non-null child keys without a parent, with the number of child rows each.

    Child rows are counted per key first, so a hot key reaches the join as one row.
    """
    keys = child.where(F.col(col).isNotNull()).groupBy(col).agg(F.count("*").alias("n_rows"))
    return keys.join(parent.select(F.col(parent_col).alias(col)), col, "left_anti")


def ordered(df: DataFrame, first: str, second: str, after: str | None = None) -> DataFrame:
    """Rows whose second date precedes the first; with `after`, only first dates later than it."""
    bad = df.where(F.col(second) < F.col(first))
    return bad if after is None else bad.where(F.col(first) > as_date(after))


def coverage(df: DataFrame, flag: str, floor_pct: float) -> DataFrame:
    """The share of flagged rows in percent, if below the floor (rounded to 0.1 before comparing)."""
    share = percent(F.count_if(flag), F.count("*"), 1)
    return df.agg(share.alias("coverage_pct")).where(F.col("coverage_pct") < floor_pct)


def null_outside_era(df: DataFrame, col: str, era: Era | str, date: str = "date_received") -> DataFrame:
    """Rows outside the era that carry a value. `era` is an Era or the name of a flag column."""
    inside = F.col(era) if isinstance(era, str) else era_flag(F.col(date), era)
    return df.where(~inside & F.col(col).isNotNull())


def reconcile(left: DataFrame, right: DataFrame, left_name: str, right_name: str) -> DataFrame:
    """Two one-row totals side by side if they differ; a NULL total differs from any number."""
    ours = left.select(F.col(left.columns[0]).alias(left_name))
    theirs = right.select(F.col(right.columns[0]).alias(right_name))
    both = ours.unionByName(theirs, allowMissingColumns=True)
    return both.agg(F.max(left_name).alias(left_name), F.max(right_name).alias(right_name)).where(
        ~F.col(left_name).eqNullSafe(F.col(right_name))
    )


def same_count(left: DataFrame, right: DataFrame, left_name: str = "left_n", right_name: str = "right_n") -> DataFrame:
    """Row counts of two tables if they differ, e.g. before and after a join."""
    count = F.count("*").alias("n")
    return reconcile(left.agg(count), right.agg(count), left_name, right_name)


def same_total(
    left: DataFrame, left_total: Column, right: DataFrame, right_total: Column,
    left_name: str = "left_n", right_name: str = "right_n",
) -> DataFrame:
    """Aggregates of two tables if they differ."""
    return reconcile(left.agg(left_total.alias("n")), right.agg(right_total.alias("n")), left_name, right_name)


def in_range(df: DataFrame, cols: Sequence[str], lo: float, hi: float) -> DataFrame:
    """Rows with any of the columns outside [lo, hi]; NULL passes."""
    return df.where(reduce(lambda a, b: a | b, [(F.col(c) < lo) | (F.col(c) > hi) for c in cols]))


def coherent(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Rows where a numerator is NULL although its denominator is positive, or the reverse."""
    return df.where(reduce(
        lambda a, b: a | b,
        [(F.col(num).isNull() & (F.col(den) > 0)) | (F.col(num).isNotNull() & (F.col(den) == 0))
         for num, den in pairs],
    ))


@dataclass(frozen=True)
class Check:
    """A named check; a failing `warn` check does not fail a run."""

    name: str
    violations: DataFrame
    severity: str = "error"


def run_checks(checks: Sequence[Check]) -> DataFrame:
    """name, severity, n_failed and status of every check, evaluated in one job."""
    counted = [
        check.violations.agg(F.count("*").alias("n_failed")).select(
            F.lit(check.name).alias("name"),
            F.lit(check.severity).alias("severity"),
            "n_failed",
            F.when(F.col("n_failed") == 0, "pass")
             .otherwise("warn" if check.severity == "warn" else "fail").alias("status"),
        )
        for check in checks
    ]
    return reduce(DataFrame.unionByName, counted)
