"""Slowly changing history, lookback upserts and freshness."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _moment(t: dt.datetime | str) -> Column:
    return F.lit(str(t)).cast("timestamp")


def _opened(columns: Sequence[str], key: str, at: Column, prefix: str = "") -> dict[str, Column]:
    """Columns of a row that comes into force at `at`."""
    return {
        **{c: F.col(prefix + c) for c in columns},
        "valid_from": at,
        "valid_to": F.lit(None).cast("timestamp"),
        "updated_at": at,
        "row_id": F.md5(F.concat_ws("|", F.col(prefix + key).cast("string"), at.cast("string"))),
    }


def _row(fields: dict[str, Column], names: Sequence[str]) -> Column:
    return F.struct(*[fields[n].alias(n) for n in names])


def scd2_merge(
    history: DataFrame | None, incoming: DataFrame, key: str, check_cols: Sequence[str], as_of: dt.datetime | str
) -> DataFrame:
    """Next version of a history table.

    A key whose `check_cols` differ (null-safe) closes its open row and opens a new one; a new
    key opens a row; keys missing from `incoming` and changes outside `check_cols` leave the
    history as it is. Merging the same input again changes nothing. Keys must be unique in
    `incoming` (see checks.unique). Incoming rows without a key identify nothing and are left out.
    Columns that only one side has are kept, NULL where the other side's rows lack them.
    """
    at = _moment(as_of)
    columns = incoming.columns
    incoming = incoming.where(F.col(key).isNotNull())
    if history is None:
        return incoming.select(*[c.alias(name) for name, c in _opened(columns, key, at).items()])

    kinds = {**dict(incoming.dtypes), **dict(history.dtypes)}
    names = [*history.columns, *(c for c in columns if c not in history.columns)]
    history = history.select("*", *(F.lit(None).cast(kinds[c]).alias(c) for c in names if c not in history.columns))
    current = history.where(F.col("valid_to").isNull()).withColumn("__old", F.lit(True))
    new = incoming.select(*[F.col(c).alias(f"new_{c}") for c in columns], F.lit(True).alias("__new"))
    pairs = current.join(new, F.col(key) == F.col(f"new_{key}"), "full_outer")

    old = {c: F.col(c) for c in names}
    absent = {c: F.lit(None).cast(kinds[c]) for c in names}
    old_row = _row(old, names)
    closed_row = _row({**old, "valid_to": at, "updated_at": at}, names)
    new_row = _row({**absent, **_opened(columns, key, at, "new_")}, names)
    differs = [~F.col(c).eqNullSafe(F.col(f"new_{c}") if c in columns else absent[c]) for c in check_cols]
    changed = reduce(lambda a, b: a | b, differs)

    rows = (
        F.when(F.col("__new").isNull(), F.array(old_row))
        .when(F.col("__old").isNull(), F.array(new_row))
        .when(changed, F.array(closed_row, new_row))
        .otherwise(F.array(old_row))
    )
    return pairs.select(F.inline(rows)).unionByName(history.where(F.col("valid_to").isNotNull()))


def scd2_as_of(history: DataFrame, t: dt.datetime | str) -> DataFrame:
    """Rows in force at time t: valid_from <= t < valid_to, open rows without end."""
    at = _moment(t)
    return history.where((F.col("valid_from") <= at) & (F.col("valid_to").isNull() | (at < F.col("valid_to"))))


def known_changes(crosswalk: DataFrame, since: str = "parent_as_of") -> DataFrame:
    """Crosswalk rows that record a dated rename."""
    return crosswalk.where(F.col(since).isNotNull())


def latest_per_key(df: DataFrame, key: str, version: str) -> DataFrame:
    """The newest version of each key; equal versions are decided by a hash of the row.

    An aggregate, not a window: copies of one key fold on the map side before the shuffle.
    """
    row = F.struct(*df.columns)
    order = F.struct(F.col(version), F.xxhash64(*df.columns))
    return df.groupBy(key).agg(F.max_by(row, order).alias("__row")).select("__row.*").select(*df.columns)


def upsert_lookback(
    existing: DataFrame, delta: DataFrame, key: str, time_col: str, days: int, version: str
) -> DataFrame:
    """Existing rows overwritten by the recent part of a delta.

    Of each key the newest version in the delta counts. Those later than the newest existing date minus
    `days` replace rows with the same key or are added; older ones are ignored. A column only one side has is NULL on the other.
    """
    recent = recent_versions(existing, delta, key, time_col, days, version)
    kept = existing.join(recent.select(key), key, "left_anti")
    return kept.unionByName(recent, allowMissingColumns=True)


def recent_versions(
    existing: DataFrame, delta: DataFrame, key: str, time_col: str, days: int, version: str
) -> DataFrame:
    """The newest version of each key in a delta, if it is recent.

    An older version never stands in for a newest one that is out of the lookback: applying a delta moves
    the newest date on, and applying it again must not bring older versions back.
    """
    return since_lookback(existing, latest_per_key(delta, key, version), time_col, days)


def since_lookback(existing: DataFrame, delta: DataFrame, time_col: str, days: int) -> DataFrame:
    """Delta rows later than the newest existing date minus `days`; all of them if nothing exists."""
    newest = existing.agg(F.max(time_col).alias("newest"))
    floor = newest.select(F.coalesce(F.date_sub("newest", days), F.lit("0001-01-01").cast("date")))
    return delta.where(F.col(time_col) > floor.scalar())


def append_columns(old: DataFrame, new: DataFrame) -> DataFrame:
    """Stack two versions of a table; added columns are NULL for old rows."""
    return old.unionByName(new, allowMissingColumns=True)


def freshness(df: DataFrame, loaded_at: str, as_of: dt.date | str, warn_days: int, error_days: int) -> DataFrame:
    """Age of the newest row in days against the warn and error thresholds."""
    age = F.datediff(F.lit(str(as_of)).cast("date"), F.col("max_loaded_at"))
    return df.agg(F.max(F.col(loaded_at).cast("date")).alias("max_loaded_at")).select(
        "max_loaded_at",
        age.alias("age_days"),
        F.when(age.isNull() | (age > error_days), "error").when(age > warn_days, "warn").otherwise("pass")
         .alias("status"),
    )
