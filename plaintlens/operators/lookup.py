"""Mapping columns through lookup tables.

No broadcast hints: Catalyst compares the lookup's size with spark.sql.autoBroadcastJoinThreshold
and broadcasts below it. A larger lookup becomes a shuffle join whose hot keys AQE splits.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def apply_mapping(
    df: DataFrame,
    mapping: DataFrame,
    on: Mapping[str, str],
    value: str,
    out: str,
    default: Column | str | None = None,
    null_as_blank: Sequence[str] = (),
    override: Column | None = None,
) -> DataFrame:
    """Left-join `mapping` and add `out` = override, else mapped value, else default.

    `on` maps columns of `df` to columns of `mapping`. Columns of `df` listed in `null_as_blank`
    match NULL with ''. Mapping keys must be unique (see checks.unique); then rows are preserved.
    """
    keys = list(on.items())
    small = mapping.select(
        *[(F.coalesce(F.col(theirs), F.lit("")) if ours in null_as_blank else F.col(theirs)).alias(f"__key{i}")
          for i, (ours, theirs) in enumerate(keys)],
        F.col(value).alias("__value"),
    )
    condition = reduce(
        lambda a, b: a & b,
        [(F.coalesce(F.col(ours), F.lit("")) if ours in null_as_blank else F.col(ours)) == F.col(f"__key{i}")
         for i, (ours, _) in enumerate(keys)],
    )
    choices = [c for c in (override, F.col("__value")) if c is not None]
    if default is not None:
        choices.append(default if isinstance(default, Column) else F.lit(default))
    kept = [F.col(c) for c in df.columns if c != out]
    return df.join(small, condition, "left").select(*kept, F.coalesce(*choices).alias(out))
