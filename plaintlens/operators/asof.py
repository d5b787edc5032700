"""As-of join: each row with the version of its key that was in force at the row's time.

There is no range condition to test pair by pair. Versions and rows are put in one sequence by key and time, and each
row takes the last version before it. A key with more than one part in HEAVY of all rows is cut into
ranges of time with about equally many rows; each range gets, besides the versions that begin in it, the one in
force where it starts, so that ranges can be worked through apart. Many rows at one and the same time make
several ranges start there, and are dealt out to all of them.

A version is in force from its start until its end or the start of the key's next version, whichever comes first; a
version without an end stays in force until then. Of versions that start together the last in the order of
all their columns counts. Rows without a key or time, and rows before, between or after versions, get NULLs. Versions
without a key or start are never in force.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: A key with more than one row in HEAVY is cut into RANGES ranges; there are fewer than HEAVY such keys.
HEAVY, RANGES = 64, 32


def heavy_ranges(rows: DataFrame, key: str, time: str, heavy: int = HEAVY, ranges: int = RANGES) -> DataFrame:
    """key and `starts`, the times at which a heavy key's ranges begin, in order, the first range left out."""
    counts = rows.groupBy(key).agg(F.count("*").alias("__n"))
    total = counts.agg(F.sum("__n"))
    hot = counts.where(F.col("__n") * heavy > total.scalar()).select(key)
    shares = [k / ranges for k in range(1, ranges)]
    mine = rows.join(F.broadcast(hot), key, "left_semi")
    return mine.groupBy(key).agg(F.percentile_approx(time, shares).alias("__starts"))


def _ranges_from(starts: Column, time: Column) -> tuple[Column, Column]:
    """The first and last range a row of this time may go to: those that start at this time, or the one under way."""
    until = F.size(F.filter(starts, lambda s: s <= time))
    before = F.size(F.filter(starts, lambda s: s < time))
    return F.least(before + 1, until), until


def as_of_join(
    fact: DataFrame, history: DataFrame, key: str, time: str, columns: Sequence[str],
    valid_from: str = "valid_from", valid_to: str = "valid_to", heavy: int = HEAVY, ranges: int = RANGES,
) -> DataFrame:
    """All rows of fact, with `columns` of the version of `key` that was in force at `time`."""
    clash = sorted({*columns} & {*fact.columns})
    if clash:
        raise ValueError(f"both sides have {', '.join(clash)}")
    at = F.col(time).cast("timestamp")
    whole = F.struct(*fact.columns)
    placed = fact.select(F.col(key).alias("__key"), at.alias("__at"), whole.alias("__row"))
    usable = F.col("__key").isNotNull() & F.col("__at").isNotNull()
    rows = placed.where(usable)
    starts = heavy_ranges(rows.select("__key", "__at"), "__key", "__at", heavy, ranges)

    start, end = F.col(valid_from).cast("timestamp"), F.col(valid_to).cast("timestamp")
    order = F.struct(start, F.struct(*history.columns))
    following = F.lead(start).over(W.partitionBy(key).orderBy(order))
    versions = (
        history.where(F.col(key).isNotNull() & start.isNotNull())
        .select(F.col(key).alias("__key"), start.alias("__at"), F.least(end, following).alias("__end"),
                F.struct(*columns).alias("__values"))
        .where(F.col("__end").isNull() | (F.col("__at") < F.col("__end")))
    )

    none = F.array().cast("array<timestamp>")
    known = F.coalesce(F.col("__starts"), none)
    dealt = rows.join(F.broadcast(starts), "__key", "left")
    first, last = _ranges_from(known, F.col("__at"))
    dealt = dealt.select("__key", "__at", "__row", (first + F.pmod(F.xxhash64("__row"), last - first + 1)).cast("int").alias("__range"))

    spread = versions.join(F.broadcast(starts), "__key", "left")
    # from the range its start lies in to the last one that starts before its end
    begins = F.size(F.filter(known, lambda s: s < F.col("__at")))
    ends = F.size(F.filter(known, lambda s: F.col("__end").isNull() | (s < F.col("__end"))))
    spread = spread.withColumn("__range", F.explode(F.sequence(begins, ends)))

    both = dealt.withColumns({"__fact": F.lit(1), "__end": F.lit(None).cast("timestamp")}).unionByName(
        spread.select("__key", "__at", "__end", "__values", "__range").withColumn("__fact", F.lit(0)), allowMissingColumns=True)
    before = W.partitionBy("__key", "__range").orderBy("__at", "__fact").rowsBetween(W.unboundedPreceding, W.currentRow)
    version = F.when(F.col("__fact") == 0, F.struct("__end", "__values"))
    carried = both.withColumn("__version", F.last(version, ignorenulls=True).over(before)).where("__fact = 1")
    in_force = F.col("__version.__end").isNull() | (F.col("__at") < F.col("__version.__end"))
    found = carried.select("__row", F.when(in_force, F.col("__version.__values")).alias("__values"))
    rest = placed.where(~usable).select("__row", F.lit(None).cast(found.schema["__values"].dataType).alias("__values"))
    return found.unionByName(rest).select("__row.*", *[F.col(f"__values.{c}") for c in columns])
