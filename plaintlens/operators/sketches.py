"""Components that aren't plain sums but still roll up: quantile and distinct-count sketches of the monthly mart.

A cell keeps a sketch as a binary column. Sketches of cells merge at any coarser grain without the complaints:
quantiles by KLL sketches, whose rank error depends on K alone, distinct counts by theta sketches, which are
exact below 2**LG distinct values and also answer what two groups have in common.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Values a KLL sketch keeps at its top level: a rank error of about 0.7 % (one side, 99 %).
K = 400
#: Rank error that results are held to.
RANK_ERROR = 0.02
#: Logarithm of the distinct values up to which theta sketches are exact; the relative error beyond is about 2**(-LG / 2).
LG = 14
SHARES = (50, 90, 99)


def lag_cells(fact: DataFrame, by: Sequence[str], value: str = "days_to_company", k: int = K) -> DataFrame:
    """A quantile sketch of `value` for each cell of `by`; cells without a value are left out."""
    return fact.where(F.col(value).isNotNull()).groupBy(*by).agg(F.kll_sketch_agg_bigint(F.col(value).cast("long"), k).alias("sketch"))


def quantiles(cells: DataFrame, by: Sequence[str], shares: Sequence[int] = SHARES, k: int = K) -> DataFrame:
    """Number of values and quantiles p<percent> for each group of `by`, from the cells alone."""
    merged = cells.groupBy(*by).agg(F.kll_merge_agg_bigint("sketch", k).alias("sketch"))
    return merged.select(
        *by,
        F.kll_sketch_get_n_bigint("sketch").alias("values_count"),
        *[F.kll_sketch_get_quantile_bigint("sketch", F.lit(p / 100)).alias(f"p{p}") for p in shares],
    )


def judged(found: DataFrame, rows: DataFrame, by: Sequence[str], value: str, shares: Sequence[int] = SHARES, weight: str | None = None) -> DataFrame:
    """Exact quantiles of `rows` beside sketched ones, and whether those lie within RANK_ERROR of their rank.

    p<percent>_exact is the smallest value that at least the share of the values doesn't exceed. Works on
    (group, value) counts, so that a group of a third of all rows is folded before it moves; `weight` names a
    column that says for how many values a row stands.
    """
    counted = rows.where(F.col(value).isNotNull()).groupBy(*by, value).agg((F.count("*") if weight is None else F.sum(weight)).alias("__n"))
    group = W.partitionBy(*by)
    counted = counted.withColumns({
        "__upto": F.sum("__n").over(group.orderBy(value)),
        "__all": F.sum("__n").over(group),
    })
    names = {c: f"__{c}" for c in by}
    named = found.withColumnsRenamed(names)
    same = None
    for c in by:
        one = F.col(c).eqNullSafe(F.col(names[c]))
        same = one if same is None else same & one
    met = counted.join(named, same)
    exact = [F.min(F.when(F.col("__upto") * 100 >= F.col("__all") * p, F.col(value))).alias(f"p{p}_exact") for p in shares]

    def within(p: int):
        below = F.sum(F.when(F.col(value) < F.col(f"p{p}"), F.col("__n")).otherwise(0))
        upto = F.sum(F.when(F.col(value) <= F.col(f"p{p}"), F.col("__n")).otherwise(0))
        total = F.max("__all")
        return ((below <= total * (p / 100 + RANK_ERROR)) & (upto >= total * (p / 100 - RANK_ERROR))).alias(f"p{p}_within")

    return met.groupBy(*by).agg(F.max("values_count").alias("values_count"), *exact, *[within(p) for p in shares])


def distinct_cells(df: DataFrame, value: str, by: Sequence[str], lg: int = LG) -> DataFrame:
    """A distinct-count sketch of `value` for each cell of `by`; NULLs count as no value."""
    return df.groupBy(*by).agg(F.theta_sketch_agg(value, lg).alias("sketch"))


def distinct(cells: DataFrame, by: Sequence[str], lg: int = LG) -> DataFrame:
    """Distinct values of each group of `by`, from the cells alone."""
    merged = cells.groupBy(*by).agg(F.theta_union_agg("sketch", lg).alias("sketch"))
    return merged.select(*by, F.theta_sketch_estimate("sketch").alias("distinct_count"))


def common(cells: DataFrame, by: str, pairs: Sequence[tuple[str, str]], lg: int = LG) -> DataFrame:
    """For each of the given pairs of groups: distinct values in both, and in the first only.

    A pair with a group that has no cell is left out.
    """
    merged = cells.groupBy(by).agg(F.theta_union_agg("sketch", lg).alias("sketch"))
    asked = cells.sparkSession.createDataFrame(list(pairs), "first string, second string")
    one, other = (merged.select(F.col(by).alias(c), F.col("sketch").alias(f"__{c}")) for c in ("first", "second"))
    return asked.join(one, "first").join(other, "second").select(
        "first",
        "second",
        F.theta_sketch_estimate(F.theta_intersection("__first", "__second")).alias("in_both"),
        F.theta_sketch_estimate(F.theta_difference("__first", "__second")).alias("in_first_only"),
    )
