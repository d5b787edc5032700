"""Ranks, shares and running sums over any order of any number of rows, without a window over all rows."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from plaintlens.session import shared_folder
from plaintlens.sources.tables import save


def ranked(df: DataFrame, order: Mapping[str, bool], sums: Sequence[str] = (), parts: int | None = None) -> DataFrame:
    """Adds what SQL windows over all rows give: rank, percent_rank, cume_dist, and running_<column> of each of `sums`.

    `order` gives columns and whether each ascends; NULLs come first ascending and last descending. Rows that tie
    share all results (running sums include all rows of the tie), so they are folded to one row each before anything
    moves: a tie of a third of all rows costs no more than one of two rows, and none crosses a part's border.
    The folded rows are dealt to `parts` ranges and written once, as the borders are sampled; each range then looks at its own
    rows only, and at the totals of the ranges before it, of which there is one row a range.
    Empty input gives an empty result, and a single row has percent_rank 0 and cume_dist 1.
    """
    spark = df.sparkSession
    keys = list(order)
    directed = [F.asc_nulls_first(k) if up else F.desc_nulls_last(k) for k, up in order.items()]
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    totals = {"__n": F.count("*"), **{f"__{c}": F.sum(c) for c in sums}}
    ties = df.groupBy(*keys).agg(*[e.alias(name) for name, e in totals.items()])
    path = f"{shared_folder(spark)}/ranked-{uuid.uuid4().hex}"
    dealt = save(ties.repartitionByRange(parts, *directed).withColumn("__part", F.spark_partition_id()), path, "overwrite")

    inside = W.partitionBy("__part").orderBy(*directed).rowsBetween(W.unboundedPreceding, W.currentRow)
    before = W.orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    per_part = dealt.groupBy("__part").agg(*[F.sum(name).alias(name) for name in totals])
    everything = per_part.agg(F.sum("__n")).scalar()
    offsets = per_part.select("__part", *[F.sum(name).over(before).alias(f"{name}_before") for name in totals])

    def upto(name: str) -> Column:
        """Sum up to and with the row's tie; NULL while there is no value, as in SQL."""
        here, earlier = F.col(f"{name}_here"), F.col(f"{name}_before")
        return F.coalesce(here + earlier, here, earlier)

    local = dealt.select("*", *[F.sum(name).over(inside).alias(f"{name}_here") for name in totals])
    last = upto("__n")
    rank = last - F.col("__n") + 1
    found = local.join(offsets, "__part").select(
        *[F.col(k).alias(f"__key_{k}") for k in keys],
        rank.alias("rank"),
        F.coalesce(F.try_divide((rank - 1).cast("double"), (everything - 1).cast("double")), F.lit(0.0)).alias("percent_rank"),
        (last.cast("double") / everything).alias("cume_dist"),
        *[upto(f"__{c}").alias(f"running_{c}") for c in sums],
    )
    same = None
    for k in keys:
        one = F.col(k).eqNullSafe(F.col(f"__key_{k}"))
        same = one if same is None else same & one
    return df.join(found, same).drop(*[f"__key_{k}" for k in keys])
