"""Rolling institutions up to their parent."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plaintlens import defaults as D
from plaintlens.functions.flags import bucket_rank, bucketize
from plaintlens.functions.rates import ratio
from plaintlens.functions.text import display_name


def largest(value: str, by: str, tie: str) -> Column:
    """Aggregate: the non-null `value` of the row with the greatest `by`, ties broken by `tie`.

    Rows whose `by` is NULL rank last but still count, as long as they carry a value.
    """
    v = F.col(value)
    order = F.struct(F.col(by).isNotNull(), F.col(by), F.col(tie))
    return F.max_by(v, F.when(v.isNotNull(), order))


def rollup_to_parent(
    df: DataFrame,
    parent: str,
    count: str,
    sums: Mapping[str, str] = {},
    any_flags: Mapping[str, str] = {},
    means: Mapping[str, str] = {},
    ratios: Mapping[str, tuple[str, str]] = {},
    largest_by: tuple[Mapping[str, str], str, str] | None = None,
    digits: int = 4,
) -> DataFrame:
    """One row per non-null parent. Every mapping is output name -> input column(s).

    means are unweighted over member rows; ratios divide sums; any_flags are NULL only when all
    members are NULL; largest_by = (columns, order column, tie column).
    """
    aggs: list[Column] = [F.count("*").alias(count)]
    aggs += [F.sum(c).alias(out) for out, c in sums.items()]
    aggs += [F.bool_or(c).alias(out) for out, c in any_flags.items()]
    aggs += [F.round(F.avg(c), digits).alias(out) for out, c in means.items()]
    aggs += [ratio(F.sum(a), F.sum(b), digits).alias(out) for out, (a, b) in ratios.items()]
    if largest_by is not None:
        columns, by, tie = largest_by
        aggs += [largest(c, by, tie).alias(out) for out, c in columns.items()]
    return df.where(F.col(parent).isNotNull()).groupBy(parent).agg(*aggs)


def holder_rollup(
    banks: DataFrame,
    cuts: Sequence[int] = D.ASSET_CUTS,
    labels: Sequence[str] = D.ASSET_LABELS,
    branchless_below: int = D.BRANCHLESS_BELOW,
) -> DataFrame:
    """Bank institutions at holding-company grain, with size tier and display name.

    Source amounts are in thousands; the join key stays the raw holder string.
    """
    holders = rollup_to_parent(
        banks,
        "top_holder",
        count="charter_count",
        sums={"__assets": "total_assets", "offices_count": "offices_count"},
        any_flags={"is_supervised_cfpb": "cfpb_supervisory_flag",
                   "credit_card_institution": "credit_card_institution"},
        means={"avg_roa": "return_on_assets", "avg_roe": "return_on_equity"},
        ratios={"deposits_to_assets_ratio": ("total_deposits", "total_assets"),
                "capital_ratio": ("equity_capital", "total_assets")},
        largest_by=({"primary_specialization": "primary_specialization", "hq_state": "holding_company_state"},
                    "total_assets", "fdic_cert"),
    )
    tier = bucketize(F.col("__assets"), cuts, labels, op=">=")
    return holders.select(
        "top_holder",
        display_name(F.col("top_holder"), D.HOLDER_REPLACEMENTS, D.HOLDER_SUFFIX).alias("top_holder_normalized"),
        "charter_count",
        (F.col("__assets") * 1000).alias("total_assets_usd"),
        "is_supervised_cfpb",
        "avg_roa",
        tier.alias("bank_size_bucket"),
        bucket_rank(tier, list(reversed(labels))).alias("bank_size_rank"),
        "offices_count",
        (F.col("offices_count") < branchless_below).alias("is_branchless"),
        "deposits_to_assets_ratio",
        "capital_ratio",
        "avg_roe",
        "credit_card_institution",
        "primary_specialization",
        "hq_state",
    )
