"""Bank-grain and monthly marts, and the rollups built on them.

The fact is grouped by entity key before it meets the dimension: a third of all rows on one
company folds into one partial row per task, and the join handles one row per company and cell.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from plaintlens.functions.rates import era_rate, ratio
from plaintlens.operators.maintain import BY, MEASURES, component_cells, defined, period_of

BANK_ATTRIBUTES = [
    "canonical_name", "top_holder_normalized", "bank_size_bucket", "bank_size_rank", "charter_count",
    "is_supervised_cfpb", "avg_roa", "offices_count", "is_branchless", "deposits_to_assets_ratio",
    "capital_ratio", "avg_roe", "credit_card_institution", "primary_specialization",
]


def _enriched(banks: DataFrame) -> DataFrame:
    return banks.where(F.col("total_assets_usd").isNotNull())


def _billions(digits: int | None = None):
    value = F.col("total_assets_usd") / 1e9
    return value if digits is None else F.round(value, digits)


def entity_metrics(fact: DataFrame, banks: DataFrame) -> DataFrame:
    """One row per bank that has assets and complaints: volume, routing, era-gated rates, ranks.

    The percent ranks run over one row per bank, so their single partition is as small as the
    hand-kept crosswalk.
    """
    dispute, narrative = F.col("is_dispute_era"), F.col("is_narrative_era")
    volumes = (
        fact.where(F.col("company_sk").isNotNull())
        .groupBy("company_sk")
        .agg(
            F.count("*").alias("complaint_count"),
            F.min("date_received").alias("first_complaint_date"),
            F.max("date_received").alias("last_complaint_date"),
            F.round(F.avg("days_to_company"), 2).alias("avg_days_to_company"),
            ratio(F.count_if(F.col("days_to_company") == 0), F.count("*"), 4).alias("pct_routed_same_day"),
            ratio(F.count_if("timely_response"), F.count("*"), 4).alias("timely_response_rate"),
            era_rate(F.col("consumer_disputed"), dispute, 4).alias("dispute_rate"),
            era_rate(F.col("has_narrative"), narrative, 4).alias("narrative_rate"),
        )
    )
    joined = _enriched(banks).join(volumes, "company_sk")
    ranks = {
        "roe_percentile_rank": W.orderBy("avg_roe"),
        "offices_count_percentile_rank": W.orderBy("offices_count"),
    }
    return joined.select(
        "company_sk",
        *BANK_ATTRIBUTES[:4],
        _billions(1).alias("total_assets_billions"),
        *BANK_ATTRIBUTES[4:],
        "complaint_count",
        F.round(F.col("complaint_count") / _billions(), 2).alias("complaints_per_billion_assets"),
        "first_complaint_date",
        "last_complaint_date",
        "avg_days_to_company",
        "pct_routed_same_day",
        "timely_response_rate",
        "dispute_rate",
        "narrative_rate",
        *[F.round(F.percent_rank().over(w), 4).alias(name) for name, w in ranks.items()],
    )


def components_of(
    cells: DataFrame, banks: DataFrame, grain: str = "month", by: Sequence[str] = BY
) -> DataFrame:
    """The component mart of stored or maintained cells.

    An era-gated numerator is NULL exactly when its denominator is 0.
    """
    return defined(cells).join(_enriched(banks), "company_sk").select(
        "company_sk",
        "canonical_name",
        period_of(grain),
        *by,
        "bank_size_bucket",
        "bank_size_rank",
        "is_branchless",
        "primary_specialization",
        _billions(1).alias("total_assets_billions"),
        "is_supervised_cfpb",
        *[m for m in MEASURES if m != "days_known_count"],
    )


def component_mart(
    fact: DataFrame, banks: DataFrame, grain: str = "month", by: Sequence[str] = BY
) -> DataFrame:
    """Additive components per bank, period and category; rates follow by summing and dividing."""
    return components_of(component_cells(fact, grain, by), banks, grain, by)


# numerator and denominator component of each rate the monthly mart can answer
COMPONENT_RATES = {
    "timely_response_rate": ("timely_response_count", "complaint_count"),
    "same_day_rate": ("routed_same_day_count", "complaint_count"),
    "avg_days_to_company": ("sum_days_to_company", "complaint_count"),
    "dispute_rate": ("disputed_count", "complaint_count_dispute_era"),
    "narrative_rate": ("narrative_count", "complaint_count_narrative_era"),
}


def rollup_components(
    mart: DataFrame, by: Sequence[str], rates: Mapping[str, tuple[str, str]] = COMPONENT_RATES
) -> DataFrame:
    """Rates at any coarser grain: sum the stored components, then divide."""
    parts = list(dict.fromkeys(c for pair in rates.values() for c in pair))
    sums = mart.groupBy(*by).agg(*[F.sum(c).alias(c) for c in parts])
    return sums.withColumns({name: ratio(F.col(a), F.col(b)) for name, (a, b) in rates.items()})


def volume_feed(fact: DataFrame, grain: str = "quarter", exclude: Sequence[str] = ("credit_reporting",)) -> DataFrame:
    """Complaint volume per period and product category for the trend chart."""
    return (
        fact.where(~F.col("product_category").isin(list(exclude)))
        .groupBy(F.trunc("date_received", grain).alias(f"{grain}_start"), "product_category")
        .agg(F.count("*").alias("complaint_count"))
    )


def top_companies(fact: DataFrame, k: int = 20) -> DataFrame:
    """The k companies with most complaints, with their category."""
    return (
        fact.where("is_crosswalked")
        .groupBy("canonical_name", "category")
        .agg(F.count("*").alias("complaint_count"))
        .orderBy(F.desc("complaint_count"), "canonical_name")
        .limit(k)
    )


def tier_rollup(mart: DataFrame, by: str = "bank_size_bucket") -> DataFrame:
    """Bank mart folded to asset tiers: volume over summed assets, not an average of ratios."""
    return (
        mart.groupBy(by)
        .agg(
            F.count("*").alias("bank_count"),
            F.sum("complaint_count").alias("complaint_count"),
            F.sum(F.col("total_assets_billions").cast("decimal(20,1)")).cast("double").alias("total_assets_billions"),
        )
        .withColumn("complaints_per_billion_assets",
                    ratio(F.col("complaint_count"), F.col("total_assets_billions"), 2))
    )


def category_comparison(fact: DataFrame) -> DataFrame:
    """Volume and era-gated rates by company category, uncrosswalked complaints in the NULL group."""
    return fact.groupBy("category").agg(
        F.count("*").alias("complaint_count"),
        ratio(F.count_if("timely_response"), F.count("*"), 4).alias("timely_response_rate"),
        era_rate(F.col("consumer_disputed"), F.col("is_dispute_era"), 4).alias("dispute_rate"),
        era_rate(F.col("has_narrative"), F.col("is_narrative_era"), 4).alias("narrative_rate"),
    )
