"""Date, company and bank dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plaintlens import defaults as D
from plaintlens.functions.flags import as_date, week_of_year_sunday
from plaintlens.functions.keys import surrogate_key


def date_spine(spark: SparkSession, start: str = D.DATE_RANGE[0], end: str = D.DATE_RANGE[1]) -> DataFrame:
    """Every day from start to end, both included."""
    days = F.sequence(as_date(start), as_date(end), F.expr("interval 1 day"))
    return spark.range(1).select(F.explode(days).alias("date_day"))


def date_spine_over(df: DataFrame, date: str) -> DataFrame:
    """Every day between the first and last date that occur in the table."""
    bounds = df.agg(F.min(date).alias("lo"), F.max(date).alias("hi")).where(F.col("lo").isNotNull())
    return bounds.select(F.explode(F.sequence("lo", "hi", F.expr("interval 1 day"))).alias("date_day"))


def date_dim(spine: DataFrame) -> DataFrame:
    day = F.col("date_day")
    return spine.select(
        "date_day",
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month_num"),
        F.date_format(day, "MMMM").alias("month_name"),
        week_of_year_sunday(day).alias("week_of_year"),
        F.dayofweek(day).alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.trunc(day, "month").alias("first_day_of_month"),
        F.trunc(day, "quarter").alias("first_day_of_quarter"),
        F.trunc(day, "year").alias("first_day_of_year"),
    )


def time_spine(dates: DataFrame) -> DataFrame:
    return dates.select("date_day")


def entity_dim(crosswalk: DataFrame, fact: DataFrame) -> DataFrame:
    """One row per canonical company with its current parent key and complaint history.

    A dated crosswalk row is historic and never supplies the parent. Companies without
    complaints keep NULL statistics.
    """
    companies = crosswalk.groupBy("canonical_name", "category").agg(
        F.max(F.when(F.col("parent_as_of").isNull(), F.col("fdic_top_holder"))).alias("fdic_top_holder")
    )
    stats = (
        fact.where("is_crosswalked")
        .groupBy("canonical_name")
        .agg(
            F.min("date_received").alias("first_seen_date"),
            F.max("date_received").alias("last_seen_date"),
            F.count("*").alias("total_complaint_volume"),
        )
    )
    return companies.join(stats, "canonical_name", "left").select(
        surrogate_key(F.col("canonical_name")).alias("company_sk"),
        "canonical_name",
        "category",
        (F.col("category") == "credit_bureau").alias("is_credit_bureau"),
        "fdic_top_holder",
        "first_seen_date",
        "last_seen_date",
        "total_complaint_volume",
    )


def enrich_dim(dim: DataFrame, ref: DataFrame, left_on: str, right_on: str) -> DataFrame:
    """Left-join a reference roll-up on its raw key; the key column of the reference is dropped."""
    return dim.join(ref, dim[left_on] == ref[right_on], "left").drop(ref[right_on])


def bank_dim(companies: DataFrame, holders: DataFrame) -> DataFrame:
    """Bank-category companies with holder attributes; a bank without a match keeps NULLs."""
    banks = companies.where(F.col("category") == "bank").select(
        "company_sk", "canonical_name", "fdic_top_holder", "total_complaint_volume"
    )
    enriched = enrich_dim(banks, holders, "fdic_top_holder", "top_holder")
    last = "total_complaint_volume"
    return enriched.select(*[c for c in enriched.columns if c != last], last)
