"""Resolving free-text names to canonical entities, and measuring how well that works.

Reports group the feed by name first, so a name that holds a third of the rows is folded on the
map side and every later join handles one row per distinct name.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plaintlens.functions.keys import surrogate_key
from plaintlens.functions.rates import ratio
from plaintlens.functions.text import classify_regex, strip_legal_suffixes, trim


def resolve_entities(
    df: DataFrame,
    crosswalk: DataFrame,
    name: str = "company_name_normalized",
    key: str = "raw_company_name",
) -> DataFrame:
    """Add canonical_name, category, company_parent_as_of, is_crosswalked and company_sk.

    Both sides must carry the same normalised name. The surrogate key is hashed once per
    crosswalk row, not per fact row; unmatched rows keep NULLs.
    """
    known = crosswalk.select(
        F.col(key).alias("__name"),
        "canonical_name",
        "category",
        F.col("parent_as_of").alias("company_parent_as_of"),
        surrogate_key(F.col("canonical_name")).alias("company_sk"),
    )
    return df.join(known, F.col(name) == F.col("__name"), "left").select(
        *df.columns,
        *[c for c in known.columns if c != "__name"],
        F.col("__name").isNotNull().alias("is_crosswalked"),
    )


def upper_trim(c: Column) -> Column:
    return F.upper(trim(c))


def _names(df: DataFrame, key: str, weight: str) -> DataFrame:
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias(weight))


def match_rate(
    left: DataFrame, refs: Mapping[str, tuple[DataFrame, str]], key: str, weight: str = "complaints"
) -> DataFrame:
    """Distinct names and rows matched by each reference key and by any of them, as one row."""
    joined = _names(left, key, weight).withColumn("__norm", upper_trim(F.col(key)))
    for label, (ref, column) in refs.items():
        known = (ref.select(upper_trim(F.col(column)).alias("__norm")).where(F.col("__norm").isNotNull())
                 .distinct().withColumn(f"__in_{label}", F.lit(True)))
        joined = joined.join(known, "__norm", "left")
    hits = {label: F.col(f"__in_{label}").isNotNull() for label in refs}
    hits["either"] = reduce(lambda a, b: a | b, list(hits.values()))
    aggs = [F.count("*").alias("distinct_names"), F.sum(weight).alias(f"total_{weight}")]
    for label, hit in hits.items():
        aggs.append(F.count_if(hit).alias(f"matched_{label}"))
        aggs.append(F.sum(F.when(hit, F.col(weight)).otherwise(0)).alias(f"{weight}_matched_{label}"))
    return joined.agg(*aggs)


def match_status(left: DataFrame, ref: DataFrame, left_on: str, ref_on: str, columns: Sequence[str]) -> DataFrame:
    """Whether each row's key occurs in the reference: 'match' or 'no match'."""
    known = ref.select(F.col(ref_on).alias("__ref")).distinct()
    return left.join(known, left[left_on] == known["__ref"], "left").select(
        *columns, F.when(F.col("__ref").isNotNull(), "match").otherwise("no match").alias("join_status")
    )


def name_union(*columns: tuple[DataFrame, str]) -> DataFrame:
    """Distinct normalised names over several name columns."""
    parts = [df.select(upper_trim(F.col(c)).alias("name")).where(F.col("name").isNotNull()) for df, c in columns]
    return reduce(DataFrame.union, parts).distinct()


def unmatched(
    left: DataFrame, refs: Sequence[tuple[DataFrame, str]], key: str, k: int, weight: str = "complaints"
) -> DataFrame:
    """The k most frequent names that occur in none of the references."""
    names = _names(left, key, weight).withColumn("name", upper_trim(F.col(key)))
    return (
        names.join(name_union(*refs), "name", "left_anti")
        .select(key, weight)
        .orderBy(F.desc(weight), F.asc(key))
        .limit(k)
    )


def suffix_match_report(
    left: DataFrame, ref: DataFrame, left_key: str, ref_key: str, amount: str, suffixes: Sequence[str]
) -> DataFrame:
    """Candidate matches of entity keys on the reference after removing legal suffixes."""
    candidates = (
        ref.where(F.col(ref_key).isNotNull())
        .groupBy(F.col(ref_key).alias("fdic_top_holder_matched"))
        .agg(F.sum(amount).alias("__amount"))
        .withColumn("fdic_stripped", strip_legal_suffixes(F.col("fdic_top_holder_matched"), suffixes))
    )
    wanted = left.where(F.col(left_key).isNotNull()).select(
        "canonical_name",
        F.col(left_key).alias("crosswalk_fdic_top_holder"),
        strip_legal_suffixes(F.col(left_key), suffixes).alias("cfpb_stripped"),
    )
    return wanted.join(candidates, F.col("cfpb_stripped") == F.col("fdic_stripped"), "left").select(
        "canonical_name",
        "crosswalk_fdic_top_holder",
        "fdic_top_holder_matched",
        F.round(F.col("__amount") / 1e9, 1).alias("combined_assets_bn"),
        "cfpb_stripped",
        "fdic_stripped",
        (F.col("cfpb_stripped") == F.col("fdic_stripped")).alias("exact_strip_match"),
    )


def token_scan(df: DataFrame, columns: Sequence[str], token: str, amount: str, k: int) -> DataFrame:
    """Groups whose upper-cased name columns mention the token, largest combined amount first."""
    hit = reduce(lambda a, b: a | b, [F.upper(F.col(c)).contains(token) for c in columns])
    return (
        df.where(hit)
        .groupBy(*columns)
        .agg(F.sum(amount).alias("combined_assets"), F.count("*").alias("charters"))
        .orderBy(F.desc_nulls_last("combined_assets"), *columns)
        .limit(k)
    )


def composition(
    df: DataFrame, name: str, rules: Sequence[tuple[str, str]], default: str = "other"
) -> DataFrame:
    """Make-up of a slice by the category its names imply.

    The regex cascade runs once per distinct name, on pre-aggregated counts.
    """
    per_name = df.groupBy(name).agg(F.count("*").alias("n"))
    total = per_name.agg(F.sum("n"))
    return (
        per_name.groupBy(classify_regex(F.col(name), rules, default).alias("implied_category"))
        .agg(F.count(name).alias("distinct_companies"), F.sum("n").alias("complaint_count"))
        .withColumn("pct_of_uncrosswalked", ratio(F.col("complaint_count"), total.scalar(), 3))
    )


def enrichment_coverage(fact: DataFrame, dim: DataFrame, by: str, key: str, enriched: str) -> DataFrame:
    """Rows per group, share of all rows, and how many belong to an enriched entity."""
    counts = fact.groupBy(by, key).agg(F.count("*").alias("n"))
    known = dim.select(key, F.col(enriched).isNotNull().alias("__enriched"))
    total = counts.agg(F.sum("n"))
    return (
        counts.join(known, key, "left")
        .groupBy(by)
        .agg(
            F.sum("n").alias("complaint_count"),
            F.sum(F.when(F.col("__enriched"), F.col("n")).otherwise(0)).alias("has_fdic"),
        )
        .withColumn("pct_of_total", ratio(F.col("complaint_count"), total.scalar(), 3))
        .withColumn("fdic_fill_rate", ratio(F.col("has_fdic"), F.col("complaint_count"), 3))
    )
