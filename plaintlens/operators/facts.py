"""From raw tables to the complaint fact."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plaintlens import defaults as D
from plaintlens.functions import flags, text
from plaintlens.functions.flags import Era
from plaintlens.operators.lookup import apply_mapping

TRIMMED = ["product", "subproduct", "issue", "subissue", "submitted_via", "company_name", "tags"]
BANK_TRIMMED = ["fdic_cert", "institution_name", "trade_name_1", "address", "city",
                "high_holder_city", "top_holder"]


def clean_fields(raw: DataFrame, full_years: tuple[int, int] = D.FULL_YEARS) -> DataFrame:
    """Trim, normalise and default the complaint columns, row by row."""
    col = F.col
    # trimmed once here, then read several times below
    trimmed = raw.withColumns({c: text.trim(col(c)) for c in TRIMMED})
    return trimmed.select(
        "complaint_id",
        "date_received",
        "date_sent_to_company",
        "product",
        "subproduct",
        "issue",
        "subissue",
        "submitted_via",
        "company_name",
        text.normalize_name(col("company_name")).alias("company_name_normalized"),
        text.clean_code(col("state"), D.STATE_ALIASES, 2, D.NOT_PROVIDED).alias("state"),
        text.clean_zip(col("zip_code")).alias("zip_code"),
        "tags",
        *[text.tag_flag(col("tags"), tag).alias(flag) for flag, tag in D.TAGS.items()],
        text.fill_missing(col("company_response_to_consumer"), D.NO_RESPONSE).alias("company_response_to_consumer"),
        text.relabel(col("company_public_response"), D.PUBLIC_RESPONSE_LABELS, D.NOT_PROVIDED)
            .alias("company_public_response"),
        text.fill_missing(col("consumer_consent_provided"), D.NOT_PROVIDED).alias("consumer_consent_provided"),
        "timely_response",
        "consumer_disputed",
        "has_narrative",
        flags.in_full_years(col("date_received"), *full_years).alias("has_full_year_data"),
    )


def map_products(df: DataFrame, product_map: DataFrame) -> DataFrame:
    """Current product label; vehicle loans are decided by their subproduct before the map."""
    vehicle = (F.col("product") == D.VEHICLE_PRODUCT) & F.col("subproduct").isin(D.VEHICLE_SUBPRODUCTS)
    return apply_mapping(df, product_map, {"product": "raw_product"}, "product_normalized", "product_normalized",
                         default=F.col("product"), override=F.when(vehicle, D.VEHICLE_LABEL))


def map_subproducts(df: DataFrame, subproduct_map: DataFrame) -> DataFrame:
    return apply_mapping(df, subproduct_map, {"product": "raw_product", "subproduct": "raw_subproduct"},
                         "subproduct_normalized", "subproduct_normalized",
                         default=F.col("subproduct"), null_as_blank=["subproduct"])


def map_issues(df: DataFrame, issue_map: DataFrame) -> DataFrame:
    return apply_mapping(df, issue_map, {"issue": "issue"}, "issue_category", "issue_category", default="other")


def clean_complaints(
    raw: DataFrame,
    product_map: DataFrame,
    subproduct_map: DataFrame,
    issue_map: DataFrame,
    full_years: tuple[int, int] = D.FULL_YEARS,
) -> DataFrame:
    """Cleaned complaints on the current taxonomy, one row per raw row."""
    cleaned = clean_fields(raw, full_years)
    mapped = map_issues(map_subproducts(map_products(cleaned, product_map), subproduct_map), issue_map)
    return mapped.withColumn("zip_code_is_valid", text.zip_is_valid(F.col("zip_code")))


def clean_banks(raw: DataFrame) -> DataFrame:
    """Bank reference rows with trimmed identity text; all other columns pass through."""
    renamed = raw.withColumnRenamed("fdic_certificate_number", "fdic_cert")
    trimmed = {c: text.trim(F.col(c)) for c in BANK_TRIMMED if c in renamed.columns}
    return renamed.withColumns({**trimmed, "state": F.upper(text.trim(F.col("state")))})


def clean_crosswalk(seed: DataFrame) -> DataFrame:
    return seed.select(
        text.normalize_name(F.col("raw_company_name")).alias("raw_company_name"),
        *[text.trim(F.col(c)).alias(c) for c in ("canonical_name", "category", "fdic_top_holder")],
        F.col("parent_as_of").cast("date").alias("parent_as_of"),
    )


FACT_COLUMNS: Sequence[str] = [
    "complaint_id", "date_received", "date_sent_to_company", "product", "subproduct", "product_normalized",
    "product_category", "subproduct_normalized", "issue", "subissue", "issue_category", "company_sk",
    "company_name", "company_name_normalized", "canonical_name", "category", "is_crosswalked", "state",
    "zip_code", "zip_code_is_valid", "submitted_via", "tags_is_servicemember", "tags_is_older_american",
    "consumer_consent_provided", "company_response_to_consumer", "had_monetary_relief", "response_category",
    "company_public_response", "timely_response", "consumer_disputed", "has_narrative", "has_full_year_data",
    "is_dispute_era", "is_narrative_era", "days_to_company", "days_to_company_bucket",
]


def build_fact(
    resolved: DataFrame,
    dispute_era: Era = D.DISPUTE_ERA,
    narrative_era: Era = D.NARRATIVE_ERA,
    product_categories: Mapping[str, str] = D.PRODUCT_CATEGORIES,
    response_categories: Mapping[str, str] = D.RESPONSE_CATEGORIES,
) -> DataFrame:
    """Derive categories, era flags and routing lag from resolved complaints."""
    response = F.col("company_response_to_consumer")
    return (
        resolved.withColumns({
            "product_category": text.categorize(F.col("product_normalized"), product_categories, "other"),
            "had_monetary_relief": response == D.MONETARY_RELIEF,
            "response_category": text.categorize(response, response_categories, "other"),
            "is_dispute_era": flags.era_flag(F.col("date_received"), dispute_era),
            "is_narrative_era": flags.era_flag(F.col("date_received"), narrative_era),
            "days_to_company": flags.days_between_clamped(F.col("date_received"), F.col("date_sent_to_company")),
        })
        .withColumn("days_to_company_bucket", flags.bucketize(F.col("days_to_company"), D.LAG_CUTS, D.LAG_LABELS))
        .select(*FACT_COLUMNS)
    )
