"""One runnable query per operator, over the given tables.

Each takes (spark, sf_dir) and returns a lazy DataFrame over whole tables.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce, wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plaintlens import defaults as D
from plaintlens.functions import flags, text
from plaintlens.operators import asof, checks, dims, entity, facts, grains, history, maintain, marts, ordered, profile, sketches
from plaintlens.operators.lookup import apply_mapping
from plaintlens.operators.metrics import metric, over_spine
from plaintlens.plans import given
from plaintlens.plans.build import Models, store_checked
from plaintlens.plans.given import models, table
from plaintlens.session import shared_folder, tune
from plaintlens.sources import schemas
from plaintlens.sources.tables import describe_schema, materialize_lean, read_banks, read_complaints, read_seed, save
from plaintlens.streaming import versions

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

ANALYSIS_CUTS = ["1997-01-01", "1999-01-01"]
ANALYSIS_LABELS = ["pre_1997", "1997_1998", "1999_plus"]
INTAKE_CHANNELS = ["Web", "Phone", "Referral", "Postal mail", "Fax", "Email", "Web Referral"]


def query(fn: Query) -> Query:
    @wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(tune(spark), sf_dir)

    QUERIES[fn.__name__] = run
    return run


def raw(spark: SparkSession, sf: str) -> DataFrame:
    return given.raw_complaints(spark, sf)


def names(spark: SparkSession, sf: str) -> DataFrame:
    """Complaints of full years with the normalised name as the profiling scripts write it."""
    df = raw(spark, sf).where(F.col("date_received").between(flags.as_date("1995-01-01"), flags.as_date("2000-12-31")))
    return df.withColumn("company_name_normalized", text.normalize_name(F.col("company_name"), ".,;:"))


def staged(spark: SparkSession, sf: str) -> DataFrame:
    """Cleaned complaints before any lookup."""
    return facts.clean_fields(raw(spark, sf), given.SETTINGS.full_years)


def bank_rows(spark: SparkSession, sf: str) -> DataFrame:
    return facts.clean_banks(given.raw_banks(spark, sf))


def analysis_era(date: str) -> Column:
    return flags.bucketize(F.col(date), [flags.as_date(c) for c in ANALYSIS_CUTS], ANALYSIS_LABELS, op="<")


# --- end products -------------------------------------------------------------------------


@query
def bank_metrics(spark, sf):
    return models(spark, sf).bank_metrics.orderBy(F.desc("complaints_per_billion_assets"))


@query
def complaint_staging(spark, sf):
    return models(spark, sf).complaints


@query
def complaint_fact(spark, sf):
    return models(spark, sf).fact


@query
def company_dim(spark, sf):
    return models(spark, sf).companies


@query
def holder_rollup(spark, sf):
    return models(spark, sf).holders


@query
def bank_dim(spark, sf):
    return models(spark, sf).bank_dim


@query
def date_dim(spark, sf):
    return dims.date_dim(dims.date_spine_over(raw(spark, sf), "date_received"))


@query
def time_spine(spark, sf):
    return dims.time_spine(dims.date_dim(dims.date_spine_over(raw(spark, sf), "date_received")))


@query
def monthly_components(spark, sf):
    return models(spark, sf).monthly


#: Complaints received later than this come as changes.
FIRST_LOAD_END = "1998-02-28"


def complaint_changes(spark: SparkSession, sf: str) -> tuple[DataFrame, list[dict[int, DataFrame]]]:
    """Raw complaints of a first load, and two feeds of later, amended and repeated ones by version."""
    feed = raw(spark, sf)
    number = F.col("complaint_id").cast("long")
    late = feed.where(F.col("date_received") > flags.as_date("1997-12-31"))
    amended = late.where(number % 3 == 0).withColumns({
        # moved to another month, to another company, and to another category
        "date_received": F.when(number % 7 == 0, F.date_add("date_received", 25)).otherwise(F.col("date_received")),
        "company_name": F.when(number % 5 == 0, F.lit("Nation 9 Holdings")).otherwise(F.col("company_name")),
        "product": F.when(number % 4 == 0, F.lit("Mortgage")).otherwise(F.col("product")),
    })
    again = amended.where(number % 2 == 0).withColumns(
        {"timely_response": F.lit(False), "company_name": F.lit("Nation 24 Holdings")})
    return feed.where(F.col("date_received") <= flags.as_date(FIRST_LOAD_END)), [{1: late, 2: amended}, {3: again}]


def versioned_fact(spark: SparkSession, sf: str, complaints: dict[int, DataFrame]) -> DataFrame:
    """The fact of raw complaints, given by version."""
    ours = models(spark, sf)
    facts_by_version = [
        Models(spark, ours.inputs, given.SETTINGS, complaints=facts.clean_complaints(
            rows, ours.inputs.product_map, ours.inputs.subproduct_map, ours.inputs.issue_map, given.SETTINGS.full_years),
        ).fact.withColumn("version", F.lit(version))
        for version, rows in complaints.items()
    ]
    return reduce(DataFrame.unionByName, facts_by_version)


@query
def monthly_maintained(spark, sf):
    """The monthly mart after two sets of upserts, from the first load's cells and the changes alone."""
    loaded, feeds = complaint_changes(spark, sf)
    existing = versioned_fact(spark, sf, {0: loaded})
    cells = maintain.component_cells(existing)
    upsert = ("complaint_id", "date_received", 30, "version")
    for feed in feeds:
        delta = versioned_fact(spark, sf, feed)
        cells = maintain.apply_changes(cells, maintain.upsert_changes(existing, delta, *upsert))
        existing = history.upsert_lookback(existing, delta, *upsert)
    return marts.components_of(cells, models(spark, sf).bank_dim)


@query
def rollup_from_components(spark, sf):
    return marts.rollup_components(models(spark, sf).monthly, ["bank_size_bucket", "product_category"])


#: Period and dimensions of each rollup that one read of the fact answers.
GRAINS = [
    ("day", []), ("month", []), ("quarter", []), ("year", []), ("all", []),
    ("month", ["product_category"]), ("quarter", ["product_category", "category"]), ("year", ["category"]),
    ("year", ["state"]), ("all", ["product_category", "state"]), ("all", ["category"]),
]


@query
def many_grains(spark, sf):
    """Measures and rates at eleven grains, from one read and one fold of the fact."""
    return grains.many_grains(models(spark, sf).fact, GRAINS)


@query
def lag_rollup(spark, sf):
    """Quantiles of the lag by tier, category and quarter from sketches of the months, beside the exact ones."""
    m = models(spark, sf)
    tiers = m.bank_dim.select("company_sk", "bank_size_bucket")
    months = sketches.lag_cells(m.fact.withColumn("month_start", F.trunc("date_received", "month")), ["company_sk", "month_start", "product_category"])
    by = ["bank_size_bucket", "product_category", "quarter_start"]
    found = sketches.quantiles(months.join(tiers, "company_sk").withColumn("quarter_start", F.trunc("month_start", "quarter")), by)
    counted = m.fact.groupBy("company_sk", "product_category", F.trunc("date_received", "quarter").alias("quarter_start"), "days_to_company").count()
    return sketches.judged(found, counted.join(tiers, "company_sk"), by, "days_to_company", weight="count")


def company_cells(spark: SparkSession, sf: str) -> DataFrame:
    """Companies complained about, sketched for each month and product category."""
    fact = models(spark, sf).fact.withColumn("month_start", F.trunc("date_received", "month"))
    return sketches.distinct_cells(fact, "company_name_normalized", ["month_start", "product_category"])


@query
def distinct_rollup(spark, sf):
    """Companies complained about by quarter and category, from sketches of the months."""
    cells = company_cells(spark, sf).withColumn("quarter_start", F.trunc("month_start", "quarter"))
    return sketches.distinct(cells, ["quarter_start", "product_category"])


CATEGORY_PAIRS = [("mortgage", "banking"), ("card", "banking"), ("credit_reporting", "debt_collection"), ("payments", "mortgage")]


@query
def distinct_common(spark, sf):
    """Companies complained about in both of two categories, and in the first of them only."""
    return sketches.common(company_cells(spark, sf), "product_category", CATEGORY_PAIRS)


@query
def ranked_complaints(spark, sf):
    """Every complaint's rank and share by lag and date, and the days that all up to it add up to."""
    feed = raw(spark, sf).select("complaint_id", "date_received", F.datediff("date_sent_to_company", "date_received").alias("days"))
    return ordered.ranked(feed, {"days": False, "date_received": True}, ["days"])


@query
def ranked_banks(spark, sf):
    """Every institution by offices: rank, share, and running assets; many have as many offices, some none known."""
    return ordered.ranked(given.raw_banks(spark, sf).select("fdic_certificate_number", "offices_count", "total_assets"), {"offices_count": True}, ["total_assets"])


@query
def tier_rollup(spark, sf):
    return marts.tier_rollup(models(spark, sf).bank_metrics)


@query
def category_comparison(spark, sf):
    return marts.category_comparison(models(spark, sf).fact)


@query
def quarterly_category_feed(spark, sf):
    return marts.volume_feed(models(spark, sf).fact)


@query
def top20_by_category(spark, sf):
    return marts.top_companies(models(spark, sf).fact, 20)


# --- sources and staging ------------------------------------------------------------------


@query
def lean_table(spark, sf):
    documents = table(spark, sf, "documents").withColumn("text", F.when(F.col("lang") != "de", F.col("text")))
    return materialize_lean(documents, drop=["text"], presence_flags={"has_text": "text"})


@query
def schema_listing(spark, sf):
    return describe_schema({name: table(spark, sf, name) for name in ("customer", "orders")}, with_rows=True)


def scratch(spark: SparkSession) -> str:
    """A new path in the folder all executors share."""
    return f"{shared_folder(spark)}/given-{uuid.uuid4().hex}"


@query
def complaints_read(spark, sf):
    """The feed written by month and read back under its declared schema."""
    feed, path = raw(spark, sf), scratch(spark)
    save(feed.withColumn("month_start", F.trunc("date_received", "month")), path, "overwrite", ["month_start"])
    return read_complaints(spark, path).select(*feed.columns)


@query
def banks_read(spark, sf):
    banks, path = given.raw_banks(spark, sf), scratch(spark)
    save(banks, path, "overwrite")
    return read_banks(spark, path).select(*banks.columns)


@query
def seed_read(spark, sf):
    """A lookup written as CSV with a header and read back, empty fields as NULL."""
    crosswalk, path = given.supplier_crosswalk(spark, sf), scratch(spark)
    crosswalk.write.option("header", True).option("ignoreLeadingWhiteSpace", False).option(
        "ignoreTrailingWhiteSpace", False).option("escape", '"').csv(path)
    return read_seed(spark, path, schemas.CROSSWALK)


@query
def bank_staging(spark, sf):
    return bank_rows(spark, sf)


@query
def crosswalk_staging(spark, sf):
    return facts.clean_crosswalk(given.supplier_crosswalk(spark, sf))


# --- row-level cleaning -------------------------------------------------------------------


@query
def name_normalized(spark, sf):
    name = F.col("company_name")
    return raw(spark, sf).select(
        "complaint_id",
        text.trim(name).alias("company_name"),
        text.normalize_name(name).alias("company_name_normalized"),
        text.normalize_name(name, ".,;:").alias("company_name_profiled"),
    )


@query
def code_clean(spark, sf):
    code = text.clean_code(F.col("state"), D.STATE_ALIASES, 2, D.NOT_PROVIDED)
    return raw(spark, sf).select("complaint_id", code.alias("state"))


@query
def zip_clean(spark, sf):
    zip_code = F.col("zip_code")
    cleaned = raw(spark, sf).select(
        "complaint_id",
        text.clean_zip(zip_code).alias("zip_code"),
        text.clean_zip(zip_code, keep_privacy_prefix=True).alias("zip_code_private"),
    )
    return cleaned.withColumn("zip_code_is_valid", text.zip_is_valid(F.col("zip_code")))


@query
def tag_flags(spark, sf):
    tags = F.col("tags")
    return raw(spark, sf).select(
        "complaint_id", text.trim(tags).alias("tags"),
        *[text.tag_flag(tags, tag).alias(flag) for flag, tag in D.TAGS.items()],
    )


@query
def sentinels_relabel(spark, sf):
    return staged(spark, sf).select(
        "complaint_id", "company_response_to_consumer", "company_public_response", "consumer_consent_provided"
    )


@query
def display_name(spark, sf):
    name = text.display_name(F.col("top_holder"), D.HOLDER_REPLACEMENTS, D.HOLDER_SUFFIX)
    return bank_rows(spark, sf).select("fdic_cert", "top_holder", name.alias("top_holder_normalized"))


@query
def legal_suffix_strip(spark, sf):
    return bank_rows(spark, sf).select(
        "fdic_cert",
        text.strip_legal_suffixes(F.col("top_holder"), D.LEGAL_SUFFIXES).alias("holder_stripped"),
        text.strip_legal_suffixes(F.col("institution_name"), D.LEGAL_SUFFIXES).alias("institution_stripped"),
    )


def part_firms(spark: SparkSession, sf: str) -> DataFrame:
    """Parts renamed as firms of several trades."""
    trade = F.expr("""
        case p_size % 7 when 0 then 'Mortgage' when 1 then 'Student Loan' when 2 then 'Recovery'
                        when 3 then 'Toyota' when 4 then 'PayPal' when 5 then 'Savings' else 'Trading' end""")
    firm = F.upper(F.concat_ws(" ", F.col("p_name"), trade, F.col("p_brand")))
    return table(spark, sf, "part").select("p_partkey", firm.alias("firm"))


@query
def regex_classify(spark, sf):
    return part_firms(spark, sf).select(
        "p_partkey", "firm", text.classify_regex(F.col("firm"), D.IMPLIED_CATEGORIES, "other").alias("implied_category")
    )


@query
def zip_pattern(spark, sf):
    return staged(spark, sf).select(
        "complaint_id", text.zip_pattern(F.col("zip_code"), D.ZIP_PATTERNS).alias("zip_pattern")
    )


# --- flags and buckets --------------------------------------------------------------------


@query
def era_flags(spark, sf):
    date = F.col("date_received")
    return raw(spark, sf).select(
        "complaint_id",
        "date_received",
        flags.era_flag(date, given.SETTINGS.dispute_era).alias("is_dispute_era"),
        flags.era_flag(date, given.SETTINGS.narrative_era).alias("is_narrative_era"),
    )


@query
def lag_bucket(spark, sf):
    days = flags.days_between_clamped(F.col("date_received"), F.col("date_sent_to_company"))
    return raw(spark, sf).select("complaint_id", days.alias("days_to_company")).withColumn(
        "days_to_company_bucket", flags.bucketize(F.col("days_to_company"), D.LAG_CUTS, D.LAG_LABELS)
    )


@query
def category_buckets(spark, sf):
    return models(spark, sf).fact.select(
        "complaint_id", "product_normalized", "product_category", "response_category", "had_monetary_relief"
    )


@query
def asset_tier(spark, sf):
    return models(spark, sf).holders.select(
        "top_holder", "total_assets_usd", "bank_size_bucket", "bank_size_rank", "offices_count", "is_branchless"
    )


@query
def full_year_flag(spark, sf):
    return staged(spark, sf).select(
        "complaint_id", "has_full_year_data", analysis_era("date_received").alias("analysis_era")
    )


# --- lookups ------------------------------------------------------------------------------


@query
def map_taxonomy(spark, sf):
    mapped = apply_mapping(staged(spark, sf), given.product_map(spark), {"product": "raw_product"},
                           "product_normalized", "product_normalized", default=F.col("product"))
    return mapped.select("complaint_id", "product", "product_normalized")


@query
def map_composite_null(spark, sf):
    return facts.map_subproducts(staged(spark, sf), given.subproduct_map(spark)).select(
        "complaint_id", "product", "subproduct", "subproduct_normalized"
    )


@query
def map_default(spark, sf):
    return facts.map_issues(staged(spark, sf), given.issue_map(spark)).select(
        "complaint_id", "issue", "issue_category"
    )


@query
def map_override(spark, sf):
    return facts.map_products(staged(spark, sf), given.product_map(spark)).select(
        "complaint_id", "product", "subproduct", "product_normalized"
    )


# --- entities -----------------------------------------------------------------------------


@query
def entity_resolve(spark, sf):
    crosswalk = facts.clean_crosswalk(given.raw_crosswalk(spark, sf))
    return entity.resolve_entities(staged(spark, sf), crosswalk).select(
        "complaint_id", "company_name_normalized", "canonical_name", "category", "company_parent_as_of",
        "is_crosswalked", "company_sk",
    )


@query
def entity_coverage(spark, sf):
    m = models(spark, sf)
    return entity.enrichment_coverage(m.fact, m.companies, "category", "company_sk", "fdic_top_holder")


@query
def match_rate(spark, sf):
    """All complaints, raw names against top holders and institution names."""
    banks = bank_rows(spark, sf)
    refs = {"top_holder": (banks, "top_holder"), "institution": (banks, "institution_name")}
    return entity.match_rate(raw(spark, sf), refs, "company_name")


@query
def match_status(spark, sf):
    banks = models(spark, sf).companies.where(F.col("category") == "bank")
    return entity.match_status(banks, bank_rows(spark, sf), "fdic_top_holder", "top_holder",
                               ["canonical_name", "fdic_top_holder"])


@query
def unmatched_top(spark, sf):
    banks = bank_rows(spark, sf)
    return entity.unmatched(raw(spark, sf), [(banks, "top_holder"), (banks, "institution_name")], "company_name", 50)


@query
def suffix_match_report(spark, sf):
    companies = models(spark, sf).companies.withColumn(
        "fdic_top_holder", F.concat(F.col("fdic_top_holder"), F.lit(", Inc.")))
    return entity.suffix_match_report(companies, bank_rows(spark, sf), "fdic_top_holder", "top_holder",
                                      "total_assets", D.LEGAL_SUFFIXES)


@query
def token_scan(spark, sf):
    return entity.token_scan(bank_rows(spark, sf), ["top_holder", "institution_name"], "NATION 1", "total_assets", 20)


@query
def implied_composition(spark, sf):
    trade = F.expr("""
        case l_suppkey % 7 when 0 then 'MORTGAGE' when 1 then 'STUDENT LOAN' when 2 then 'COLLECTION'
                           when 3 then 'HONDA' when 4 then 'VENMO' when 5 then 'SAVINGS' else 'TRADING' end""")
    firms = table(spark, sf, "lineitem").select(F.concat_ws(" ", trade, F.col("l_suppkey")).alias("firm"))
    return entity.composition(firms, "firm", D.IMPLIED_CATEGORIES)


@query
def name_union(spark, sf):
    banks = bank_rows(spark, sf)
    return entity.name_union((banks, "top_holder"), (banks, "institution_name"))


# --- metrics ------------------------------------------------------------------------------


def metric_tables(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """The fact and the bank mart, both lazy; callers with stored models pass those instead."""
    m = models(spark, sf)
    return {"complaints": m.fact, "banks": m.bank_metrics}


def complaint_tables(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return {"complaints": models(spark, sf).fact}


@query
def metric_simple(spark, sf):
    return metric(complaint_tables(spark, sf), "complaint_count", by=["product_category"], grain="quarter")


@query
def metric_timely_count(spark, sf):
    return metric(complaint_tables(spark, sf), "timely_response_count", by=["submitted_via"])


@query
def metric_disputed_count(spark, sf):
    return metric(complaint_tables(spark, sf), "disputed_count", by=["state"])


@query
def metric_narrative_count(spark, sf):
    return metric(complaint_tables(spark, sf), "narrative_count", by=["tags_is_servicemember"], grain="year")


@query
def metric_avg_days(spark, sf):
    return metric(metric_tables(spark, sf), "avg_days_to_company", by=["company__bank_size_bucket"], grain="year")


@query
def metric_total_assets(spark, sf):
    return metric(metric_tables(spark, sf), "total_assets_billions", by=["company__is_branchless"])


@query
def metric_ratio(spark, sf):
    return metric(complaint_tables(spark, sf), "timely_response_rate", by=["category"], grain="month")


@query
def metric_ratio_era(spark, sf):
    return metric(complaint_tables(spark, sf), "dispute_rate", by=["product_category"])


@query
def metric_ratio_narrative(spark, sf):
    return metric(complaint_tables(spark, sf), "narrative_rate", grain="quarter")


@query
def metric_mom(spark, sf):
    return metric(complaint_tables(spark, sf), "complaint_count_mom_pct_change", by=["category"], grain="month")


@query
def metric_yoy(spark, sf):
    return metric(complaint_tables(spark, sf), "complaint_count_yoy_pct_change", grain="quarter")


@query
def metric_per_billion(spark, sf):
    return metric(metric_tables(spark, sf), "complaints_per_billion_assets", by=["company__bank_size_bucket"])


@query
def metric_per_billion_total(spark, sf):
    return metric(metric_tables(spark, sf), "complaints_per_billion_assets", restrict_to_matched=True)


@query
def metric_by_entity_dim(spark, sf):
    return metric(metric_tables(spark, sf), "complaint_count",
                  by=["company__primary_specialization", "product_category"], where="has_full_year_data")


@query
def metric_over_spine(spark, sf):
    daily = metric(complaint_tables(spark, sf), "complaint_count", grain="day")
    return over_spine(daily, dims.date_spine_over(raw(spark, sf), "date_received"), "day")


@query
def metric_over_spine_by(spark, sf):
    """Every month for every state and product category that occur together, also those without complaints."""
    by = ["state", "product_category"]
    monthly = metric(complaint_tables(spark, sf), "complaint_count", by=by, grain="month")
    return over_spine(monthly, dims.date_spine_over(raw(spark, sf), "date_received"), "month", by)


# --- checks -------------------------------------------------------------------------------


@query
def check_not_null(spark, sf):
    return checks.not_null(raw(spark, sf), "date_sent_to_company", "not timely_response").select(
        "complaint_id", "date_received")


@query
def check_unique(spark, sf):
    return checks.unique(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def check_accepted(spark, sf):
    return checks.accepted(staged(spark, sf), "submitted_via", INTAKE_CHANNELS)


@query
def check_relationship(spark, sf):
    parents = table(spark, sf, "customer").where(F.col("c_mktsegment") != "BUILDING")
    return checks.relationship(table(spark, sf, "orders"), "o_custkey", parents, "c_custkey")


@query
def check_dates_ordered(spark, sf):
    return checks.ordered(raw(spark, sf), "date_received", "date_sent_to_company",
                          after=given.SETTINGS.intake_artifact_end).select(
        "complaint_id", "date_received", "date_sent_to_company")


@query
def check_coverage(spark, sf):
    return checks.coverage(models(spark, sf).resolved, "is_crosswalked", 95.0)


@query
def check_era_null(spark, sf):
    return checks.null_outside_era(raw(spark, sf), "consumer_disputed", given.SETTINGS.dispute_era).select(
        "complaint_id", "date_received", "consumer_disputed")


@query
def check_no_fanout(spark, sf):
    """A crosswalk with a duplicated name fans the fact out."""
    crosswalk = facts.clean_crosswalk(given.raw_crosswalk(spark, sf))
    doubled = crosswalk.unionByName(history.known_changes(crosswalk))
    complaints = staged(spark, sf)
    return checks.same_count(complaints, entity.resolve_entities(complaints, doubled), "staging_n", "int_n")


@query
def check_range(spark, sf):
    return checks.in_range(models(spark, sf).bank_metrics, ["timely_response_rate", "dispute_rate"], 0.32, 0.67).select(
        "canonical_name", "timely_response_rate", "dispute_rate")


@query
def check_coherence(spark, sf):
    """Filling undefined numerators with 0 breaks the coherence of the components."""
    filled = models(spark, sf).monthly.withColumn("disputed_count", F.coalesce("disputed_count", F.lit(0)))
    pairs = [("disputed_count", "complaint_count_dispute_era"), ("narrative_count", "complaint_count_narrative_era")]
    return checks.coherent(filled, pairs).select(
        "canonical_name", "month_start", "product_category", "complaint_count_dispute_era", "disputed_count",
        "complaint_count_narrative_era", "narrative_count")


@query
def check_totals(spark, sf):
    """The monthly mart without one category no longer adds up to the fact."""
    m = models(spark, sf)
    return checks.same_total(m.monthly.where(F.col("product_category") != "other"), F.sum("complaint_count"),
                             m.universe_fact, F.count("*"), "monthly_n", "fct_n")


@query
def check_grain(spark, sf):
    return checks.unique(models(spark, sf).monthly, ["canonical_name", "product_category"])


@query
def check_summary(spark, sf):
    """All checks over the model graph, written to the shared folder for it: every table is read once."""
    return store_checked(spark, given.GivenInputs(spark, sf), scratch(spark), given.SETTINGS)[1]


# --- history ------------------------------------------------------------------------------


def customer_versions(spark: SparkSession, sf: str) -> DataFrame:
    """Customer history after a first load, one set of edits, and the same edits merged again."""
    first = table(spark, sf, "customer").where(F.col("c_acctbal") < 9000)
    segment = F.col("c_mktsegment")
    second = table(spark, sf, "customer").where(F.col("c_acctbal") > 0).withColumns({
        "c_mktsegment": F.when((segment == "MACHINERY") & (F.col("c_nationkey") < 5), "BUILDING")
                         .when((segment == "FURNITURE") & (F.col("c_nationkey") < 2), F.lit(None)).otherwise(segment),
        "c_name": F.when(segment == "HOUSEHOLD", F.upper("c_name")).otherwise(F.col("c_name")),
    })
    checked = ["c_mktsegment", "c_nationkey"]
    opened = history.scd2_merge(None, first, "c_custkey", checked, "2020-01-01 00:00:00")
    return history.scd2_merge(opened, second, "c_custkey", checked, "2021-06-01 00:00:00")


def as_dates(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("date") for c in ("valid_from", "valid_to", "updated_at")})


@query
def scd2_merge(spark, sf):
    return as_dates(customer_versions(spark, sf))


@query
def scd2_as_of(spark, sf):
    return as_dates(history.scd2_as_of(customer_versions(spark, sf), "2020-12-31 00:00:00"))


def company_feeds(spark: SparkSession, sf: str) -> list[tuple[DataFrame, str]]:
    """Crosswalk versions and when they come: an edit of the category alone opens none."""
    first = facts.clean_crosswalk(given.supplier_crosswalk(spark, sf))
    second = first.withColumns({
        "canonical_name": F.when(F.col("category") == "fintech", F.concat("canonical_name", F.lit(" Digital")))
                           .otherwise(F.col("canonical_name")),
        "category": F.when(F.col("category") == "bank", "regional bank").otherwise(F.col("category")),
    })
    third = second.withColumn("fdic_top_holder", F.when(F.col("parent_as_of").isNull(), F.col("fdic_top_holder")))
    return [(first, "2020-01-01 00:00:00"), (second, "2021-01-01 00:00:00"), (third, "2022-01-01 00:00:00")]


COMPANY_CHECKED = ["canonical_name", "fdic_top_holder"]


@query
def company_history(spark, sf):
    """Crosswalk versions by canonical name and holder."""
    kept = None
    for feed, at in company_feeds(spark, sf):
        kept = history.scd2_merge(kept, feed, "raw_company_name", COMPANY_CHECKED, at)
    return as_dates(kept)


@query
def company_history_stored(spark, sf):
    """The same history as a stored table, each feed merged into the rows in force; the last one comes twice."""
    path, (first, *later) = scratch(spark), company_feeds(spark, sf)
    versions.create_history(first[0], path, "raw_company_name", COMPANY_CHECKED, first[1])
    for feed, at in [*later, later[-1]]:
        versions.merge_history(feed, path, "raw_company_name", COMPANY_CHECKED, at)
    return as_dates(versions.read_history(spark, path))


def name_versions(spark: SparkSession, sf: str) -> DataFrame:
    """A history of the crosswalk: renamed and closed companies, gaps, and versions that overlap."""
    crosswalk = facts.clean_crosswalk(given.raw_crosswalk(spark, sf))
    number = F.regexp_extract("raw_company_name", r"(\d+)", 1).cast("int")

    def version(label: str, valid_from: str, valid_to: str | None, which: Column) -> Column:
        return F.when(which, F.struct(
            F.lit(label).alias("version"),
            F.lit(valid_from).cast("timestamp").alias("valid_from"),
            F.lit(valid_to).cast("timestamp").alias("valid_to")))

    versions = F.array_compact(F.array(
        version("first", "1992-06-01", "1996-07-01", number % 3 == 0),
        version("first", "1992-06-01", None, number % 3 != 0),
        version("second", "1996-07-01", "1997-03-01", number % 3 == 0),
        version("third", "1997-06-01", None, number % 6 == 0),
        version("side", "1996-01-01", "1997-12-31", number % 7 == 0)))
    return crosswalk.select("raw_company_name", "canonical_name", F.inline(versions))


@query
def as_of_join(spark, sf):
    """Every complaint with the version of its company's name that was in force when it was received."""
    normalised = text.normalize_name(F.col("company_name"))
    rows = raw(spark, sf).select("complaint_id", "date_received", normalised.alias("raw_company_name"))
    return asof.as_of_join(rows, name_versions(spark, sf), "raw_company_name", "date_received", ["version", "canonical_name"])


@query
def known_rebrands(spark, sf):
    return history.known_changes(facts.clean_crosswalk(given.supplier_crosswalk(spark, sf)))


@query
def upsert_lookback(spark, sf):
    events = table(spark, sf, "events").select(
        "event_id", F.col("ts").cast("date").alias("day"), "event_type", "value", F.lit(1).alias("version"))
    stored = events.where(F.col("day") <= flags.as_date("2024-01-20")).drop("event_type")
    late = events.where(F.col("day") > flags.as_date("2024-01-10"))
    amended = late.where(F.col("event_type") == "purchase").withColumns(
        {"version": F.lit(2), "value": F.col("value") * 2})
    return history.upsert_lookback(stored, late.unionByName(amended), "event_id", "day", 7, "version")


@query
def schema_append(spark, sf):
    events = table(spark, sf, "events").select(
        "event_id", F.col("ts").cast("date").alias("day"), "event_type", "value", "props")
    cut = flags.as_date("2024-01-15")
    return history.append_columns(events.where(F.col("day") < cut).drop("props"), events.where(F.col("day") >= cut))


@query
def freshness(spark, sf):
    return history.freshness(table(spark, sf, "events"), "ts", "2024-02-10", 7, 14)


# --- profiling ----------------------------------------------------------------------------


@query
def shape(spark, sf):
    return profile.shape(
        raw(spark, sf),
        distinct={"distinct_companies": "company_name", "distinct_products": "product",
                  "distinct_subproducts": "subproduct", "distinct_issues": "issue", "distinct_states": "state"},
        true_flags={"has_narrative": "has_narrative"},
        filled={"has_disputed": "consumer_disputed", "has_sent_date": "date_sent_to_company",
                "has_public_response": "company_public_response", "has_tags": "tags"},
        date="date_received",
    )


@query
def column_profile(spark, sf):
    return profile.column_profile(raw(spark, sf))


@query
def recent_sample(spark, sf):
    return profile.recent(raw(spark, sf), "date_received", 20, "complaint_id")


@query
def distribution_pct(spark, sf):
    return profile.distribution(raw(spark, sf), "state", date="date_received")


@query
def source_distribution(spark, sf):
    return profile.distribution(table(spark, sf, "documents"), "source")


@query
def null_bucket_counts(spark, sf):
    return profile.value_counts(raw(spark, sf), ["tags"])


@query
def multi_field_counts(spark, sf):
    fields = ["company_response_to_consumer", "company_public_response", "consumer_consent_provided"]
    return profile.value_counts(raw(spark, sf), fields, null_label=None)


@query
def cooccurrence(spark, sf):
    tokens = {"n_servicemember": "Servicemember", "n_older_american": "Older American"}
    return profile.cooccurrence(raw(spark, sf), "tags", tokens)


@query
def topk_entities(spark, sf):
    return profile.top_entities(raw(spark, sf), "company_name", "date_received", "product", 50)


@query
def entity_list(spark, sf):
    items = table(spark, sf, "lineitem").withColumn("shipped", F.col("l_shipdate").cast("date"))
    return profile.entity_list(items, "l_partkey", "shipped", "l_suppkey")


@query
def pareto(spark, sf):
    return profile.pareto(table(spark, sf, "lineitem"), "l_partkey")


@query
def pareto_issues(spark, sf):
    return profile.pareto(raw(spark, sf), "issue")


@query
def pareto_top(spark, sf):
    return profile.pareto_top(names(spark, sf), "company_name_normalized", 100)


@query
def size_histogram(spark, sf):
    return profile.size_histogram(table(spark, sf, "lineitem"), "l_orderkey", D.GROUP_SIZE_CUTS, D.GROUP_SIZE_LABELS)


@query
def rate_by_entity(spark, sf):
    return profile.rate_by(names(spark, sf), ["company_name_normalized"], "timely_response", min_n=100, k=100)


@query
def yearly_fill(spark, sf):
    return profile.fill_by_period(
        raw(spark, sf),
        F.year("date_received"),
        filled={"disputed_known": "consumer_disputed", "public_response": "company_public_response"},
        true_flags={"with_narrative": "has_narrative"},
        distinct={"distinct_companies": "company_name"},
    )


def lags(spark: SparkSession, sf: str, exact: bool) -> DataFrame:
    return profile.lag_quantiles(names(spark, sf), "date_received", "date_sent_to_company",
                                 analysis_era("date_received"), exact=exact)


@query
def lag_quantiles(spark, sf):
    return lags(spark, sf, exact=True)


@query
def lag_quantiles_approx(spark, sf):
    return lags(spark, sf, exact=False)


@query
def crosstab(spark, sf):
    return profile.crosstab(raw(spark, sf), "product", "subproduct")


@query
def crosstab_issues(spark, sf):
    return profile.crosstab(raw(spark, sf), "issue", "subissue")


@query
def frequent_semi(spark, sf):
    return profile.frequent_crosstab(table(spark, sf, "lineitem"), "l_returnflag", "l_partkey", 30)


@query
def rate_by_year(spark, sf):
    days = F.col("date_received")
    since = raw(spark, sf).where(days.between(flags.as_date("1996-06-01"), flags.as_date("2000-12-31")))
    return profile.rate_by(since, [F.year("date_received").alias("year"), "product"], "has_narrative")


@query
def violations_by_size(spark, sf):
    return profile.violations_by(raw(spark, sf), "date_received", "date_sent_to_company")


@query
def violations_by_entity(spark, sf):
    return profile.violations_by(staged(spark, sf), "date_received", "date_sent_to_company",
                                 by=[F.year("date_received").alias("year"), "company_name_normalized"], k=30)


@query
def null_by_status(spark, sf):
    return profile.nulls_by_status(raw(spark, sf), "date_sent_to_company", "company_response_to_consumer",
                                   always="In progress")


@query
def zip_pattern_summary(spark, sf):
    return profile.pattern_summary(staged(spark, sf), "zip_code", D.ZIP_PATTERNS)


@query
def invalid_drill(spark, sf):
    return profile.invalid_values(staged(spark, sf), "zip_code", text.FIVE_DIGITS, 100)


@query
def residue_counts(spark, sf):
    mapped = apply_mapping(staged(spark, sf), given.product_map(spark).where("raw_product <> 'Payday loan'"),
                           {"product": "raw_product"}, "product_normalized", "product_normalized",
                           default=F.col("product"))
    return profile.residue(mapped, "product_normalized", D.LEGACY_PRODUCTS)


@query
def normalized_crosstab(spark, sf):
    loans = models(spark, sf).complaints.where(F.col("product") == "Consumer Loan")
    return profile.crosstab(loans, "product_normalized", "subproduct_normalized")


@query
def subproducts_per_product(spark, sf):
    return models(spark, sf).fact.groupBy("product_normalized").agg(
        F.count_distinct("subproduct_normalized").alias("subproduct_count"))


@query
def largest_institutions(spark, sf):
    return profile.largest(bank_rows(spark, sf), "total_assets", 50,
                           ["institution_name", "top_holder", "fdic_cert", "state", "city", "total_assets"],
                           tie="fdic_cert")


@query
def largest_parents(spark, sf):
    return profile.largest_parents(bank_rows(spark, sf), "top_holder", "total_assets", 50)


@query
def normalize_preview(spark, sf):
    return profile.normalize_preview(bank_rows(spark, sf), "top_holder", "total_assets", 30,
                                     D.HOLDER_REPLACEMENTS, D.HOLDER_SUFFIX)


@query
def tier_preview(spark, sf):
    banks = models(spark, sf).companies.where(F.col("category") == "bank")
    return profile.tier_preview(banks, bank_rows(spark, sf), "fdic_top_holder", "top_holder",
                                D.PREVIEW_ASSET_CUTS, D.PREVIEW_ASSET_LABELS)
