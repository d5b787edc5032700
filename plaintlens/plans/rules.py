"""The checks declared for the models, as rules that are evaluated together.

Row-preserving models (cleaned, resolved, fact) are checked on the fact, which has their columns; that
they keep the rows of the feed is a check of its own.
"""

from __future__ import annotations

from plaintlens import defaults as D
from plaintlens.operators import fused as Q
from plaintlens.operators.fused import Rule

HELD = "fdic_top_holder is not null"

#: model: (table it is checked on, columns that must be there)
REQUIRED = {
    "complaints": ("fact", [
        "complaint_id", "date_received", "date_sent_to_company", "product", "product_normalized", "state",
        "submitted_via", "company_response_to_consumer", "company_public_response", "consumer_consent_provided",
        "timely_response", "has_narrative", "has_full_year_data"]),
    "resolved": ("fact", ["complaint_id", "is_crosswalked"]),
    "fact": ("fact", ["complaint_id", "issue_category", "days_to_company_bucket", "response_category"]),
    "crosswalk": ("crosswalk", ["raw_company_name", "canonical_name", "category"]),
    "holders": ("holders", [
        "top_holder", "top_holder_normalized", "charter_count", "total_assets_usd", "bank_size_bucket"]),
    "companies": ("companies", ["company_sk", "canonical_name", "category"]),
    "bank_dim": ("bank_dim", ["company_sk", "canonical_name"]),
    "dates": ("dates", ["date_day"]),
    "bank_metrics": ("bank_metrics", ["company_sk", "canonical_name", "complaints_per_billion_assets"]),
    "monthly": ("monthly", ["company_sk", "canonical_name", "month_start", "product_category", "complaint_count"]),
    "banks": ("banks", ["fdic_cert"]),
}

#: model: columns without repeated values
UNIQUE = {
    "complaints": ["complaint_id"], "resolved": ["complaint_id"], "fact": ["complaint_id"], "banks": ["fdic_cert"],
    "crosswalk": ["raw_company_name"], "holders": ["top_holder"], "companies": ["company_sk", "canonical_name"],
    "bank_dim": ["company_sk"], "dates": ["date_day"], "bank_metrics": ["company_sk", "canonical_name"],
}

CATEGORIES = [*D.PRODUCT_CATEGORIES.values(), "other"]
RESPONSES = ["relief", "explanation_only", "other"]


#: model, column, accepted values, rows concerned, severity
LISTED = [
    ("complaints", "product", D.PRODUCTS, None, "warn"),
    ("complaints", "state", D.STATES, None, "error"),
    ("complaints", "submitted_via", D.CHANNELS, None, "warn"),
    ("resolved", "category", D.COMPANY_CATEGORIES, "is_crosswalked", "error"),
    ("crosswalk", "category", D.COMPANY_CATEGORIES, None, "error"),
    ("companies", "category", D.COMPANY_CATEGORIES, None, "error"),
    ("fact", "issue_category", D.ISSUE_CATEGORIES, None, "error"),
    ("fact", "days_to_company_bucket", D.LAG_LABELS, None, "error"),
    ("fact", "response_category", RESPONSES, None, "error"),
    ("monthly", "product_category", CATEGORIES, None, "error"),
    ("bank_dim", "bank_size_bucket", D.ASSET_LABELS, HELD, "error"),
]


def declared_rules() -> list[Rule]:
    """What each model's columns are declared to be."""
    of = {model: table for model, (table, _) in REQUIRED.items()}
    rules = [
        Q.not_null(f"{model}.{column}.not_null", table, column)
        for model, (table, columns) in REQUIRED.items() for column in columns
    ]
    rules += [
        Q.not_null("bank_dim.total_assets_usd.not_null", "bank_dim", "total_assets_usd", HELD),
        Q.not_null("bank_dim.bank_size_bucket.not_null", "bank_dim", "bank_size_bucket", HELD),
        Q.not_null("banks.total_assets.not_null", "banks", "total_assets", "top_holder is not null"),
    ]
    rules += [Q.unique(f"{model}.{c}.unique", of[model], [c]) for model, columns in UNIQUE.items() for c in columns]
    rules += [Q.accepted(f"{m}.{c}.accepted", of[m], c, values, where, severity) for m, c, values, where, severity in LISTED]
    return [
        *rules,
        Q.relationship("fact.company_sk.companies", "fact", "company_sk", "companies", "company_sk"),
        Q.relationship("monthly.company_sk.bank_dim", "monthly", "company_sk", "bank_dim", "company_sk"),
    ]


def invariants(artifact_end: str, coverage_floor: float = 74.0) -> list[Rule]:
    """What holds within and between the models."""
    coherent = " or ".join(
        f"({part} is null and {among} > 0) or ({part} is not null and {among} = 0)"
        for part, among in (("disputed_count", "complaint_count_dispute_era"),
                            ("narrative_count", "complaint_count_narrative_era")))
    outside = " or ".join(f"{rate} < 0 or {rate} > 1" for rate in ("timely_response_rate", "dispute_rate"))
    return [
        Q.not_null("complaint_id_not_null", "fact", "complaint_id"),
        Q.unique("complaint_id_unique", "fact", ["complaint_id"]),
        Q.relationship("fact_company_exists", "fact", "company_sk", "companies", "company_sk"),
        Q.accepted("response_category_accepted", "fact", "response_category", RESPONSES),
        Q.accepted("lag_bucket_accepted", "fact", "days_to_company_bucket", D.LAG_LABELS),
        Q.accepted("bank_tier_accepted", "bank_dim", "bank_size_bucket", D.ASSET_LABELS, HELD),
        Q.rows("dates_ordered", "fact",
               f"date_sent_to_company < date_received and date_received > date'{artifact_end}'"),
        Q.floor("crosswalk_coverage", "fact", "is_crosswalked", coverage_floor),
        Q.rows("dispute_era_nulls", "fact", "not is_dispute_era and consumer_disputed is not null", "warn"),
        Q.same_count("resolution_keeps_rows", "feed", "fact"),
        Q.rows("bank_rates_in_range", "bank_metrics", outside),
        Q.rows("monthly_era_coherence", "monthly", coherent),
        Q.same_total("monthly_matches_fact", "monthly", "complaint_count", "fact", "company_sk",
                     "bank_dim", "total_assets_usd is not null"),
        Q.unique("monthly_grain", "monthly", ["canonical_name", "month_start", "product_category"]),
        # distinct current parents of a company, so that a repeated crosswalk row is none
        Q.Rule("one_current_parent", "repeated", (
            Q.Part("parents", key=("canonical_name",), a="1"),)),
    ]
