"""The model graph on a small in-line feed with hand-computed results, under the default settings."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from plaintlens.operators import marts
from plaintlens.operators.metrics import MEASURES, METRICS, metric
from plaintlens.plans.build import Inputs, Models, store, store_checked
from plaintlens.sources import schemas
from plaintlens.sources.tables import inline_rows

D = dt.date
MORTGAGE, CARD = "Mortgage", "Credit card"


def complaint(i, received, sent, company, product=MORTGAGE, subproduct=None, disputed=None, narrative=False,
              timely=True, response="Closed"):
    return (str(i), received, sent, product, subproduct, "Issue A" if i % 2 else "Odd", None, company, "ca",
            "30349.0", None, "Web", response, None, timely, disputed, None, narrative)


FEED = [
    complaint(1, D(2017, 4, 23), D(2017, 4, 23), "Alpha  Bank.", disputed=True),
    complaint(2, D(2017, 4, 24), D(2017, 4, 27), "ALPHA BANK", disputed=None, narrative=True),
    complaint(3, D(2015, 5, 31), D(2015, 5, 30), "alpha\tbank", disputed=False, timely=False),
    complaint(4, D(2016, 1, 10), None, "Old Alpha", CARD, "", disputed=False, narrative=True),
    complaint(5, D(2023, 3, 23), D(2023, 4, 7), "Bureau Inc.", response="Closed with monetary relief"),
    complaint(6, D(2011, 12, 15), D(2011, 12, 15), "Nobody", "Consumer Loan", "Vehicle loan"),
    complaint(7, D(2022, 12, 31), D(2023, 1, 4), "Lonely Bank", response=None),
]
CROSSWALK = [
    ("ALPHA BANK", "Alpha", "bank", "ALPHA&CO", None),
    ("OLD ALPHA", "Alpha", "bank", "OLD ALPHA CORP", D(2016, 6, 1)),
    ("LONELY BANK", "Lonely", "bank", None, None),
    ("BUREAU INC", "Bureau", "credit_bureau", None, None),
]
BANKS = "fdic_certificate_number string, institution_name string, state string, holding_company_state string, " \
    "top_holder string, total_assets bigint, total_deposits bigint, equity_capital bigint, return_on_assets double, " \
    "return_on_equity double, offices_count bigint, cfpb_supervisory_flag boolean, " \
    "credit_card_institution boolean, primary_specialization string"
BANK_ROWS = [
    (" 1 ", "Alpha NA", " ca", None, "ALPHA&CO ", 300_000_000, 10, 5, 1.0, 2.0, 30, False, None, None),
    (" 2 ", "Alpha FSB", "ny", "NY", "ALPHA&CO", 100_000_000, 30, 15, None, 4.0, 20, True, None, "CARD"),
    ("3", "Zero", "tx", "TX", "ZERO", 0, 1, 1, 1.0, 1.0, 49, None, None, "X"),
    ("4", "Orphan", "tx", "TX", None, 5, 1, 1, 1.0, 1.0, 1, None, None, "X"),
    ("5", "Blank", "tx", "TX", "BLANK", None, 1, 1, 1.0, 1.0, None, None, None, "X"),
]


@pytest.fixture(scope="module")
def inputs(spark):
    return Inputs(
        complaints=spark.createDataFrame(FEED, schemas.COMPLAINTS),
        banks=spark.createDataFrame(BANK_ROWS, BANKS),
        crosswalk=inline_rows(spark, schemas.CROSSWALK, CROSSWALK),
        product_map=inline_rows(spark, schemas.PRODUCT_MAP, [(CARD, "Credit card or prepaid card")]),
        subproduct_map=inline_rows(spark, schemas.SUBPRODUCT_MAP, [(CARD, None, "General")]),
        issue_map=inline_rows(spark, schemas.ISSUE_MAP, [("Issue A", "a")]),
    )


@pytest.fixture(scope="module")
def models(spark, inputs):
    return Models(spark, inputs)


@pytest.fixture(scope="module")
def fact(models):
    return {r.complaint_id: r for r in models.fact.collect()}


def test_fact_rows(fact):
    assert len(fact) == 7
    assert [fact[str(i)].canonical_name for i in range(1, 8)] == [
        "Alpha", "Alpha", "Alpha", "Alpha", "Bureau", None, "Lonely"]
    assert fact["6"].company_sk is None and not fact["6"].is_crosswalked
    assert fact["6"].product_normalized == "Vehicle loan or lease"
    assert (fact["4"].product_category, fact["4"].subproduct_normalized) == ("card", "General")
    assert [fact[str(i)].days_to_company for i in range(1, 8)] == [0, 3, 0, None, 15, 0, 4]
    assert fact["4"].days_to_company_bucket == "15_plus"
    assert [fact[str(i)].has_full_year_data for i in (5, 6, 7)] == [False, False, True]
    assert fact["5"].had_monetary_relief and fact["5"].response_category == "relief"
    assert fact["7"].company_response_to_consumer == "Untimely response"
    assert {r.issue_category for r in fact.values()} == {"a", "other"}


def test_company_dimension(models):
    rows = {r.canonical_name: r for r in models.companies.collect()}
    assert rows["Alpha"].fdic_top_holder == "ALPHA&CO"
    assert (rows["Alpha"].first_seen_date, rows["Alpha"].total_complaint_volume) == (D(2015, 5, 31), 4)
    assert rows["Bureau"].is_credit_bureau


def test_holder_rollup(models):
    rows = {r.top_holder: r for r in models.holders.collect()}
    assert set(rows) == {"ALPHA&CO", "ZERO", "BLANK"}
    alpha = rows["ALPHA&CO"]
    assert (alpha.charter_count, alpha.total_assets_usd, alpha.offices_count, alpha.is_branchless) == (
        2, 400_000_000_000, 50, False)
    assert (alpha.bank_size_bucket, alpha.bank_size_rank) == ("large ($400B-$1T)", 3)
    assert (alpha.avg_roa, alpha.avg_roe) == (1.0, 3.0)
    assert (alpha.primary_specialization, alpha.hq_state) == ("CARD", "NY")
    assert alpha.is_supervised_cfpb and alpha.credit_card_institution is None
    assert rows["ZERO"].capital_ratio is None and rows["ZERO"].is_branchless
    assert (rows["BLANK"].total_assets_usd, rows["BLANK"].is_branchless) == (None, None)
    assert rows["BLANK"].bank_size_bucket == "smaller (<$175B)"


def test_bank_dimension_keeps_unmatched_bank(models):
    rows = {r.canonical_name: r for r in models.bank_dim.collect()}
    assert set(rows) == {"Alpha", "Lonely"}
    assert rows["Lonely"].total_assets_usd is None and rows["Lonely"].total_complaint_volume == 1


def test_bank_mart(models):
    row, = models.bank_metrics.collect()
    assert (row.canonical_name, row.complaint_count, row.total_assets_billions) == ("Alpha", 4, 400.0)
    assert row.complaints_per_billion_assets == 0.01
    assert (row.avg_days_to_company, row.pct_routed_same_day, row.timely_response_rate) == (1.0, 0.5, 0.75)
    assert row.dispute_rate == 0.3333 and row.narrative_rate == 0.6667
    assert row.roe_percentile_rank == 0.0


def test_monthly_mart(models):
    rows = {(str(r.month_start), r.product_category): r for r in models.monthly.collect()}
    april = rows["2017-04-01", "mortgage"]
    assert (april.complaint_count, april.complaint_count_dispute_era, april.disputed_count) == (2, 1, 1)
    may = rows["2015-05-01", "mortgage"]
    assert (may.complaint_count_narrative_era, may.narrative_count) == (0, None)
    assert rows["2016-01-01", "card"].sum_days_to_company is None


def test_component_rates_equal_rates_from_the_fact(models):
    """Summing components and dividing gives the rate of the rows, at every grain."""
    for by in (["product_category"], ["month_start"], ["canonical_name"], []):
        rolled = {tuple(r[c] for c in by): r for r in marts.rollup_components(models.monthly, by).collect()}
        rows = models.universe_fact.withColumn("month_start", F.trunc("date_received", "month")) \
            .withColumn("canonical_name", F.col("canonical_name")).groupBy(*by).agg(
            F.expr("count_if(consumer_disputed and is_dispute_era) / nullif(count_if(is_dispute_era), 0)").alias("d"),
            F.expr("count_if(has_narrative and is_narrative_era) / nullif(count_if(is_narrative_era), 0)").alias("n"))
        for r in rows.collect():
            got = rolled[tuple(r[c] for c in by)]
            assert (got.dispute_rate, got.narrative_rate) == (r.d, r.n)


def test_stored_graph_equals_lazy_graph(spark, inputs, models, tmp_path):
    stored = store(spark, inputs, str(tmp_path / "models"))
    for name in ("fact", "companies", "bank_dim", "bank_metrics", "monthly"):
        a, b = getattr(stored, name), getattr(models, name)
        assert a.columns == b.columns
        assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty(), name
    assert stored.dates.count() == 4748


def test_checks_find_the_early_date_only(spark, inputs, tmp_path):
    rows = store_checked(spark, inputs, str(tmp_path / "checked"))[1].collect()
    status = {r.name: (r.status, r.n_failed) for r in rows}
    assert len(status) == len(rows) == 85
    assert status.pop("dates_ordered") == ("fail", 1)
    # what the small feed lacks: a routing date, a bank's assets, an issue label the checks know
    lacking = ["complaints.date_sent_to_company.not_null", "banks.total_assets.not_null",
               "holders.total_assets_usd.not_null", "fact.issue_category.accepted"]
    expected = dict.fromkeys(lacking, ("fail", 1))
    assert {name: s for name, s in status.items() if s != ("pass", 0)} == expected


def test_every_metric(models):
    tables = {"complaints": models.fact, "banks": models.bank_metrics}
    for name in METRICS:
        change = name.endswith("pct_change")
        by = ["company__is_branchless"] if "assets" in name else ["category"]
        got = metric(tables, name, by=by, grain="month" if change else None)
        assert name in got.columns and not got.isEmpty()
    assert set(MEASURES) < set(METRICS)
    total, = metric(tables, "complaint_count").collect()
    assert total.complaint_count == 7
    per_bank = {r[0]: r[1] for r in metric(tables, "complaints_per_billion_assets",
                                           by=["company__bank_size_bucket"]).collect()}
    assert per_bank == {"large ($400B-$1T)": 0.01, None: None}
    rate, = metric(tables, "complaints_per_billion_assets", restrict_to_matched=True).collect()
    assert rate[0] == 0.01
    whole, = metric(tables, "complaints_per_billion_assets").collect()
    assert whole[0] == 7 / 400
    with pytest.raises(ValueError, match="whole number"):
        metric(tables, "complaint_count_mom_pct_change", grain="quarter")
    with pytest.raises(ValueError, match="no dimension"):
        metric(tables, "total_assets_billions", by=["category"])


def test_changes_skip_gaps(spark):
    rows = [("a", D(2020, 1, 31)), ("b", D(2020, 1, 5)), ("c", D(2020, 2, 29)), ("d", D(2020, 4, 1))]
    fact = spark.createDataFrame(rows, "complaint_id string, date_received date")
    got = {str(r.period): r[1] for r in metric({"complaints": fact}, "complaint_count_mom_pct_change",
                                               grain="month").collect()}
    assert got == {"2020-01-01": None, "2020-02-01": -0.5, "2020-04-01": None}
