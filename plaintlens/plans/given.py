"""The complaint model's inputs, derived from the given tables by Spark.

A complaint is an order, a reporting institution is a supplier, and the crosswalk comes from the
nations. Every raw column is an expression over the source row, with the mess the cleaning rules
exist for: padded labels, mixed-case names with stray punctuation, float-formatted postcodes,
NULLs, blanks, and an early-date artifact. Nations 0-7 resolve to one company, so about a third
of all complaints share one key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plaintlens.functions.flags import Era
from plaintlens.plans.build import Models, Settings
from plaintlens.sources import schemas
from plaintlens.sources.tables import inline_rows

SETTINGS = Settings(
    dispute_era=Era("dispute", end="1998-04-24"),
    narrative_era=Era("narrative", start="1996-06-01"),
    full_years=(1995, 2000),
    date_range=("1995-01-01", "2001-12-31"),
    intake_artifact_end="1997-04-26",
)

STATES = "AL AK AZ AR CA CO CT DE FL GA HI ID IL IN IA KS KY LA ME MD MA MI MN MS MO".split()
VERBOSE_RESPONSE = (
    "Company has responded to the consumer and the CFPB and chooses not to provide a public response"
)



@dataclass(frozen=True)
class Pick:
    """The index-th (from 0) of several literal values, NULL beyond the end."""

    index: str
    options: Sequence[str | int | None]

    def column(self) -> Column:
        return F.get(F.array(*[F.lit(o) for o in self.options]), F.expr(f"cast({self.index} as int)"))


@dataclass(frozen=True)
class Head:
    """The leading characters of a text, as many as picked."""

    text: str
    length: Pick

    def column(self) -> Column:
        return F.left(F.expr(self.text), self.length.column())


@dataclass(frozen=True)
class Join:
    """Concatenation of SQL expressions and picks; NULL if a part is NULL."""

    parts: Sequence[str | Pick | Head]

    def column(self) -> Column:
        return F.concat(*[column(p) for p in self.parts])


Definition = str | Pick | Head | Join


def column(definition: Definition) -> Column:
    return F.expr(definition) if isinstance(definition, str) else definition.column()


# three products per priority, by order status F, O, P
STATUS = "(instr('FOP', o_orderstatus) - 1)"
PRODUCT = f"(ascii(o_orderpriority) - 49) * 3 + {STATUS}"
COMPLAINT_COLUMNS: dict[str, Definition] = {
    "complaint_id": "cast(o_orderkey as string)",
    "date_received": "cast(o_orderdate as date)",
    "date_sent_to_company": """
        case when o_orderkey % 97 <> 5
             then cast(o_orderdate as date) + cast(o_orderkey % 22 - 1 as int) end""",
    "product": Pick(PRODUCT, [
        " Mortgage  ", "Student loan ", "Mortgage",
        " Credit reporting", "Credit reporting, credit repair services, or other personal consumer reports",
        "Credit reporting",
        "Consumer Loan", " Payday loan", "Bank account or service",
        "Debt collection", "Debt collection ", " Debt collection",
        "Credit card", "Money transfers", "Prepaid card",
    ]),
    # three subproducts per product
    "subproduct": Pick(f"({PRODUCT}) * 3 + o_custkey % 3", [
        "FHA mortgage", " VA mortgage", "Reverse mortgage", "Federal student loan", None, "Private student loan ",
        "FHA mortgage", "VA mortgage", None,
        None, None, None, "Credit reporting", None, "Other personal consumer report", None, "", None,
        "Vehicle loan", "Vehicle lease ", "Installment loan", None, "", "Payday loan",
        "Checking account", "(CD) Certificate of deposit", " Savings account",
        "Clinic bill", "Car debt", "I do not know", "Club fees", "Clinic bill ", "I do not know",
        "Credit card", "Mortgage", None,
        None, "", None, "International money transfer", None, "", "Shop voucher", "Mobile wallet", None,
    ]),
    "issue": Pick("floor(o_totalprice / 100000)", [
        "Wrong entry in my file",
        "Payment credited late",
        "Chased for a debt I do not owe ",
        "Tricked by a stranger",
        "Points not paid out",
    ]),
    "subissue": "case when o_orderkey % 4 <> 0 then concat('Sub-issue ', o_custkey % 5) end",
    "company_name": Join([
        Pick("o_orderkey % 6", ["Nation ", "NATION ", "nation ", "  Nation  ", "Nation\t", "Nation "]),
        "cast(o_custkey % 25 as string)",
        Pick("o_orderkey % 6",
             [" Holdings", " HOLDINGS", " holdings.", "   Holdings ", "\tHoldings,;", " Holdings.,"]),
    ]),
    "state": Pick("if(o_orderkey % 19 < 4, o_orderkey % 19, 4 + (o_custkey % 25) * 2 + o_orderkey % 2)", [
        None, " United States Minor Outlying Islands ", "Federated States", "",
        *[code for state in STATES for code in (state, f" {state.lower()} ")],
    ]),
    "zip_code": Join([
        Pick("o_orderkey % 12", ["", "", "", "3034", "", "-", "ABC", "", None, " ", "", "9x"]),
        Head("cast(o_custkey % 90000 + 10000 as string)",
             Pick("o_orderkey % 12", [5, 4, 2, 5, 5, 1, 2, 0, 5, 4, 5, 1])),
        Pick("o_orderkey % 12", [".0", "-", ".0", "", "-1234", "", "", "", "", "X ", "", ""]),
    ]),
    "tags": Pick("o_orderkey % 9", ["Servicemember", "Older American", " Older American, Servicemember"]),
    "submitted_via": Pick(f"{STATUS} * 3 + o_orderkey % 3", [
        "Web", "Web ", "Web", " Phone", "Phone", "Phone", "Referral", "Postal mail", "Telegraph",
    ]),
    "company_response_to_consumer": Pick("o_orderkey % 10", [
        "Closed with monetary relief", "Closed with non-monetary relief", "Closed with relief",
        "Closed with explanation", "Closed without relief", "Closed", "In progress", None,
        " Closed with explanation ", "Untimely response",
    ]),
    "company_public_response": Pick("o_orderkey % 5", [
        VERBOSE_RESPONSE, None, "Company believes it acted appropriately ",
        "Company chooses not to provide a public response", "",
    ]),
    "timely_response": "o_orderstatus <> 'P'",
    "consumer_disputed": """
        case when cast(o_orderdate as date) < date'1998-04-24' then o_orderstatus = 'F'
             when o_orderkey % 501 = 0 then true end""",
    "consumer_consent_provided": Pick("o_orderkey % 3", ["Consent provided", None, "Consent not provided "]),
    "has_narrative": "cast(o_orderdate as date) >= date'1996-06-01' and o_totalprice > 150000",
}

HOLDER = """
    case {key} % 4
        when 0 then concat('NATION&', {key}, ' BCORP')
        when 1 then concat('NATION ', {key}, ' FINL GROUP INC THE')
        when 2 then concat('NATION ', {key}, '  CORP, INC.')
        else concat('NATION ', {key}, ' HOLDINGS')
    end"""

BANK_COLUMNS: dict[str, Definition] = {
    "fdic_certificate_number": "concat(' ', s_suppkey, ' ')",
    "institution_name": "concat(s_name, ' Bank, N.A. ')",
    "city": "concat('City ', s_nationkey)",
    "state": Pick("s_nationkey", [f" {state.lower()}" for state in STATES]),
    "holding_company_state": Pick("if(s_suppkey % 5 <> 0, s_nationkey, 25)", STATES),
    "top_holder": f"case when s_suppkey % 41 <> 0 then concat({HOLDER.format(key='s_nationkey')}, ' ') end",
    "total_assets": "case when s_acctbal >= 0 then cast(round(s_acctbal * 100) as bigint) * 200 end",
    "total_deposits": "cast(floor(s_acctbal) as bigint) * 14000",
    "equity_capital": "cast(floor(s_acctbal) as bigint) * 1900",
    "return_on_assets": "case when s_suppkey % 13 <> 0 then cast(s_suppkey % 17 as double) / 4 end",
    "return_on_equity": "cast(s_suppkey % 29 as double) / 2",
    "offices_count": "s_suppkey % 40",
    "cfpb_supervisory_flag": "s_suppkey % 6 = 0",
    "credit_card_institution": "case when s_nationkey % 5 <> 0 then s_suppkey % 9 = 0 end",
    "primary_specialization": """
        case when s_suppkey % 4 <> 0 then
            case s_suppkey % 3 when 0 then 'COMMERCIAL' when 1 then 'CREDIT CARD' else 'MORTGAGE' end end""",
}

CROSSWALK_COLUMNS = {
    "raw_company_name": "concat(' nation  ', n_nationkey, ' holdings', if(n_nationkey % 2 = 0, '.', ','))",
    "canonical_name": """
        case when n_nationkey < 8 then 'Equinox Bureau' when n_nationkey in (18, 19) then 'Trident Bank'
             when n_nationkey = 20 then 'Barlow Bank' when n_nationkey = 21 then 'Dunmore Collections'
             else concat('Bank of Nation ', n_nationkey, ' ') end""",
    "category": """
        case when n_nationkey < 8 then 'credit_bureau' when n_nationkey < 21 then 'bank'
             when n_nationkey = 21 then 'debt_collector' end""",
    "fdic_top_holder": f"""
        case when n_nationkey between 8 and 19 then {HOLDER.format(key='n_nationkey')} end""",
    "parent_as_of": "case when n_nationkey = 19 then date'1999-12-01' end",
}

# a long crosswalk, one reported name per supplier
SUPPLIER_CROSSWALK_COLUMNS: dict[str, Definition] = {
    "raw_company_name": Join([
        Pick("s_suppkey % 4", ["", "  ", "The  ", "\t"]),
        "s_name",
        Pick("s_suppkey % 5", ["", ".", " Inc.,", ";", " "]),
    ]),
    "canonical_name": "concat(' Group ', s_suppkey % 1000, ' ')",
    "category": Pick("s_suppkey % 3", ["bank", "debt_collector ", "fintech"]),
    "fdic_top_holder": "case when s_suppkey % 3 = 0 then concat('GROUP ', s_suppkey % 1000, ' CORP') end",
    "parent_as_of": "case when s_suppkey % 50 = 7 then date'1999-12-01' end",
}

# Retired product labels that the residue report knows, and the current labels that
# `defaults.PRODUCT_CATEGORIES` knows; "Consumer lending" is none of them.
PRODUCT_MAP = [
    ("Bank account or service", "Checking or savings account"),
    ("Consumer Loan", "Consumer lending"),
    ("Credit card", "Credit card or prepaid card"),
    ("Credit reporting", "Credit reporting, credit repair services, or other personal consumer reports"),
    ("Money transfers", "Money transfer, virtual currency, or money service"),
    ("Payday loan", "Consumer lending"),
    ("Prepaid card", "Credit card or prepaid card"),
]
# labels of these tests; the two vehicle rows must lose against the override of `defaults`
SUBPRODUCT_MAP = [
    ("Consumer Loan", "Vehicle loan", "Car finance"),
    ("Consumer Loan", "Vehicle lease", "Car hire"),
    ("Credit card", None, "Unspecified card"),
    ("Credit reporting", None, "Unspecified file"),
    ("Prepaid card", "Shop voucher", "Voucher"),
    ("Debt collection", "Clinic bill", "Clinic debt"),
    ("Debt collection", "Club fees", "Club debt"),
]
ISSUE_MAP = [
    ("Wrong entry in my file", "file_accuracy"),
    ("Payment credited late", "payment_posting"),
    ("Chased for a debt I do not owe", "collections"),
    ("Tricked by a stranger", "scam"),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _derive(source: DataFrame, columns: Mapping[str, Definition]) -> DataFrame:
    return source.select(*[column(d).alias(name) for name, d in columns.items()])


def raw_complaints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derive(table(spark, sf_dir, "orders"), COMPLAINT_COLUMNS)


def raw_banks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derive(table(spark, sf_dir, "supplier"), BANK_COLUMNS)


def raw_crosswalk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A seed that leaves some nations out, as a hand-kept crosswalk leaves the long tail out."""
    return _derive(table(spark, sf_dir, "nation"), CROSSWALK_COLUMNS).where("category is not null")


def supplier_crosswalk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derive(table(spark, sf_dir, "supplier"), SUPPLIER_CROSSWALK_COLUMNS)


def product_map(spark: SparkSession) -> DataFrame:
    return inline_rows(spark, schemas.PRODUCT_MAP, PRODUCT_MAP)


def subproduct_map(spark: SparkSession) -> DataFrame:
    return inline_rows(spark, schemas.SUBPRODUCT_MAP, SUBPRODUCT_MAP)


def issue_map(spark: SparkSession) -> DataFrame:
    return inline_rows(spark, schemas.ISSUE_MAP, ISSUE_MAP)


class GivenInputs:
    """Inputs of the model graph, each read when first needed."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    @cached_property
    def complaints(self) -> DataFrame:
        return raw_complaints(self.spark, self.sf_dir)

    @cached_property
    def banks(self) -> DataFrame:
        return raw_banks(self.spark, self.sf_dir)

    @cached_property
    def crosswalk(self) -> DataFrame:
        return raw_crosswalk(self.spark, self.sf_dir)

    @cached_property
    def product_map(self) -> DataFrame:
        return product_map(self.spark)

    @cached_property
    def subproduct_map(self) -> DataFrame:
        return subproduct_map(self.spark)

    @cached_property
    def issue_map(self) -> DataFrame:
        return issue_map(self.spark)


def models(spark: SparkSession, sf_dir: str) -> Models:
    return Models(spark, GivenInputs(spark, sf_dir), SETTINGS)
