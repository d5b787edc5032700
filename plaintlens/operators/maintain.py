"""Keeping the component mart up to date from upserts, without rebuilding it.

The state behind the mart is a table of cells (company, period, further keys) of plain counts and sums. An upsert
changes it by what it adds and what it takes back: the new rows count once, the rows they replace count
once negatively. Changes are grouped like the cells and added to them; a cell that no row is left in
vanishes, and what is undefined (an era-gated count outside its era, a sum of nothing) is decided when
the mart is read, from the counts that say so.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plaintlens.operators.history import recent_versions

BY = ("product_category",)

#: The additive measures of a cell, as expressions over one fact row.
MEASURES = {
    "complaint_count": "1",
    "timely_response_count": "int(timely_response)",
    "routed_same_day_count": "int(days_to_company = 0)",
    "sum_days_to_company": "days_to_company",
    "days_known_count": "int(days_to_company is not null)",
    "complaint_count_dispute_era": "int(is_dispute_era)",
    "complaint_count_narrative_era": "int(is_narrative_era)",
    "disputed_count": "int(is_dispute_era and consumer_disputed)",
    "narrative_count": "int(is_narrative_era and has_narrative)",
}

#: Measures without a value where another one is 0.
UNDEFINED_WITHOUT = {
    "sum_days_to_company": "days_known_count",
    "disputed_count": "complaint_count_dispute_era",
    "narrative_count": "complaint_count_narrative_era",
}


def period_of(grain: str) -> str:
    return f"{grain}_start"


def cell_keys(grain: str = "month", by: Sequence[str] = BY) -> list[str]:
    return ["company_sk", period_of(grain), *by]


def _sums(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(*[F.coalesce(F.sum(m), F.lit(0)).alias(m) for m in MEASURES])


def _measured(fact: DataFrame, grain: str, by: Sequence[str], sign: int = 1) -> DataFrame:
    return fact.where("company_sk is not null").select(
        "company_sk",
        F.trunc("date_received", grain).alias(period_of(grain)),
        *by,
        *[(F.expr(e).cast("long") * sign).alias(m) for m, e in MEASURES.items()],
    )


def component_cells(fact: DataFrame, grain: str = "month", by: Sequence[str] = BY) -> DataFrame:
    """Counts and sums of every cell that has rows."""
    return _sums(_measured(fact, grain, by), cell_keys(grain, by))


def cell_changes(replaced: DataFrame, arrived: DataFrame, grain: str = "month", by: Sequence[str] = BY) -> DataFrame:
    """What cells gain from the rows that arrived and lose with those replaced; unchanged cells are left out."""
    signed = _measured(arrived, grain, by).unionByName(_measured(replaced, grain, by, -1))
    return _sums(signed, cell_keys(grain, by)).where(" or ".join(f"{m} <> 0" for m in MEASURES))


def apply_changes(cells: DataFrame, changes: DataFrame, grain: str = "month", by: Sequence[str] = BY) -> DataFrame:
    """Cells with changes added; those without a row left are gone."""
    return _sums(cells.unionByName(changes), cell_keys(grain, by)).where("complaint_count <> 0")


def upsert_changes(
    existing: DataFrame, delta: DataFrame, key: str, time_col: str, days: int, version: str,
    grain: str = "month", by: Sequence[str] = BY,
) -> DataFrame:
    """The changes that `upsert_lookback` of the same arguments makes to the cells of `existing`."""
    recent = recent_versions(existing, delta, key, time_col, days, version)
    replaced = existing.join(recent.select(key), key, "left_semi")
    return cell_changes(replaced, recent, grain, by)


def defined(cells: DataFrame) -> DataFrame:
    """Cells as the mart shows them: NULL where a measure has nothing to be counted among."""
    gated = {m: F.when(F.col(among) > 0, F.col(m)) for m, among in UNDEFINED_WITHOUT.items()}
    return cells.where("complaint_count <> 0").withColumns(gated).drop("days_known_count")
