"""Named metrics over the fact and the bank mart.

Measures are kept as additive parts (sums and counts), so a metric by a bank attribute first
groups the fact by company and only then looks the attribute up.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plaintlens.functions.rates import ratio

ENTITY = "company_sk"
VIA_ENTITY = "company__"
TIME = {"complaints": "date_received", "banks": "last_complaint_date"}

COMPLAINT_DIMENSIONS = [
    "date_received", "product_normalized", "product_category", "state", "category", "is_crosswalked",
    "is_dispute_era", "is_narrative_era", "submitted_via", "timely_response", "has_narrative",
    "consumer_disputed", "tags_is_servicemember", "tags_is_older_american",
]
BANK_DIMENSIONS = [
    "last_complaint_date", "bank_size_bucket", "is_branchless", "primary_specialization",
    "is_supervised_cfpb", "credit_card_institution",
]


@dataclass(frozen=True)
class Measure:
    """An aggregate over one table: additive parts, and the value as a function of them."""

    table: str
    parts: Mapping[str, Callable[[], Column]]
    value: Callable[[], Column]


def _flag_sum(flag: str) -> Callable[[], Column]:
    return lambda: F.sum(F.when(F.col(flag), 1).otherwise(0))


def _single(table: str, part: str, agg: Callable[[], Column]) -> Measure:
    return Measure(table, {part: agg}, lambda: F.col(part))


MEASURES: dict[str, Measure] = {
    "complaint_count": _single("complaints", "complaint_count", lambda: F.count("complaint_id")),
    "timely_response_count": _single("complaints", "timely_response_count", _flag_sum("timely_response")),
    "disputed_count": _single("complaints", "disputed_count", _flag_sum("consumer_disputed")),
    "narrative_count": _single("complaints", "narrative_count", _flag_sum("has_narrative")),
    "avg_days_to_company": Measure(
        "complaints",
        {"sum_days": lambda: F.sum("days_to_company"), "n_days": lambda: F.count("days_to_company")},
        lambda: ratio(F.col("sum_days"), F.col("n_days")),
    ),
    # one decimal place each, summed as decimals so the total does not depend on row order
    "total_assets_billions": Measure(
        "banks",
        {"assets": lambda: F.sum(F.col("total_assets_billions").cast("decimal(20,1)"))},
        lambda: F.col("assets").cast("double"),
    ),
}


@dataclass(frozen=True)
class Ratio:
    """Sum of one measure over sum of another, both restricted to `where`."""

    numerator: str
    denominator: str
    where: str | None = None


@dataclass(frozen=True)
class Change:
    """Relative change of a measure against the period `months` earlier."""

    measure: str
    months: int


METRICS: dict[str, str | Ratio | Change] = {
    **{name: name for name in MEASURES},
    "timely_response_rate": Ratio("timely_response_count", "complaint_count"),
    "dispute_rate": Ratio("disputed_count", "complaint_count", where="is_dispute_era"),
    "narrative_rate": Ratio("narrative_count", "complaint_count", where="is_narrative_era"),
    "complaint_count_mom_pct_change": Change("complaint_count", months=1),
    "complaint_count_yoy_pct_change": Change("complaint_count", months=12),
    "complaints_per_billion_assets": Ratio("complaint_count", "total_assets_billions"),
}

_MONTHS_PER_PERIOD = {"month": 1, "quarter": 3, "year": 12}


def _period(table: str, grain: str) -> Column:
    date = F.col(TIME[table])
    return date if grain == "day" else F.trunc(date, grain)


def _parts(
    tables: Mapping[str, DataFrame], measures: Sequence[str], by: Sequence[str], grain: str | None,
    where: Column | str | None, restrict_to_matched: bool,
) -> DataFrame:
    """Additive parts of measures of one table by the requested dimensions."""
    table = MEASURES[measures[0]].table
    aggs = {p: agg for m in measures for p, agg in MEASURES[m].parts.items()}
    period = [_period(table, grain).alias("period")] if grain else []
    keys = [*by, *(["period"] if grain else [])]
    source = tables[table] if where is None else tables[table].where(where)

    known = [VIA_ENTITY + d for d in BANK_DIMENSIONS] + (COMPLAINT_DIMENSIONS if table == "complaints" else [])
    unknown = [d for d in by if d not in known]
    if unknown:
        raise ValueError(f"{measures[0]} has no dimension {unknown}")

    if table == "banks":
        dims = [F.col(d.removeprefix(VIA_ENTITY)).alias(d) for d in by]
        return source.groupBy(*dims, *period).agg(*[agg().alias(p) for p, agg in aggs.items()])

    own = [d for d in by if not d.startswith(VIA_ENTITY)]
    through = [d for d in by if d.startswith(VIA_ENTITY)]
    if not through and not restrict_to_matched:
        return source.groupBy(*own, *period).agg(*[agg().alias(p) for p, agg in aggs.items()])

    per_entity = source.groupBy(ENTITY, *own, *period).agg(*[agg().alias(p) for p, agg in aggs.items()])
    attributes = tables["banks"].select(ENTITY, *[F.col(d.removeprefix(VIA_ENTITY)).alias(d) for d in through])
    joined = per_entity.join(attributes, ENTITY, "inner" if restrict_to_matched else "left")
    return joined.groupBy(*keys).agg(*[F.sum(p).alias(p) for p in aggs])


def metric(
    tables: Mapping[str, DataFrame],
    name: str,
    by: Sequence[str] = (),
    grain: str | None = None,
    where: Column | str | None = None,
    restrict_to_matched: bool = False,
) -> DataFrame:
    """One metric by dimensions and, with `grain`, by period.

    `tables` holds `complaints` (the fact) and `banks` (the bank mart). Dimensions named
    `company__x` are bank attributes reached through the company key; complaints of other
    companies fall into their NULL group, unless `restrict_to_matched` drops them. `where`
    filters the complaints.
    """
    spec = METRICS[name]
    keys = [*by, *(["period"] if grain else [])]

    if isinstance(spec, str):
        on_banks = MEASURES[spec].table == "banks"
        parts = _parts(tables, [spec], by, grain, None if on_banks else where, restrict_to_matched)
        return parts.select(*keys, MEASURES[spec].value().alias(name))

    if isinstance(spec, Change):
        return _change(metric(tables, spec.measure, by, grain, where, restrict_to_matched), spec, name, by, grain)

    source = dict(tables)
    if spec.where is not None:
        source["complaints"] = source["complaints"].where(spec.where)
    sides = [spec.numerator, spec.denominator]
    if len({MEASURES[m].table for m in sides}) == 1:
        parts = _parts(source, sides, by, grain, where, restrict_to_matched)
    else:
        # Each side is aggregated on its own, then both meet on the dimensions. Stacking and
        # regrouping is a full outer join that also pairs NULL groups and needs no key at all.
        stacked = [
            _parts(source, [m], by, grain, where if MEASURES[m].table == "complaints" else None,
                   restrict_to_matched)
            for m in sides
        ]
        columns = [p for m in sides for p in MEASURES[m].parts]
        union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), stacked)
        parts = union.groupBy(*keys).agg(*[F.max(p).alias(p) for p in columns])
    return parts.select(
        *keys, ratio(MEASURES[spec.numerator].value(), MEASURES[spec.denominator].value()).alias(name)
    )


def _change(values: DataFrame, spec: Change, name: str, by: Sequence[str], grain: str | None) -> DataFrame:
    """(current - prior) / prior with whole periods shifted after aggregation; no prior gives NULL."""
    if grain not in _MONTHS_PER_PERIOD or spec.months % _MONTHS_PER_PERIOD[grain]:
        raise ValueError(f"{name}: an offset of {spec.months} month(s) is not a whole number of {grain} periods")
    value = F.col(spec.measure)
    missing = F.lit(None).cast("bigint")
    # every period speaks for itself and, shifted, as the prior of a later one
    both = F.array(
        F.struct(F.col("period").alias("period"), value.alias("current"), missing.alias("prior")),
        F.struct(F.add_months("period", spec.months).alias("period"), missing.alias("current"), value.alias("prior")),
    )
    paired = (
        values.select(*by, F.inline(both))
        .where(F.col("period").isNotNull() | F.col("prior").isNull())  # no period, no later one
        .groupBy(*by, "period")
        .agg(F.max("current").alias("current"), F.max("prior").alias("prior"))
        .where(F.col("current").isNotNull())
    )
    return paired.select(*by, "period", ratio(F.col("current") - F.col("prior"), F.col("prior")).alias(name))


def over_spine(values: DataFrame, spine: DataFrame, grain: str, by: Sequence[str] = ()) -> DataFrame:
    """Every period of the date spine, with NULL values where the metric has none.

    With `by`, every combination of dimension values that occurs gets every period. The periods are one
    array, as long as the calendar, that each combination unfolds.
    """
    day = F.col("date_day")
    periods = spine.select((day if grain == "day" else F.trunc(day, grain)).alias("period")).distinct()
    if not by:
        return periods.join(values, "period", "left")
    all_periods = periods.agg(F.sort_array(F.collect_set("period"))).scalar()
    cells = values.select(*by).distinct().withColumn("period", F.explode(all_periods))
    renamed = values.select(*[F.col(c).alias(f"__{c}") for c in (*by, "period")], *[c for c in values.columns if c not in (*by, "period")])
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in (*by, "period")])
    return cells.join(renamed, same, "left").drop(*(f"__{c}" for c in (*by, "period")))
