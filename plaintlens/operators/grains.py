"""Many grains from one read: the additive measures at every listed period and subset of dimensions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plaintlens.functions.rates import ratio
from plaintlens.operators.maintain import MEASURES, defined, period_of
from plaintlens.operators.marts import COMPONENT_RATES

PERIODS = ("day", "month", "quarter", "year")
ALL = "all"


def many_grains(
    fact: DataFrame,
    sets: Sequence[tuple[str, Sequence[str]]],
    rates: Mapping[str, tuple[str, str]] = COMPONENT_RATES,
) -> DataFrame:
    """Measures and rates for each of `sets`: a period (day, month, quarter, year or all) and the dimensions kept.

    The fact is folded to cells of a day and all dimensions first, so that the rows which the grouping sets
    repeat are cells, not complaints. Rates divide after summing. `all_<dimension>` tells a dimension that
    is summed over from one whose value is NULL; rows without a date keep a period of NULL within their grain.
    """
    dims = list(dict.fromkeys(d for _, kept in sets for d in kept))
    used = [p for p in PERIODS if any(p == grain for grain, _ in sets)]
    measured = fact.select("date_received", *dims, *[F.expr(e).cast("long").alias(m) for m, e in MEASURES.items()])
    sums = [F.coalesce(F.sum(m), F.lit(0)).alias(m) for m in MEASURES]
    cells = measured.groupBy("date_received", *dims).agg(*sums)
    periods = {p: F.col("date_received") if p == "day" else F.trunc("date_received", p) for p in used}
    cells = cells.withColumns({period_of(p): c for p, c in periods.items()})

    keys = [[*([] if grain == ALL else [period_of(grain)]), *kept] for grain, kept in sets]
    flags = [F.grouping(period_of(p)).alias(f"__no_{p}") for p in used] + [F.grouping(d).alias(f"__no_{d}") for d in dims]
    folded = cells.groupingSets(keys, *map(period_of, used), *dims).agg(*flags, *sums)
    grain, start = F.lit(ALL), F.lit(None).cast("date")
    for p in used:
        kept = F.col(f"__no_{p}") == 0
        grain, start = F.when(kept, p).otherwise(grain), F.when(kept, F.col(period_of(p))).otherwise(start)
    whole = defined(folded).select(
        grain.alias("grain"),
        start.alias("period_start"),
        *dims,
        *[(F.col(f"__no_{d}") == 1).alias(f"all_{d}") for d in dims],
        *[m for m in MEASURES if m != "days_known_count"],
    )
    return whole.withColumns({name: ratio(F.col(a), F.col(b)) for name, (a, b) in rates.items()})
