"""Profiling reports over any table.

Shares of a total take the total from a scalar subquery instead of a window over everything, and
rankings of many keys use the partitioned form in `pareto`.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from plaintlens.functions.flags import bucketize
from plaintlens.functions.rates import percent, ratio
from plaintlens.functions.text import display_name, zip_pattern


def counts(df: DataFrame, *keys: str | Column, name: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias(name))


def shape(
    df: DataFrame, distinct: Mapping[str, str] = {}, filled: Mapping[str, str] = {}, date: str | None = None,
    true_flags: Mapping[str, str] = {}, approx: float | None = None,
) -> DataFrame:
    """One row: row count, distinct values, true and non-null counts, date range.

    `approx` (relative error) replaces the exact distinct counts by sketches.
    """
    def n_distinct(c: str) -> Column:
        return F.count_distinct(c) if approx is None else F.approx_count_distinct(c, approx)

    aggs = [F.count("*").alias("total_rows")]
    aggs += [n_distinct(c).alias(out) for out, c in distinct.items()]
    aggs += [F.count_if(F.col(c)).alias(out) for out, c in true_flags.items()]
    aggs += [F.count(c).alias(out) for out, c in filled.items()]
    if date is not None:
        aggs += [F.min(date).alias("min_date"), F.max(date).alias("max_date")]
    return df.agg(*aggs)


def column_profile(
    df: DataFrame, columns: Sequence[str] | None = None, approx: float | None = None
) -> DataFrame:
    """Rows, NULLs and distinct values per column, from one scan.

    Columns are unpivoted and counted per (column, value) before the per-column totals, so no
    column's values meet in one task. `approx` (relative error) counts distinct values by sketches,
    which moves one row per task instead of all values.
    """
    if approx is not None:
        names = list(columns or df.columns)
        sketched = df.agg(F.count("*").alias("rows"), *[
            agg for i, c in enumerate(names)
            for agg in (F.count(c).alias(f"filled_{i}"), F.approx_count_distinct(c, approx).alias(f"distinct_{i}"))
        ])
        return sketched.select(F.inline(F.array(*[
            F.struct(F.lit(c).alias("column_name"), F.col("rows").alias("n_rows"),
                     (F.col("rows") - F.col(f"filled_{i}")).alias("n_nulls"), F.col(f"distinct_{i}").alias("n_distinct"))
            for i, c in enumerate(names)
        ])))
    cells = F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"))
        for c in (columns or df.columns)
    ])
    per_value = counts(df.select(F.inline(cells)), "column_name", "value")
    return per_value.groupBy("column_name").agg(
        F.sum("n").alias("n_rows"),
        F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)).alias("n_nulls"),
        F.count("value").alias("n_distinct"),
    )


def recent(df: DataFrame, by: str, n: int, tie: str) -> DataFrame:
    """The n most recent rows."""
    return df.orderBy(F.desc(by), F.desc(tie)).limit(n)


def distribution(df: DataFrame, col: str, date: str | None = None, digits: int = 2) -> DataFrame:
    """Count and percent of all rows per value, optionally with first and last date."""
    aggs = [F.count("*").alias("n")]
    if date is not None:
        aggs += [F.min(date).alias("first_seen"), F.max(date).alias("last_seen")]
    per_value = df.groupBy(col).agg(*aggs)
    # the total keeps all aggregates, so that it is taken from the same exchange instead of a second read
    total = per_value.agg(F.struct(F.sum("n").alias("n"), *(F.max(c) for c in per_value.columns if c != "n")).alias("t"))
    return per_value.withColumn("pct", percent(F.col("n"), total.scalar().getField("n"), digits))


def value_counts(df: DataFrame, cols: Sequence[str], null_label: str | None = "(null)") -> DataFrame:
    """Counts per (field, value) over several columns in one scan; `null_label` names NULL."""
    cells = F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("value")) for c in cols])
    per_value = counts(df.select(F.inline(cells)), "field", "value")
    if null_label is None:
        return per_value
    return per_value.withColumn("value", F.coalesce("value", F.lit(null_label)))


def cooccurrence(df: DataFrame, col: str, tokens: Mapping[str, str]) -> DataFrame:
    """How often each non-null value mentions each token, and all of them."""
    hits = {out: F.col(col).contains(token) for out, token in tokens.items()}
    together = None
    for hit in hits.values():
        together = hit if together is None else together & hit
    return df.where(F.col(col).isNotNull()).groupBy(col).agg(
        F.count("*").alias("n"),
        *[F.count_if(hit).alias(out) for out, hit in hits.items()],
        F.count_if(together).alias("n_all"),
    )


def entity_list(df: DataFrame, key: str, date: str, breadth: str) -> DataFrame:
    """Every entity with volume, first and last date, and number of distinct `breadth` values."""
    per_pair = df.groupBy(key, breadth).agg(
        F.count("*").alias("n"), F.min(date).alias("lo"), F.max(date).alias("hi")
    )
    return per_pair.groupBy(key).agg(
        F.sum("n").alias("complaints"),
        F.count(breadth).alias("products_touched"),
        F.min("lo").alias("first_seen"),
        F.max("hi").alias("last_seen"),
    )


def top_entities(df: DataFrame, key: str, date: str, breadth: str, k: int) -> DataFrame:
    """The k entities with most rows."""
    listed = entity_list(df.where(F.col(key).isNotNull()), key, date, breadth)
    return listed.orderBy(F.desc("complaints"), F.asc(key)).limit(k)


def _percents(df: DataFrame, total: Column, digits: tuple[int, int]) -> DataFrame:
    return df.withColumns({
        "pct": percent(F.col("n"), total, digits[0]),
        "cum_pct": percent(F.col("cum_n"), total, digits[1]),
    })


def pareto_top(df: DataFrame, key: str, k: int, digits: tuple[int, int] = (3, 2)) -> DataFrame:
    """The k most frequent keys with rank, share and running share of all rows.

    The running sum only needs the k leading rows (a top-k, not a full sort); the total comes
    from the whole table. Ties rank by key.
    """
    per_key = counts(df, key)
    total = per_key.agg(F.sum("n"))
    order = [F.desc("n"), F.asc(key)]
    leading = W.orderBy(*order)
    ranked = per_key.orderBy(*order).limit(k).select(
        F.row_number().over(leading).cast("bigint").alias("rnk"),
        key,
        "n",
        F.sum("n").over(leading.rowsBetween(W.unboundedPreceding, W.currentRow)).alias("cum_n"),
    )
    return _percents(ranked, total.scalar(), digits)


def pareto(df: DataFrame, key: str, digits: tuple[int, int] = (2, 2), prefix: int = 3) -> DataFrame:
    """Rank, share and running share of every key, without sorting all keys in one task.

    Keys with equal counts rank by the MD5 of the key. Their rank is assembled from three
    windows that each stay small: over the distinct counts (at most sqrt(2 x rows) of them),
    over the hash prefixes within a count, and over the keys within a prefix. All rows of a
    count share its value, so the running sum follows from the rank. `prefix` is the number of hex
    digits: 16**prefix parts of the keys that share a count, to be chosen by how many there are.
    """
    hashed = counts(df, key).withColumn("__hash", F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")))) \
        .withColumn("__prefix", F.substring("__hash", 1, prefix))
    cells = hashed.groupBy("n", "__prefix").agg(F.count("*").alias("keys"))
    by_count = cells.groupBy("n").agg(F.sum("keys").alias("keys"))
    before = W.orderBy(F.desc("n")).rowsBetween(W.unboundedPreceding, -1)
    count_offsets = by_count.select(
        "n",
        F.coalesce(F.sum("keys").over(before), F.lit(0)).alias("keys_before"),
        F.coalesce(F.sum(F.col("keys") * F.col("n")).over(before), F.lit(0)).alias("n_before"),
    )
    within = W.partitionBy("n").orderBy("__prefix").rowsBetween(W.unboundedPreceding, -1)
    prefix_offsets = cells.select(
        "n", "__prefix", F.coalesce(F.sum("keys").over(within), F.lit(0)).alias("prefix_before")
    )
    offsets = prefix_offsets.join(count_offsets, "n")
    local = hashed.withColumn(
        "__local", F.row_number().over(W.partitionBy("n", "__prefix").orderBy("__hash", key))
    )
    in_count = F.col("prefix_before") + F.col("__local")
    ranked = local.join(offsets, ["n", "__prefix"]).select(
        (F.col("keys_before") + in_count).alias("rnk"),
        key,
        "n",
        (F.col("n_before") + in_count * F.col("n")).alias("cum_n"),
    )
    return _percents(ranked, by_count.agg(F.sum(F.col("keys") * F.col("n"))).scalar(), digits)


def size_histogram(df: DataFrame, key: str, cuts: Sequence[int], labels: Sequence[str]) -> DataFrame:
    """How many keys have how many rows, by size bucket."""
    bucket = bucketize(F.col("n"), cuts, labels)
    return counts(df, key).groupBy(bucket.alias("size_bucket")).agg(
        F.count("*").alias("company_count"),
        F.sum("n").alias("total_complaints"),
        F.min("n").alias("smallest"),
    )


def rate_by(
    df: DataFrame, keys: Sequence[str | Column], flag: str, min_n: int = 0, k: int | None = None,
    digits: int | None = None,
) -> DataFrame:
    """NULL, true and false counts of a flag and the share of true among known, per group."""
    hit = F.col(flag)
    rates = (
        df.groupBy(*keys)
        .agg(
            F.count("*").alias("n_complaints"),
            F.count_if(hit.isNull()).alias("n_null"),
            F.count_if(hit).alias("n_true"),
            F.count_if(~hit).alias("n_false"),
        )
        .where(F.col("n_complaints") >= min_n)
        .withColumn("rate", ratio(F.col("n_true"), F.col("n_true") + F.col("n_false"), digits))
    )
    if k is None:
        return rates
    names = [c for c in rates.columns if c not in ("n_complaints", "n_null", "n_true", "n_false", "rate")]
    return rates.orderBy(F.desc("n_complaints"), *names).limit(k)


def fill_by_period(
    df: DataFrame, period: Column, filled: Mapping[str, str], true_flags: Mapping[str, str] = {},
    distinct: Mapping[str, str] = {},
) -> DataFrame:
    """Per period: rows, distinct values, known counts with fill rate, true counts with rate."""
    known = {out: F.count(c) for out, c in filled.items()} | {
        out: F.count_if(F.col(c)) for out, c in true_flags.items()
    }
    grouped = df.groupBy(period.alias("period")).agg(
        F.count("*").alias("complaints"),
        *[F.count_distinct(c).alias(out) for out, c in distinct.items()],
        *[agg.alias(out) for out, agg in known.items()],
    )
    return grouped.withColumns({f"{out}_rate": ratio(F.col(out), F.col("complaints")) for out in known})


def lag_quantiles(
    df: DataFrame, start: str, end: str, by: Column, probs: Sequence[float] = (0.5, 0.9, 0.99), exact: bool = False,
    accuracy: int = 10000,
) -> DataFrame:
    """Distribution of the days between two dates per group; rows without an end date drop out.

    Exact quantiles run on (group, days) counts: as many rows as distinct lags, however large the group.
    """
    days, names = F.col("days"), [f"p{round(p * 100):d}" for p in probs]
    lags = df.where(F.col(end).isNotNull()).select(by.alias("grp"), F.datediff(end, start).alias("days"))
    if exact:
        c = F.col("c")
        summary = lags.groupBy("grp", "days").agg(F.count("*").alias("c")).groupBy("grp").agg(
            F.sum("c").alias("n"),
            F.sum(F.when(days < 0, c).otherwise(0)).alias("n_negative"),
            F.sum(F.when(days == 0, c).otherwise(0)).alias("n_zero"),
            F.min(days).alias("min_days"),
            F.max(days).alias("max_days"),
            ratio(F.sum(days * c), F.sum(F.when(days.isNotNull(), c))).alias("mean_days"),
            F.percentile(days, list(probs), c).alias("__q"),
        )
    else:
        summary = lags.groupBy("grp").agg(
            F.count("*").alias("n"),
            F.count_if(days < 0).alias("n_negative"),
            F.count_if(days == 0).alias("n_zero"),
            F.min(days).alias("min_days"),
            F.max(days).alias("max_days"),
            F.avg(days).alias("mean_days"),
            F.percentile_approx(days, list(probs), accuracy).alias("__q"),
        )
    quantiles = [F.col("__q")[i].alias(name) for i, name in enumerate(names)]
    return summary.select(*[x for x in summary.columns if x != "__q"], *quantiles)


def crosstab(df: DataFrame, a: str, b: str) -> DataFrame:
    return counts(df, a, b, name="complaints")


def frequent_crosstab(df: DataFrame, a: str, b: str, min_rows: int) -> DataFrame:
    """Cross-tab of the values of `b` that have at least `min_rows` rows.

    Counted once per pair; frequent values are then found on the pair counts. NULL of `b` is no value.
    """
    pairs = crosstab(df.where(F.col(b).isNotNull()), a, b)
    big = pairs.groupBy(b).agg(F.sum("complaints").alias("__n")).where(F.col("__n") >= min_rows).select(b)
    return pairs.join(big, b, "left_semi")


def violations_by(
    df: DataFrame, start: str, end: str, by: Sequence[str | Column] = (), k: int | None = None
) -> DataFrame:
    """Rows whose end date precedes their start, by how many days, or by the given groups."""
    early = F.datediff(start, end)
    bad = df.where(F.col(end) < F.col(start))
    if not by:
        return bad.groupBy(early.alias("days_early")).agg(
            F.count("*").alias("complaints"), F.min(start).alias("earliest"), F.max(start).alias("latest")
        )
    grouped = bad.groupBy(*by).agg(F.count("*").alias("violations"), F.avg(early).alias("avg_days_early"))
    if k is None:
        return grouped
    names = [c for c in grouped.columns if c not in ("violations", "avg_days_early")]
    return grouped.orderBy(F.desc("violations"), *names).limit(k)


def nulls_by_status(df: DataFrame, col: str, by: str, always: str, null_label: str = "(null)") -> DataFrame:
    """NULLs of a column per status; shown where there are any, and always for one status."""
    status = F.coalesce(F.col(by), F.lit(null_label)).alias("status")
    return (
        df.groupBy(status)
        .agg(F.count("*").alias("n_total"), F.count_if(F.col(col).isNull()).alias("n_null"))
        .where((F.col("n_null") > 0) | (F.col("status") == always))
    )


def pattern_summary(df: DataFrame, col: str, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """Rows per value shape; distinct values are classified, not rows."""
    per_value = counts(df, col)
    return per_value.groupBy(zip_pattern(F.col(col), rules).alias("pattern")).agg(F.sum("n").alias("n"))


def invalid_values(df: DataFrame, col: str, regex: str, k: int) -> DataFrame:
    """The k most frequent non-blank values that do not match."""
    value = F.col(col)
    bad = df.where(value.isNotNull() & (value != "") & ~value.rlike(regex))
    return (
        counts(bad, col).withColumn("length", F.length(col)).orderBy(F.desc("n"), F.asc(col)).limit(k)
    )


def residue(df: DataFrame, col: str, legacy_values: Sequence[str]) -> DataFrame:
    """Rows still carrying each legacy label, one row per label, zeros included."""
    flags = F.array(*[
        F.struct(F.lit(v).alias("legacy_value"), F.count_if(F.col(col) == v).alias("n")) for v in legacy_values
    ])
    return df.agg(flags.alias("__rows")).select(F.inline("__rows"))


def largest(df: DataFrame, by: str, k: int, columns: Sequence[str], tie: str) -> DataFrame:
    """The k rows with the greatest value, NULLs last."""
    return df.select(*columns).orderBy(F.desc_nulls_last(by), F.asc(tie)).limit(k)


def largest_parents(df: DataFrame, parent: str, amount: str, k: int) -> DataFrame:
    grouped = df.where(F.col(parent).isNotNull()).groupBy(parent).agg(
        F.count("*").alias("subsidiaries"), F.sum(amount).alias("combined_assets")
    )
    return grouped.orderBy(F.desc_nulls_last("combined_assets"), F.asc(parent)).limit(k)


def normalize_preview(
    df: DataFrame, col: str, amount: str, k: int, replacements: Sequence[tuple[str, str]], drop_suffix: str
) -> DataFrame:
    """Before and after of the display name for the k largest parents."""
    grouped = df.where(F.col(col).isNotNull()).groupBy(col).agg(
        F.count("*").alias("charter_count"), F.sum(amount).alias("total_assets_thousands")
    )
    return (
        grouped.orderBy(F.desc_nulls_last("total_assets_thousands"), F.asc(col)).limit(k)
        .withColumn("top_holder_normalized", display_name(F.col(col), replacements, drop_suffix))
        .withColumnRenamed(col, "raw_top_holder")
    )


def tier_preview(
    dim: DataFrame, ref: DataFrame, left_on: str, parent: str, cuts: Sequence[int], labels: Sequence[str]
) -> DataFrame:
    """Matched entities with assets, supervision, return on assets and a trial tiering."""
    parents = ref.where(F.col(parent).isNotNull()).groupBy(parent).agg(
        F.sum("total_assets").alias("__assets"),
        F.count("*").alias("charter_count"),
        F.max("cfpb_supervisory_flag").alias("is_supervised_cfpb"),
        F.round(F.avg("return_on_assets"), 4).alias("avg_roa"),
    )
    return dim.join(parents, dim[left_on] == parents[parent]).select(
        "canonical_name",
        F.round(F.col("__assets") / 1e6, 1).alias("total_assets_billions"),
        "charter_count",
        "is_supervised_cfpb",
        "avg_roa",
        bucketize(F.col("__assets"), cuts, labels, op=">=").alias("bank_size_bucket"),
    )
