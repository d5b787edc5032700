"""Many checks over many tables with one read of each table, or none.

A rule says what each row of its tables contributes: a key (or none) and up to three numbers, under a
condition. One scan of a table produces the contributions of all rules; they are summed by rule and key, which folds
copies of a key before anything moves, and each rule's verdict follows from its sums. Rules without a
key need sums only; those can be taken while a table is written (`watched`), so that checking a stored table reads
nothing but the keys of its unique, listed and referential columns.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from plaintlens.functions.rates import percent
from plaintlens.sources.tables import inline_rows

SUMS = "rule int, key string, a long, b long, c long"


@dataclass(frozen=True)
class Part:
    """What rows of one table contribute to a rule, as SQL expressions."""

    table: str
    when: str = "true"
    key: tuple[str, ...] | None = None
    a: str = "null"
    b: str = "null"
    c: str = "null"

    def contribution(self, rule: int) -> Column:
        if self.key is None:
            key = F.lit(None).cast("string")
        elif len(self.key) == 1:
            key = F.col(self.key[0]).cast("string")
        else:
            key = F.to_json(F.struct(*self.key))
        numbers = [F.expr(e).cast("long").alias(n) for n, e in (("a", self.a), ("b", self.b), ("c", self.c))]
        return F.when(F.expr(self.when), F.struct(F.lit(rule).alias("rule"), key.alias("key"), *numbers))


@dataclass(frozen=True)
class Rule:
    """A named check. `verdict` names how the number of failures follows from the sums, see `evaluate`."""

    name: str
    verdict: str
    parts: tuple[Part, ...]
    severity: str = "error"
    bound: float | None = None

    @property
    def keyless(self) -> bool:
        return all(p.key is None for p in self.parts)


def _and(*conditions: str | None) -> str:
    return " and ".join(f"({c})" for c in conditions if c)


def rows(name: str, table: str, bad: str, severity: str = "error") -> Rule:
    """Rows that are as they must not be."""
    return Rule(name, "rows", (Part(table, bad, a="1"),), severity)


def not_null(name: str, table: str, column: str, where: str | None = None) -> Rule:
    return rows(name, table, _and(where, f"{column} is null"))


def unique(name: str, table: str, columns: Sequence[str], where: str | None = None) -> Rule:
    """Keys that occur more than once; a single NULL key never counts, in a composite key it does."""
    known = f"{columns[0]} is not null" if len(columns) == 1 else None
    return Rule(name, "repeated", (Part(table, _and(where, known) or "true", tuple(columns), a="1"),))


def accepted(
    name: str, table: str, column: str, values: Iterable[str], where: str | None = None, severity: str = "error"
) -> Rule:
    """Distinct values outside the list; NULL passes."""
    listed = ", ".join("'" + v.replace("'", "''") + "'" for v in values)
    bad = _and(where, f"{column} is not null and {column} not in ({listed})")
    return Rule(name, "keys", (Part(table, bad, (column,), a="1"),), severity)


def relationship(name: str, child: str, column: str, parent: str, parent_column: str) -> Rule:
    """Distinct child keys without a parent; NULL passes."""
    return Rule(name, "orphans", (
        Part(child, f"{column} is not null", (column,), a="1"),
        Part(parent, f"{parent_column} is not null", (parent_column,), b="1"),
    ))


def floor(name: str, table: str, flag: str, least_percent: float, severity: str = "error") -> Rule:
    """Whether the share of flagged rows, rounded to a tenth of a percent, is below the floor."""
    return Rule(name, "floor", (Part(table, a=f"int(coalesce({flag}, false))", b="1"),), severity, least_percent)


def same_count(name: str, left: str, right: str) -> Rule:
    """Whether two tables differ in their numbers of rows."""
    return Rule(name, "counts", (Part(left, a="1"), Part(right, b="1")))


def same_total(name: str, left: str, total: str, right: str, key: str, among: str, member: str) -> Rule:
    """Whether the sum of `total` over left differs from the number of right's rows whose key is a member of `among`."""
    return Rule(name, "total", (
        Part(left, key=(key,), a=total),
        Part(right, f"{key} is not null", (key,), b="1"),
        Part(among, _and(f"{key} is not null", member), (key,), c="1"),
    ))


# ---- evaluation


def contributions(table: DataFrame, name: str, rules: Sequence[Rule], keyless: bool = True) -> DataFrame | None:
    """What a table's rows contribute to the rules; None if to none of them."""
    found = [
        part.contribution(number) for number, rule in enumerate(rules) if keyless or not rule.keyless
        for part in rule.parts if part.table == name
    ]
    return table.select(F.inline(F.array_compact(F.array(*found)))) if found else None


class Watched:
    """Sums of a table's keyless rules, taken while the table is written.

    A task that runs again after a lost executor may be counted twice: a sum that must be 0 stays 0, but a number of
    failures can then be too large, and two counts can differ that should not.
    """

    def __init__(self, table: DataFrame, name: str, rules: Sequence[Rule]) -> None:
        self.parts = [
            (number, part) for number, rule in enumerate(rules) if rule.keyless for part in rule.parts if part.table == name
        ]
        self.sums = Observation()
        measures = [
            F.sum(part.contribution(number)[n]).alias(f"{n}{place}")
            for place, (number, part) in enumerate(self.parts) for n in "abc"
        ]
        self.table = table.observe(self.sums, *measures) if measures else table

    def rows(self) -> list[tuple]:
        """The sums as contributions, after the table was written."""
        if not self.parts:
            return []
        found = self.sums.get
        return [(number, None, *(found[f"{n}{place}"] for n in "abc")) for place, (number, _) in enumerate(self.parts)]


def evaluate(
    tables: Mapping[str, DataFrame], rules: Sequence[Rule], watched: Mapping[str, Watched] | None = None
) -> DataFrame:
    """name, severity, n_failed and status of every rule; each table is read once, watched ones for their keys only."""
    spark = next(iter(tables.values())).sparkSession
    taken = [row for one in (watched or {}).values() for row in one.rows()]
    sources = [contributions(df, name, rules, name not in (watched or {})) for name, df in tables.items()]
    sources = [s for s in sources if s is not None]
    if taken:
        sources.append(inline_rows(spark, SUMS, taken))
    by_key = reduce(DataFrame.unionByName, sources).groupBy("rule", "key").agg(*[F.sum(n).alias(n) for n in "abc"])
    by_rule = by_key.groupBy("rule").agg(
        F.sum("a").alias("sum_a"),
        F.sum("b").alias("sum_b"),
        F.sum(F.when(F.col("c") > 0, F.col("b"))).alias("sum_b_among"),
        F.count_if(F.col("a") > 1).alias("repeated"),
        F.count_if(F.col("a") > 0).alias("keys"),
        F.count_if((F.col("a") > 0) & F.col("b").isNull()).alias("orphans"),
    )
    listed = [(n, r.name, r.severity, r.verdict, r.bound) for n, r in enumerate(rules)]
    every = inline_rows(spark, "rule int, name string, severity string, verdict string, bound double", listed)
    joined = every.join(by_rule, "rule", "left")
    zero, differ = F.lit(0), lambda x, y: (~x.eqNullSafe(y)).cast("long")
    none_is_0 = lambda c: F.coalesce(F.col(c), zero)
    n_failed = (
        F.when(F.col("verdict") == "rows", F.col("sum_a"))
        .when(F.col("verdict") == "repeated", F.col("repeated"))
        .when(F.col("verdict") == "keys", F.col("keys"))
        .when(F.col("verdict") == "orphans", F.col("orphans"))
        .when(F.col("verdict") == "floor", (percent(F.col("sum_a"), F.col("sum_b"), 1) < F.col("bound")).cast("long"))
        .when(F.col("verdict") == "counts", differ(none_is_0("sum_a"), none_is_0("sum_b")))
        .when(F.col("verdict") == "total", differ(F.col("sum_a"), none_is_0("sum_b_among")))
    )
    return joined.select("name", "severity", F.coalesce(n_failed, zero).alias("n_failed")).withColumn(
        "status",
        F.when(F.col("n_failed") == 0, "pass").when(F.col("severity") == "warn", "warn").otherwise("fail"),
    )
