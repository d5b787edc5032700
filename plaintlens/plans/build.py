"""The whole model graph: raw tables and lookups in, dimensions, fact and marts out."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plaintlens import defaults as D
from plaintlens.functions.flags import Era
from plaintlens.operators import dims, facts, fused, marts
from plaintlens.operators.entity import resolve_entities
from plaintlens.operators.rollup import holder_rollup
from plaintlens.plans.rules import declared_rules, invariants
from plaintlens.sources.tables import save


@dataclass(frozen=True)
class Inputs:
    """Raw tables and lookup tables."""

    complaints: DataFrame
    banks: DataFrame
    crosswalk: DataFrame
    product_map: DataFrame
    subproduct_map: DataFrame
    issue_map: DataFrame


@dataclass(frozen=True)
class Settings:
    dispute_era: Era = D.DISPUTE_ERA
    narrative_era: Era = D.NARRATIVE_ERA
    full_years: tuple[int, int] = D.FULL_YEARS
    date_range: tuple[str, str] = D.DATE_RANGE
    intake_artifact_end: str = D.INTAKE_ARTIFACT_END


class Models:
    """The model graph as lazy DataFrames; a model is defined when first asked for.

    Any model can be given, for example a stored one; everything downstream then starts from it.
    """

    def __init__(self, spark: SparkSession, inputs: Inputs, settings: Settings = Settings(), **given: DataFrame):
        self.spark = spark
        self.inputs = inputs
        self.settings = settings
        self.__dict__.update(given)

    @cached_property
    def complaints(self) -> DataFrame:
        raw = self.inputs
        return facts.clean_complaints(
            raw.complaints, raw.product_map, raw.subproduct_map, raw.issue_map, self.settings.full_years
        )

    @cached_property
    def banks(self) -> DataFrame:
        return facts.clean_banks(self.inputs.banks)

    @cached_property
    def crosswalk(self) -> DataFrame:
        return facts.clean_crosswalk(self.inputs.crosswalk)

    @cached_property
    def resolved(self) -> DataFrame:
        return resolve_entities(self.complaints, self.crosswalk)

    @cached_property
    def fact(self) -> DataFrame:
        return facts.build_fact(self.resolved, self.settings.dispute_era, self.settings.narrative_era)

    @cached_property
    def companies(self) -> DataFrame:
        return dims.entity_dim(self.crosswalk, self.fact)

    @cached_property
    def holders(self) -> DataFrame:
        return holder_rollup(self.banks)

    @cached_property
    def bank_dim(self) -> DataFrame:
        return dims.bank_dim(self.companies, self.holders)

    @cached_property
    def dates(self) -> DataFrame:
        return dims.date_dim(dims.date_spine(self.spark, *self.settings.date_range))

    @cached_property
    def bank_metrics(self) -> DataFrame:
        return marts.entity_metrics(self.fact, self.bank_dim)

    @cached_property
    def monthly(self) -> DataFrame:
        return marts.component_mart(self.fact, self.bank_dim)

    @cached_property
    def universe_fact(self) -> DataFrame:
        """Complaints of banks that have assets, the rows both bank marts are built from."""
        universe = self.bank_dim.where(F.col("total_assets_usd").isNotNull()).select("company_sk")
        return self.fact.join(universe, "company_sk", "left_semi")


#: Models written besides the fact, in this order, where they are checked.
CHECKED = ["banks", "crosswalk", "holders", "companies", "bank_dim", "dates", "bank_metrics", "monthly"]
STORED = ["companies", "bank_dim", "dates", "bank_metrics", "monthly"]


def store(spark: SparkSession, inputs: Inputs, path: str, settings: Settings = Settings()) -> Models:
    """Build and write the stored models under `path`, which all executors must share.

    The fact is written once, by month, and everything downstream reads the stored copy, so no
    later model repeats or depends on the cleaning of the raw feed.
    """
    fact = Models(spark, inputs, settings).fact.withColumn("month_start", F.trunc("date_received", "month"))
    done = {"fact": save(fact, f"{path}/fact", "overwrite", ["month_start"]).drop("month_start")}
    for name in STORED:
        model = getattr(Models(spark, inputs, settings, **done), name)
        done[name] = save(model, f"{path}/{name}", "overwrite")
    return Models(spark, inputs, settings, **done)


def store_checked(
    spark: SparkSession, inputs: Inputs, path: str, settings: Settings = Settings(), coverage_floor: float = 74.0
) -> tuple[Models, DataFrame]:
    """`store`, with the outcome of every check.

    Row checks, shares and counts are taken while the models are written. What needs keys to meet is read from
    the stored tables, each once and the checked columns only; the feed is read once in all.
    """
    rules = [*invariants(settings.intake_artifact_end, coverage_floor), *declared_rules()]
    watched: dict[str, fused.Watched] = {}

    def watch(name: str, df: DataFrame) -> DataFrame:
        watched[name] = fused.Watched(df, name, rules)
        return watched[name].table

    raw = watch("feed", inputs.complaints)
    cleaned = facts.clean_complaints(raw, inputs.product_map, inputs.subproduct_map, inputs.issue_map, settings.full_years)
    fact = watch("fact", Models(spark, inputs, settings, complaints=cleaned).fact)
    fact = fact.withColumn("month_start", F.trunc("date_received", "month"))
    done = {"fact": save(fact, f"{path}/fact", "overwrite", ["month_start"]).drop("month_start")}
    for name in CHECKED:
        model = watch(name, getattr(Models(spark, inputs, settings, **done), name))
        done[name] = save(model, f"{path}/{name}", "overwrite")
    models = Models(spark, inputs, settings, **done)
    parents = models.crosswalk.where("parent_as_of is null and fdic_top_holder is not null")
    parents = parents.select("canonical_name", "fdic_top_holder").distinct()
    return models, fused.evaluate({**done, "parents": parents}, rules, watched)
