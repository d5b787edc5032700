"""Reading and writing tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plaintlens.functions.text import presence_flag
from plaintlens.sources import schemas


def read_table(spark: SparkSession, path: str, schema: str, fmt: str = "parquet") -> DataFrame:
    """Read files of any Spark format with a declared schema (no inference pass)."""
    reader = spark.read.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True).option("quote", '"').option("escape", '"')
    return reader.format(fmt).load(path)


def read_complaints(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return read_table(spark, path, schemas.COMPLAINTS, fmt)


def read_banks(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return read_table(spark, path, schemas.BANKS, fmt)


def read_seed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Header CSV with quoted fields; an empty field is NULL."""
    return read_table(spark, path, schema, "csv")


def inline_rows(spark: SparkSession, schema: str, rows: Sequence[Sequence]) -> DataFrame:
    """Literal rows as a table whose size Catalyst knows, so lookups on it broadcast by themselves."""
    names = [field.split()[0] for field in schema.split(",")]
    structs = [F.struct(*[F.lit(v).alias(n) for v, n in zip(row, names, strict=True)]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs).cast(f"array<struct<{schema}>>")))


def materialize_lean(df: DataFrame, drop: Sequence[str], presence_flags: Mapping[str, str]) -> DataFrame:
    """Replace wide columns by flags that say whether they were present."""
    return df.withColumns({flag: presence_flag(F.col(c)) for flag, c in presence_flags.items()}).drop(*drop)


def save(df: DataFrame, name: str, mode: str = "view", partition_by: Sequence[str] = ()) -> DataFrame:
    """Publish a model: `view` registers it lazily, any other mode writes parquet under path `name`.

    A written model is read back, so everything downstream starts from the stored table.
    Partitioned writes are rebalanced first: one month's rows meet in few files, and AQE splits
    the months that are too large for one task.
    """
    if mode == "view":
        df.createOrReplaceTempView(name)
        return df
    rows = df.hint("rebalance", *[F.col(c) for c in partition_by]) if partition_by else df
    rows.write.mode(mode).partitionBy(*partition_by).parquet(name)
    return df.sparkSession.read.schema(df.schema).parquet(name)


def describe_schema(tables: Mapping[str, DataFrame], with_rows: bool = False) -> DataFrame:
    """One row per column: table_name, ordinal_position, column_name, data_type, is_nullable (, n_rows)."""
    spark = next(iter(tables.values())).sparkSession
    listing = inline_rows(
        spark,
        "table_name string, ordinal_position int, column_name string, data_type string, is_nullable boolean",
        [(name, i, f.name, f.dataType.simpleString(), f.nullable)
         for name, df in tables.items() for i, f in enumerate(df.schema.fields, start=1)],
    )
    if not with_rows:
        return listing
    counts = None
    for name, df in tables.items():
        one = df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        counts = one if counts is None else counts.unionByName(one)
    return listing.join(counts, "table_name")
