"""History kept as a stored table: a merge rewrites the rows in force and appends those it closes."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from plaintlens.operators.history import scd2_merge

#: Partition by the year in which a row was closed; rows in force are in that of year 0.
CLOSED = "closed_in"
OPEN = 0


def _parts(rows: DataFrame) -> DataFrame:
    return rows.withColumn(CLOSED, F.coalesce(F.year("valid_to"), F.lit(OPEN)))


def _in_force(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/{CLOSED}={OPEN}")


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """The whole history. The rows in force have every column there ever was; older files lack the later ones."""
    schema = _in_force(spark, path).schema
    return spark.read.schema(schema.add(CLOSED, IntegerType())).parquet(path).drop(CLOSED)


def create_history(incoming: DataFrame, path: str, key: str, check_cols: Sequence[str], as_of: dt.datetime | str) -> None:
    """Store a first version of every key."""
    _parts(scd2_merge(None, incoming, key, check_cols, as_of)).write.mode("overwrite").partitionBy(CLOSED).parquet(path)


def merge_history(incoming: DataFrame, path: str, key: str, check_cols: Sequence[str], as_of: dt.datetime | str) -> None:
    """Merge a feed as `scd2_merge` does, reading the rows in force and writing no closed row a second time.

    Closed rows are appended to their year first, then the partition of the rows in force is swapped. A run
    that ended between the two is finished by running it again: rows of this moment that are
    closed already are not appended twice. Merging the same feed again changes nothing.
    """
    spark = incoming.sparkSession
    merged = scd2_merge(_in_force(spark, path), incoming, key, check_cols, as_of)
    closing = merged.where("valid_to is not null")
    year, at = F.year(F.lit(str(as_of)).cast("timestamp")), F.lit(str(as_of)).cast("timestamp")
    whole = spark.read.schema(_in_force(spark, path).schema.add(CLOSED, IntegerType())).parquet(path)
    done = whole.where((F.col(CLOSED) == year) & (F.col("valid_to") == at)).select("row_id")
    _parts(closing.join(done, "row_id", "left_anti").select(*merged.columns)).write.mode("append").partitionBy(CLOSED).parquet(path)
    (
        _parts(merged.where("valid_to is null"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(CLOSED)
        .parquet(path)
    )
