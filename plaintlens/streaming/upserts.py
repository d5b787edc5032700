"""Applying late and amended complaints to a stored, month-partitioned table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from plaintlens.operators.history import recent_versions

MONTH = "month_start"


def month_of(time_col: str) -> Column:
    return F.trunc(time_col, "month").alias(MONTH)


def create_table(df: DataFrame, table: str, time_col: str) -> None:
    """Store rows as a catalog table partitioned by calendar month."""
    rows = df.select("*", month_of(time_col)).hint("rebalance", F.col(MONTH))
    rows.write.mode("overwrite").partitionBy(MONTH).saveAsTable(table)


def _add_missing_columns(delta: DataFrame, table: str) -> None:
    spark = delta.sparkSession
    known = {c.lower() for c in spark.table(table).columns}
    added = [f"`{f.name}` {f.dataType.simpleString()}" for f in delta.schema.fields if f.name.lower() not in known]
    if added:
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({', '.join(added)})")


def upsert_table(delta: DataFrame, table: str, key: str, time_col: str, days: int, version: str) -> None:
    """Overwrite or add the recent rows of `delta`, rewriting only the months they touch.

    A month is touched when a delta row lies in it or when it holds a row that a delta row
    replaces; only the list of those months comes to the driver. Rows without a date are a month
    of their own. Columns new in the delta are added to the table. Applying the same delta twice
    gives the same table, also when the first run ended between writing and dropping emptied months:
    replaced copies that were left there are found, and dropped, by the next.
    """
    spark = delta.sparkSession
    _add_missing_columns(delta, table)
    existing = spark.table(table)
    recent = recent_versions(existing, delta, key, time_col, days, version).persist()
    try:
        replaced = existing.select(key, MONTH).join(recent.select(key), key, "left_semi").select(MONTH)
        months = [r[0] for r in recent.select(month_of(time_col)).union(replaced).distinct().collect()]
        if not months:
            return
        dated = [m for m in months if m is not None]
        undated = F.col(MONTH).isNull() if None in months else F.lit(False)
        touched = existing.where(F.col(MONTH).isin(dated) | undated).drop(MONTH)
        merged = (
            touched.join(recent.select(key), key, "left_anti")
            .unionByName(recent, allowMissingColumns=True)
            .select("*", month_of(time_col))
        )
        kept = {r[0] for r in merged.select(MONTH).distinct().collect()}
        (
            merged.select(*existing.columns)
            .hint("rebalance", F.col(MONTH))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .insertInto(table)
        )
        # a month whose last row moved elsewhere has no new data to overwrite it with
        for month in set(months) - kept:
            spec = "NULL" if month is None else f"DATE'{month}'"
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({MONTH} = {spec})")
    finally:
        recent.unpersist()


def stream_upserts(
    changes: DataFrame, table: str, key: str, time_col: str, days: int, version: str, checkpoint: str
) -> StreamingQuery:
    """Apply everything a stream of changes holds now, batch by batch, then stop."""

    def apply(batch: DataFrame, _: int) -> None:
        upsert_table(batch, table, key, time_col, days, version)

    return (
        changes.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
