"""The component mart's cells as a stored table, kept in step with a table of upserted complaints.

One batch of changes is applied in three steps, each of which can be repeated: the changes of the cells are
worked out against the complaints as they are and written under the batch's number; the complaints are
upserted; the changes are added to the cells of the months they concern. A run that stopped in between is
finished by running the same batch again: changes that are written are not worked out anew, and a cell remembers the last
batch it took, so that none is added twice. Batches are numbered upwards, and each is applied until it ended
without an error before the next one starts, as a stream does. Only the months a batch concerns are read and
written; the list of them is all that comes to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from plaintlens.operators import maintain
from plaintlens.operators.maintain import BY, MEASURES
from plaintlens.streaming.upserts import MONTH, upsert_table

BATCH = "last_batch"


def _stored_columns(by: Sequence[str]) -> list[str]:
    return ["company_sk", *by, *MEASURES, BATCH, MONTH]


def changes_name(cells_table: str) -> str:
    return f"{cells_table}_changes"


def create_cells(fact: DataFrame, cells_table: str, by: Sequence[str] = BY) -> None:
    """Store the cells of a fact, and an empty table for changes beside it."""
    cells = maintain.component_cells(fact, by=by).withColumn(BATCH, F.lit(-1).cast("long"))
    rows = cells.select(*_stored_columns(by)).hint("rebalance", F.col(MONTH))
    rows.write.mode("overwrite").partitionBy(MONTH).saveAsTable(cells_table)
    changes = rows.limit(0).withColumnRenamed(BATCH, "batch")
    changes = changes.select(*[c for c in changes.columns if c != "batch"], "batch")
    changes.write.mode("overwrite").partitionBy("batch").saveAsTable(changes_name(cells_table))


def read_cells(spark, cells_table: str) -> DataFrame:
    """The stored cells that have rows."""
    return spark.table(cells_table).where("complaint_count <> 0").drop(BATCH)


def _one_of(column: str, values: list) -> Column:
    """Whether a column has one of the values, of which one may be NULL."""
    known = [v for v in values if v is not None]
    return F.col(column).isin(known) | (F.col(column).isNull() if None in values else F.lit(False))


def write_changes(
    delta: DataFrame, fact_table: str, cells_table: str, batch: int, key: str, time_col: str, days: int, version: str,
    by: Sequence[str] = BY,
) -> None:
    """Work out a batch's changes of the cells, unless that is done. Before the complaints change."""
    spark, name = delta.sparkSession, changes_name(cells_table)
    if not spark.table(name).where(F.col("batch") == batch).isEmpty():
        return
    changes = maintain.upsert_changes(spark.table(fact_table).drop(MONTH), delta, key, time_col, days, version, by=by)
    columns = spark.table(name).columns
    rows = changes.withColumn("batch", F.lit(batch).cast("long")).select(*columns)
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").insertInto(name)


def add_changes(spark, cells_table: str, batch: int, by: Sequence[str] = BY) -> None:
    """Add a batch's written changes to the cells that have not taken them.

    A cell that ends without rows stays, as a mark that it took the batch, until another batch concerns its month.
    """
    changes = spark.table(changes_name(cells_table)).where(F.col("batch") == batch).drop("batch")
    months = [r[0] for r in changes.select(MONTH).distinct().collect()]
    if not months:
        return
    cells = spark.table(cells_table).where(_one_of(MONTH, months))
    both = cells.withColumn("changed", F.lit(False)).unionByName(
        changes.withColumns({BATCH: F.lit(None).cast("long"), "changed": F.lit(True)}))
    # rows of a change count only if the cell has not taken the batch
    fresh = F.coalesce(F.max(BATCH) < batch, F.lit(True))
    sums = [
        (F.coalesce(F.sum(F.when(~F.col("changed"), F.col(m))), F.lit(0))
         + F.when(fresh, F.coalesce(F.sum(F.when(F.col("changed"), F.col(m))), F.lit(0))).otherwise(0)).alias(m)
        for m in MEASURES
    ]
    taken = F.when(F.bool_or("changed"), F.greatest(F.max(BATCH), F.lit(batch).cast("long"))).otherwise(F.max(BATCH))
    merged = both.groupBy(*maintain.cell_keys(by=by)).agg(*sums, taken.alias(BATCH))
    left = merged.where((F.col("complaint_count") != 0) | (F.col(BATCH) >= batch))
    rows = left.select(*spark.table(cells_table).columns).hint("rebalance", F.col(MONTH))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").insertInto(cells_table)


def apply_batch(
    delta: DataFrame, fact_table: str, cells_table: str, batch: int, key: str, time_col: str, days: int, version: str,
    by: Sequence[str] = BY,
) -> None:
    """Upsert a delta of complaints and bring the cells in step. Repeating the last batch changes nothing."""
    for table in (fact_table, cells_table, changes_name(cells_table)):
        delta.sparkSession.catalog.refreshTable(table)  # another session may have written it
    write_changes(delta, fact_table, cells_table, batch, key, time_col, days, version, by)
    upsert_table(delta, fact_table, key, time_col, days, version)
    add_changes(delta.sparkSession, cells_table, batch, by)


def stream_batches(
    changes: DataFrame, fact_table: str, cells_table: str, key: str, time_col: str, days: int, version: str,
    checkpoint: str, by: Sequence[str] = BY,
) -> StreamingQuery:
    """Apply everything a stream of complaints holds now, batch by batch, then stop."""

    def apply(batch: DataFrame, number: int) -> None:
        apply_batch(batch, fact_table, cells_table, number, key, time_col, days, version, by)

    return (
        changes.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
