"""What several corpus operators share: stored intermediate results, white space, folds, group joins."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plaintlens.session import shared_folder

#: A group with more than one part in HEAVY_PARTS of all rows is heavy; there are fewer than HEAVY_PARTS.
HEAVY_PARTS = 1024


def store(df: DataFrame) -> DataFrame:
    """Write an intermediate result to the shared folder and read it back.

    It is computed once, survives lost executors and gets true sizes for later join choices. The
    folder is deleted when the session's JVM ends, or earlier by `drop`.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/plaintlens-{uuid.uuid4().hex}"
    df.write.parquet(path)
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(jvm_path)
    return spark.read.schema(df.schema).parquet(path)


def drop(*stored: DataFrame) -> None:
    """Delete stored results nobody reads any more."""
    for df in stored:
        context = df.sparkSession.sparkContext
        for folder in {name.rpartition("/")[0] for name in df.inputFiles()}:
            path = context._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str | Column) -> Column:
    """A text; null counts as empty."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def one_space(text: Column) -> Column:
    """Each run of space, tab, line feed, vertical tab, form feed and carriage return as one space.

    Single spaces, by far the most runs, are no match, so that they cost no replacement.
    """
    return F.regexp_replace(text, r"[\x09-\x0D\x20]{2,}|[\x09-\x0D]", " ")


def word_count(text: Column) -> Column:
    """Number of maximal runs of characters other than the six white space characters."""
    words = F.trim(one_space(text))
    gaps = F.octet_length(words) - F.octet_length(F.replace(words, F.lit(" "), F.lit("")))
    return F.when(words == "", F.lit(0)).otherwise(gaps + 1).cast("long")


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo parts; null for a null id."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(parts))


def in_fold(doc_id: Column, parts: int, which: int) -> Column:
    """Whether the id falls into a fold; a null id falls into none."""
    return F.coalesce(fold(doc_id, parts) == which, F.lit(False))


def whose(doc_id: Column, content: Column) -> Column:
    """An id, null or not, and a content hash as one string.

    Never null and of one type everywhere, so that a grouping and a join by it deal rows out alike.
    """
    return F.concat_ws("|", content.cast("string"), doc_id.cast("string"))


def join_groups(rows: DataFrame, groups: DataFrame, keys: list[str], size: str, total: int) -> DataFrame:
    """Inner join of rows with one row per group, whatever the share of the largest group.

    `size` counts a group's rows and `total` all rows, so fewer than HEAVY_PARTS groups are heavy:
    that bounded list is broadcast. What is left has no key with more than 1 / HEAVY_PARTS of the rows
    and is joined by key.
    """
    heavy = F.broadcast(groups.where(F.col(size) > total / HEAVY_PARTS))
    light = groups.where(F.col(size) <= total / HEAVY_PARTS)
    rest = rows.join(heavy.select(*keys), keys, "left_anti")
    return rows.join(heavy, keys).unionByName(rest.join(light, keys))
