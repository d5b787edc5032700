"""Exact deduplication by progressive refinement: length, prefix hash, full hash.

Texts are equal when they are identical after each run of white space became one space. The first
read of the corpus gives length and prefix hash of every text; both rounds of grouping work on those
two numbers. Only texts that share both with another one are hashed in full in the second read. What
is known of the surviving groups reaches that read as a set of at most 2**20 hash buckets, a bound
that does not depend on the input; a bucket hit by chance costs one more hash and changes no result.

Defined cases: null text counts as empty, so null, empty and white-space texts differ only if one of
them has a space. Null ids sort after all others; a group of null ids only keeps a null id. Rows that
agree in id and text are told apart by their position, one of them stays. An empty table gives an
empty result. Any text length is handled by the same path. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plaintlens.llm.common import join_groups, one_space, store, text_of

#: Code points of the normalised text that the prefix hash covers.
PREFIX = 64
#: Buckets of the survivors' set.
BUCKETS = 1 << 20

KEY = ["__length", "__prefix", "__full"]


def normalised(text: str | Column) -> Column:
    return one_space(text_of(text))


def _measured(docs: DataFrame, text: str, carry: Sequence[Column]) -> DataFrame:
    """Carried columns, normalised text, its length and prefix hash."""
    return docs.select(*carry, normalised(text).alias("__norm")).select(
        "*",
        F.octet_length("__norm").alias("__length"),
        F.xxhash64(F.substring("__norm", 1, PREFIX)).alias("__prefix"),
    )


def _bucket() -> Column:
    return F.pmod(F.xxhash64("__length", "__prefix"), F.lit(BUCKETS))


def surviving_buckets(docs: DataFrame, text: str = "text") -> DataFrame:
    """Buckets of the (length, prefix hash) groups with more than one row: both first rounds."""
    sizes = store(_measured(docs, text, []).groupBy("__length", "__prefix").agg(F.count("*").alias("__n")))
    lengths = sizes.groupBy("__length").agg(F.sum("__n").alias("__of_length")).where("__of_length > 1")
    pairs = sizes.where("__n > 1").join(lengths, "__length", "left_semi")
    return store(pairs.select(_bucket().alias("__bucket")).distinct())


def _refined(docs: DataFrame, text: str, carry: Sequence[Column]) -> DataFrame:
    """The second read: the full hash where a text's bucket survived, else null."""
    buckets = surviving_buckets(docs, text).withColumn("__hit", F.lit(True))
    found = _measured(docs, text, carry).withColumn("__bucket", _bucket())
    return found.join(F.broadcast(buckets), "__bucket", "left").withColumn(
        "__full", F.when(F.col("__hit"), F.unhex(F.sha2("__norm", 256)))
    )


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text: str = "text", carry: Sequence[str] = ()) -> DataFrame:
    """Every row's group: the id, the carried columns, keep_id, group_size and kept (one row of each group)."""
    taken = [F.col(id_col).alias("__id"), F.struct(F.lit(0).alias("none"), *carry).alias("__carried")]
    rows = store(
        _refined(docs, text, taken).select(
            "__id", "__carried", *KEY, F.monotonically_increasing_id().alias("__row")
        )
    )
    first = F.min(F.struct(F.col("__id").isNull().alias("last"), F.col("__id").alias("id"), F.col("__row").alias("row")))
    hashed = rows.where("__full is not null")
    groups = store(hashed.groupBy(*KEY).agg(F.count("*").alias("__n"), first.alias("__first")))
    grouped = join_groups(hashed, groups, KEY, "__n", rows.count())
    alone = rows.where("__full is null")
    out = [F.col("__id").alias(id_col), *(F.col(f"__carried.{c}") for c in carry)]
    return alone.select(
        *out, F.col("__id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept")
    ).unionByName(
        grouped.select(
            *out,
            F.col("__first.id").alias("keep_id"),
            F.col("__n").alias("group_size"),
            (F.col("__row") == F.col("__first.row")).alias("kept"),
        )
    )


def keep_first(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each group of equal texts, with all its columns: the one with the smallest id.

    Rows without a possible partner pass through; only surviving groups are moved, after each task has
    folded its own copies.
    """
    whole = F.struct(*(F.col(c) for c in docs.columns))
    order = F.struct(F.col(id_col).isNull(), F.col(id_col), F.xxhash64(text_of(text)))
    found = _refined(docs, text, [whole.alias("__whole"), order.alias("__order")])
    alone = found.where("__full is null").select("__whole.*")
    first = found.where("__full is not null").groupBy(*KEY).agg(F.min_by("__whole", "__order").alias("__whole"))
    return alone.unionByName(first.select("__whole.*"))
