"""Mixing sources to target weights over fixed-length token blocks.

The documents of a source are laid end to end in a fixed pseudorandom order and cut into blocks of
BLOCK words. The mix has one slot per block it takes, in output shards of SHARD slots. Slots are dealt
to sources without replacement: the draws of all sources are numbered through and a pseudorandom
permutation maps those numbers to slots. The number of each source in a shard is therefore multinomial
given the exact totals; independent draws would leave small sources several percent off their
target. A source's draw k is mapped through a pseudorandom permutation of the source's block numbers,
another one for each pass, so that no block comes twice before all came once. Draws are counted in words: a
source at its cap is taken whole in every pass, any other within half a block of its target. Blocks and draws are
joined by (source, block number), which spreads the largest source over all tasks.

Permutations are swap-or-not networks: for any size, without tables, one expression per row.

Defined cases: null text counts as empty; a text without words is never taken. A null source is a
source of its own, the last. Null ids sort first in the layout. Rows that agree in id, source and text
are laid out one after the other and told apart by a copy number. Empty tables give empty results.
Very long texts become many block rows. Extra columns take no part.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plaintlens.llm.common import one_space, store, text_of, whose, word_count

BLOCK = 64
SHARD = 1024
WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MOST_PASSES = 2
#: Rounds of a permutation.
ROUNDS = 16
#: Documents in one layout bucket, about.
LAYOUT = 512
#: Draws that one row unfolds into.
CHUNK = 1 << 14


def permuted(index: Column, size: Column, *seed: Column, back: bool = False) -> Column:
    """index under a pseudorandom permutation of 0 .. size - 1 (swap-or-not); back: under its inverse."""

    def swap(x: Column, turn: Column) -> Column:
        partner = F.pmod(F.pmod(F.xxhash64(*seed, turn), size) - x, size)
        return F.when(F.xxhash64(*seed, turn, F.greatest(x, partner)).bitwiseAND(F.lit(1)) == 1, partner).otherwise(x)

    # a round undoes itself
    turns = F.sequence(F.lit(ROUNDS), F.lit(1)) if back else F.sequence(F.lit(1), F.lit(ROUNDS))
    return F.aggregate(turns, index.cast("long"), swap)


@dataclass(frozen=True)
class Layout:
    """rows: id, source number, content hash, copy, size, start; sources: one row each, with its target."""

    rows: DataFrame
    sources: DataFrame


def with_targets(sources: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST_PASSES) -> DataFrame:
    """Weight and target of each source (columns source, source_size): one row per source, few rows.

    A target is its weight times a common level, at most `most` times its size. The level is found from
    the sources in the order in which they reach their cap: before the first uncapped one, all are capped.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    listed = sources.withColumn("sid", F.row_number().over(by_name))
    turn = F.array(*(F.lit(float(w)) for w in weights))
    cap = F.col("source_size") * F.lit(float(most))
    listed = listed.withColumn("weight", F.element_at(turn, F.pmod(F.col("sid") - 1, F.lit(len(weights))) + 1))
    by_cap = Window.orderBy(cap / F.col("weight"), "sid")
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_cap.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    wanted = F.sum("source_size").over(everything) * F.lit(float(share))
    level = (wanted - F.coalesce(F.sum(cap).over(before), F.lit(0.0))) / F.sum("weight").over(rest)
    leveled = listed.withColumn("__level", level).withColumn(
        "__level", F.min(F.when(cap / F.col("weight") >= F.col("__level"), F.struct(cap / F.col("weight"), "sid", "__level"))).over(everything).getField("__level")
    )
    return leveled.withColumn("target", F.least(cap, F.coalesce(F.col("weight") * F.col("__level"), cap))).drop("__level")


def with_draws(sources: DataFrame, seed: int = 0, block: int = BLOCK) -> DataFrame:
    """Blocks and draws of each source: as many as come nearest to its target in words.

    Whole passes take every word. Of one more pass, blocks are taken up to the target; all hold `block`
    words but the last, which counts from its turn in that pass.
    """
    sized = sources.withColumn("blocks", F.ceil(F.col("source_size") / block).cast("long"))
    passes = F.floor(F.col("target") / F.greatest("source_size", F.lit(1))).cast("long")
    sized = sized.withColumn("__passes", F.least(passes, F.lit(MOST_PASSES)))
    sized = sized.withColumn("__rest", F.col("target") - F.col("__passes") * F.col("source_size"))
    some = F.greatest("blocks", F.lit(1).cast("long"))
    sized = sized.withColumn("__turn", permuted(some - 1, some, F.lit(seed), F.col("sid"), F.col("__passes"), back=True))

    def candidate(more: Column) -> Column:
        n = F.least(F.floor(F.col("__rest") / block) + more, F.col("blocks"))
        words = n * block - F.when(n > F.col("__turn"), F.col("blocks") * block - F.col("source_size")).otherwise(0)
        return F.struct(F.abs(words - F.col("__rest")).alias("off"), n.alias("n"))

    nearest = F.array_min(F.transform(F.array(*(F.lit(k).cast("long") for k in range(3))), candidate))["n"]
    drawn = F.least(F.col("__passes") * F.col("blocks") + nearest, F.col("blocks") * MOST_PASSES)
    # a source with words is never left out by rounding
    drawn = F.when((drawn == 0) & (F.col("target") > 0), F.lit(1).cast("long")).otherwise(drawn)
    return sized.withColumn("draws", drawn).drop("__passes", "__rest", "__turn")


def laid_out(docs: DataFrame, seed: int = 0, block: int = BLOCK, **targets) -> Layout:
    """Sizes, sources and each document's place in its source's run of words."""
    content = F.xxhash64(*(F.col(c) for c, kind in docs.dtypes if not kind.startswith("map")))
    sized = docs.select("doc_id", "source", content.alias("content"), word_count(text_of("text")).alias("size"))
    units = store(sized.groupBy("doc_id", "source", "content", "size").agg(F.count("*").alias("copies")))
    sources = units.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("source_size"))
    numbered = with_draws(with_targets(sources, **targets), seed, block)
    numbered = numbered.withColumn("first_draw", F.sum("draws").over(Window.orderBy("sid")) - F.col("draws"))
    numbered = store(numbered.withColumn("all_draws", F.sum("draws").over(Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))))

    buckets = max(1, units.count() // LAYOUT)
    rows = (
        units.withColumnRenamed("source", "__source")
        .join(numbered.select(F.col("source").alias("__name"), "sid"), F.col("__source").eqNullSafe(F.col("__name")))
        .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
        .select("doc_id", "sid", "content", "copy", "size", F.pmod(F.xxhash64("doc_id", "content"), F.lit(buckets)).alias("bucket"))
    )
    sums = rows.groupBy("sid", "bucket").agg(F.sum("size").alias("words"))
    firsts = sums.select("sid", "bucket", (F.sum("words").over(Window.partitionBy("sid").orderBy("bucket")) - F.col("words")).alias("first"))
    inside = F.sum("size").over(Window.partitionBy("sid", "bucket").orderBy("doc_id", "content", "copy")) - F.col("size")
    placed = rows.withColumn("inside", inside).join(firsts, ["sid", "bucket"])
    return Layout(placed.select("doc_id", "sid", "content", "copy", "size", (F.col("first") + F.col("inside")).alias("start")), numbered)


def slots(sources: DataFrame, seed: int = 0, shard: int = SHARD) -> DataFrame:
    """Every draw: sid, pass, block (its number in the source), slot and shard of the output."""
    chunked = sources.where("draws > 0").withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(draws - 1) div {CHUNK}"))))
    # chunks are few rows; each unfolds into CHUNK draws in the task it is dealt to
    everything = sources.agg(F.max("all_draws")).first()[0] or 0
    chunked = chunked.repartition(1 + everything // (4 * CHUNK), "sid", "chunk")
    last = F.least((F.col("chunk") + 1) * CHUNK, F.col("draws")) - 1
    drawn = chunked.withColumn("draw", F.explode(F.sequence(F.col("chunk") * CHUNK, last)))
    drawn = drawn.withColumn("pass", F.expr("draw div blocks"))
    number = permuted(F.expr("draw % blocks"), F.col("blocks"), F.lit(seed), F.col("sid"), F.col("pass"))
    slot = permuted(F.col("first_draw") + F.col("draw"), F.col("all_draws"), F.lit(seed))
    return drawn.select("sid", "pass", number.alias("block"), slot.alias("slot")).withColumn("shard", F.expr(f"slot div {shard}"))


def shard_counts(drawn: DataFrame) -> DataFrame:
    """Slots of each source in each output shard."""
    return drawn.groupBy("shard", "sid").agg(F.count("*").alias("slots"))


def pieces(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """Each document cut at block ends: block, first word (from 0) and number of words of the piece."""
    cut = rows.where("size > 0").withColumn("block", F.explode(F.sequence(F.expr(f"start div {block}"), F.expr(f"(start + size - 1) div {block}"))))
    first = F.greatest(F.col("block") * block, F.col("start")) - F.col("start")
    after = F.least((F.col("block") + 1) * block, F.col("start") + F.col("size")) - F.col("start")
    return cut.select("doc_id", "sid", "content", "copy", "size", "block", first.alias("first"), (after - first).alias("words"))


def mixed(docs: DataFrame, seed: int = 0, block: int = BLOCK, shard: int = SHARD, **targets) -> DataFrame:
    """Every document's part in the mix: doc_id, size, source_size, target, taken; one row per input row.

    Where the output has it follows: in how many slots (n_slots), from which shard to which (first_shard, last_shard),
    and a digest of its pieces' slots (slots_digest), 0 for a document that isn't taken. All four fold
    before they move, so a document of any length is one row of sums.
    """
    layout = laid_out(docs, seed, block, **targets)
    rows = store(layout.rows)
    drawn = slots(layout.sources, seed, shard).select("sid", "block", "slot", "shard")
    # the draws unfold from a small table, whose size says nothing about theirs: never broadcast them
    joined = pieces(rows, block).join(drawn.hint("merge"), ["sid", "block"])
    sums = {
        "taken": F.sum("words"), "n_slots": F.count("*"), "first_shard": F.min("shard"), "last_shard": F.max("shard"),
        "slots_digest": F.bit_xor(F.xxhash64("slot", "first", "words")),
    }
    taken = joined.groupBy("doc_id", "sid", "content", "copy").agg(*(e.alias(name) for name, e in sums.items()))
    taken = taken.select(F.col("doc_id").alias("__id"), F.col("sid").alias("__sid"), F.col("content").alias("__content"), F.col("copy").alias("__copy"), *sums)
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("sid") == F.col("__sid")) & (F.col("content") == F.col("__content")) & (F.col("copy") == F.col("__copy"))
    whole = rows.join(taken.hint("merge"), same, "left").join(layout.sources.select(F.col("sid").alias("__number"), "source_size", "target"), F.col("sid") == F.col("__number"))
    none = F.lit(0).cast("long")
    counted = [F.coalesce(c, none).alias(c) for c in ("taken", "n_slots")]
    return whole.select("doc_id", "size", "source_size", "target", *counted, "first_shard", "last_shard", F.coalesce("slots_digest", none).alias("slots_digest"))


def mixed_documents(docs: DataFrame, seed: int = 0, block: int = BLOCK, **targets) -> DataFrame:
    """The mix as documents, with the columns of docs: for each pass, the words of a document that it takes.

    A document that a pass takes whole keeps its text as it is; otherwise its taken words are joined
    by spaces. A column n_chars follows the new text.
    """
    layout = laid_out(docs, seed, block, **targets)
    drawn = slots(layout.sources, seed).select("sid", "block", "pass")
    joined = pieces(layout.rows, block).join(drawn.hint("merge"), ["sid", "block"])
    parts = joined.groupBy("doc_id", "content", "copy", "pass", "size").agg(
        F.sort_array(F.collect_list(F.struct("first", "words"))).alias("__parts"), F.sum("words").alias("__taken")
    ).select(whose(F.col("doc_id"), F.col("content")).alias("__of"), "__parts", (F.col("__taken") == F.col("size")).alias("__all"))

    content = F.xxhash64(*(F.col(c) for c, kind in docs.dtypes if not kind.startswith("map")))
    whole = F.struct(*(F.col(c) for c in docs.columns))
    texts = docs.select(whose(F.col("doc_id"), content).alias("__own"), whole.alias("__whole"))
    texts = texts.groupBy("__own").agg(F.any_value("__whole").alias("__whole"))
    met = texts.join(parts.hint("merge"), F.col("__own") == F.col("__of"))
    words = F.split(F.trim(one_space(text_of("__whole.text"))), " ")
    # the words of a text are split once, not once for each of its pieces
    cut = F.transform(
        F.array(words),
        lambda all_words: F.transform("__parts", lambda p: F.array_join(F.slice(all_words, p["first"].cast("int") + 1, p["words"].cast("int")), " ")),
    )
    met = met.withColumn("__text", F.when(F.col("__all"), F.col("__whole.text")).otherwise(F.array_join(F.flatten(cut), " ")))
    changed = {"text": F.col("__text"), "n_chars": F.char_length("__text").cast(dict(docs.dtypes).get("n_chars", "long"))}
    return met.select(*(changed.get(c, F.col(f"__whole.`{c}`")).alias(c) for c in docs.columns))
