"""Document fingerprints by Order MinHash, sensitive to edit distance.

A text is a sequence of pieces: its words, those of more than PIECE characters cut. Runs of RUN pieces
are its k-mers, numbered by occurrence so that a repeated k-mer counts each time. Hashes deal the numbered
k-mers into BINS bins. A fingerprint has a position for each bin: the TUPLE first k-mers from the bin's start
on, in the order of their hashes and around its end, are put back into text order and hashed together to three
digits. Two texts agree in a position if they share its k-mers and have them in the same order. Each position is by itself a
minimal TUPLE-set under a random order (the hashes, turned by the bin's start); positions of texts with
few k-mers have k-mers in common, so their likeness varies more than under BINS independent hashes. Likeness compares
fingerprints, which are written in hexadecimal digits.

All work is built-in expressions. Hash and position share one number, so that a text needs one sort
of numbers; only texts in which a k-mer repeats need a second one, to number the occurrences.

Defined cases: null text counts as empty and has the empty fingerprint, as has a text without words; two empty
fingerprints are alike (1.0). Fewer than RUN pieces are one k-mer, and a single k-mer is hashed alone. Rows are ordered by doc_id, nulls
first, then by content; repeated rows follow each other. A single row is its own next document. Empty tables give empty
results. Texts of any length are read whole; positions past 2**24 count as the last. Extra columns take no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plaintlens.llm.common import store, text_of, whose

PIECE = 16
RUN = 3
BINS = 64
TUPLE = 2
POSITION_BITS = 24
#: Rows of one part of the id order, about.
PART = 4096


def _let(value: Column, body) -> Column:
    """body(value) with the value computed once: a lambda over an array of one."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _runs(pieces: Column) -> Column:
    """Hash of each run of RUN pieces; of all pieces if there are fewer."""

    def joined(hashes: Column) -> Column:
        size = F.size(hashes)
        out = F.slice(hashes, F.lit(1), size - RUN + 1)
        for back in range(1, RUN):
            out = F.zip_with(out, F.slice(hashes, F.lit(back + 1), size - RUN + 1), lambda a, b: F.xxhash64(a, b))
        return F.when(size >= RUN, out).when(size > 0, F.array(F.xxhash64(hashes))).otherwise(F.slice(hashes, F.lit(1), F.lit(0)))

    return _let(F.transform(pieces, lambda p: F.xxhash64(p)), joined)


def _packed(value: Column, position: Column) -> Column:
    """The value's high bits and the position in one number."""
    last = (1 << POSITION_BITS) - 1
    return value.bitwiseAND(F.lit(~last)).bitwiseOR(F.least(position, F.lit(last)).cast("long"))


def _numbered(runs: Column) -> Column:
    """Packed (hash of k-mer and occurrence, position) of each run, when some run repeats.

    Sorted by hash and position, equal runs stand together. How many equal ones stand before each is
    found by doubling: whoever has at least 2**t adds what its 2**t-th predecessor has.
    """

    def number(ordered: Column) -> Column:
        def double(before: Column, turn: Column) -> Column:
            more = F.transform(before, lambda n, i: F.when(n == turn, turn + F.get(before, i - turn)).otherwise(n))
            return F.when(F.array_max(before) >= turn, more).otherwise(before)

        same = F.transform(ordered, lambda x, i: F.when((i > 0) & (F.get(ordered, i - 1)["h"] == x["h"]), 1).otherwise(0))
        turns = F.array(*(F.lit(1 << t) for t in range(31)))
        before = F.aggregate(turns, same, double)
        return F.zip_with(ordered, before, lambda x, n: _packed(F.xxhash64(x["h"], n), x["i"]))

    return _let(F.array_sort(F.transform(runs, lambda h, i: F.struct(h.alias("h"), i.alias("i")))), number)


def _bin(x: Column) -> Column:
    return F.shiftright(x, 64 - (BINS.bit_length() - 1))


def _value(x: Column) -> Column:
    return F.shiftright(x, POSITION_BITS)


def _place(x: Column) -> Column:
    return x.bitwiseAND(F.lit((1 << POSITION_BITS) - 1))


def _in_text_order(x: Column, other: Column) -> Column:
    """Hash of two k-mers, the one that comes first in the text first."""
    return F.when(_place(other) < _place(x), F.xxhash64(_value(other), _value(x))).otherwise(F.xxhash64(_value(x), _value(other)))


def _digits(digest: Column) -> Column:
    return F.lpad(F.hex(digest.bitwiseAND(F.lit(0xFFF))), 3, "0")


def _of_kmers(text: Column, body) -> Column:
    """body(numbered k-mers by hash, places in them at which a bin opens)."""

    def elements(runs: Column) -> Column:
        plain = F.transform(runs, lambda h, i: _packed(F.xxhash64(h, F.lit(0)), i))
        return F.when(F.size(F.array_distinct(runs)) < F.size(runs), _numbered(runs)).otherwise(plain)

    def opened(ordered: Column) -> Column:
        first = lambda x, i: (i == 0) | (_bin(F.get(ordered, F.greatest(i - 1, F.lit(0)))) != _bin(x))
        opens = F.filter(F.transform(ordered, lambda x, i: F.when(first(x, i), i)), lambda i: i.isNotNull())
        return _let(opens, lambda found: body(ordered, found))

    pieces = F.regexp_extract_all(text, F.lit(rf"[^\x20\x09-\x0D]{{1,{PIECE}}}"), F.lit(0))
    return _let(_let(_runs(pieces), elements), lambda found: _let(F.array_sort(found), opened))


def _positions(ordered: Column, opens: Column) -> Column:
    """The digits: for each bin, the TUPLE first k-mers from its start on, around the end of the order."""

    def entry(i: Column) -> Column:
        x, other = F.get(ordered, i), F.get(ordered, F.pmod(i + 1, F.size(ordered)))
        return _digits(F.when(F.size(ordered) == 1, F.xxhash64(_value(x))).otherwise(_in_text_order(x, other)))

    at = lambda i: _bin(F.get(ordered, i)).cast("int")
    # a bin that opens at i is where all bins since the one before find their first k-mer
    since = lambda i, k: F.when(k > 0, at(F.get(opens, F.greatest(k - 1, F.lit(0))))).otherwise(F.lit(-BINS // 2 - 1))
    entries = F.transform(opens, lambda i, k: F.repeat(entry(i), at(i) - since(i, k)))
    rest = F.repeat(entry(F.lit(0)), F.lit(BINS // 2 - 1) - at(F.element_at(opens, -1)))
    return F.when(F.size(opens) == 0, F.lit("")).otherwise(F.concat(F.array_join(entries, ""), rest))


def fingerprint(text: Column) -> Column:
    """The fingerprint of a text, its digits as bytes."""
    return _of_kmers(text, lambda ordered, opens: F.unhex(_positions(ordered, opens)))


def likeness(one: Column, other: Column) -> Column:
    """Share of the positions in which two fingerprints agree."""
    one, other = F.hex(one), F.hex(other)
    digits = [F.regexp_extract_all(s, F.lit(".{3}"), F.lit(0)) for s in (one, other)]
    same = F.size(F.filter(F.zip_with(*digits, lambda a, b: a == b), lambda agree: agree))
    return F.when((one == "") & (other == ""), F.lit(1.0)).otherwise(same / BINS)


def _identity() -> Column:
    """What rows are ordered by: id, nulls first, then content."""
    return F.struct("doc_id", F.xxhash64(text_of("text")).alias("content"))


def _ordered(docs: DataFrame) -> DataFrame:
    """Each row's key (identity and place), length, and its next row's key, by ascending identity.

    Rows are dealt to ranges of the order; only the first row of each range is looked at across ranges.
    """
    rows = docs.select(_identity().alias("own"), F.char_length(text_of("text")).cast("long").alias("n_chars"))
    parts = max(1, docs.count() // PART)
    dealt = rows.repartitionByRange(parts, "own")
    dealt = store(dealt.withColumn("part", F.spark_partition_id()))
    inside = Window.partitionBy("part").orderBy("own")
    key = F.struct("own", "part", "place")
    placed = dealt.withColumn("place", F.row_number().over(inside)).withColumn("key", key)
    placed = placed.withColumn("following", F.lead("key").over(inside))
    firsts = placed.where("place = 1").select("part", "key")
    around = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    next_first = F.coalesce(F.lead("key").over(Window.orderBy("part")), F.first("key").over(around))
    nexts = firsts.select("part", next_first.alias("wrapped"))
    joined = placed.join(nexts, "part").withColumn("following", F.coalesce("following", "wrapped"))
    return joined.select("key", "n_chars", "following")


def edited(docs: DataFrame) -> DataFrame:
    """key, n_chars, following, text and edited text of every row.

    The last half of a text gives way to the beginning of the next one. Texts are moved once, by key;
    what moves besides is the part of the next text that is needed.
    """
    order = _ordered(docs)
    texts = docs.select(whose(F.col("doc_id"), F.xxhash64(text_of("text"))).alias("whose"), text_of("text").alias("text"))
    texts = texts.groupBy("whose").agg(F.any_value("text").alias("text"))

    def of(key: str) -> Column:
        return whose(F.col(f"{key}.own.doc_id"), F.col(f"{key}.own.content")) == F.col("whose")

    half = F.expr("n_chars div 2").cast("int")
    heads = order.join(texts, of("following")).select("key", "n_chars", "following", F.substring("text", F.lit(1), half).alias("head"))
    whole = heads.join(texts, of("key"))
    stays = F.substring("text", F.lit(1), (F.col("n_chars") - half).cast("int"))
    return whole.select("key", "n_chars", "following", "text", F.concat(stays, "head").alias("edited"))


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every document and of its edited text, and the likeness of the first to the second and to the next document's."""
    made = store(
        edited(docs).select(
            "key", "n_chars", "following",
            F.unhex(F.sha2("edited", 256)).alias("edited_sha256"),
            fingerprint(F.col("text")).alias("of_text"),
            fingerprint(F.col("edited")).alias("of_edited"),
        )
    )
    others = made.select(F.col("key.part").alias("n_part"), F.col("key.place").alias("n_place"), F.col("of_text").alias("of_next"))
    met = made.join(others, (F.col("following.part") == F.col("n_part")) & (F.col("following.place") == F.col("n_place")))
    return met.select(
        F.col("key.own.doc_id").alias("doc_id"), "n_chars", F.lower(F.hex("edited_sha256")).alias("edited_sha256"),
        F.hex("of_text").alias("fingerprint"), F.hex("of_edited").alias("edited_fingerprint"),
        likeness(F.col("of_text"), F.col("of_edited")).alias("near_edited"),
        likeness(F.col("of_text"), F.col("of_next")).alias("near_next"),
    )
