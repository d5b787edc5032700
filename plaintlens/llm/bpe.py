"""Byte-level BPE encoding and decoding with higher-order functions.

A text is split into words by the tokenizer's pattern. Each word becomes an array of byte tokens, and a
fold applies merges in rank order: the adjacent pair with the lowest rank, the leftmost of equals,
becomes one token, until no pair has a rank. Ranks come from a constant map in the form of two arrays
(built once on the driver), so that a look-up is two array reads. The map is stored as one row, which a
scalar subquery puts into the query as a constant.
Decoding concatenates the tokens' binary pieces.

The words folded first are the most frequent distinct words of a sample: CACHED words of about SAMPLE documents at
most become a second constant map from word to tokens. It saves folds and changes no result; every
other word is folded where it stands. Nothing is shuffled per document.

Defined cases: null text counts as empty and has no tokens; its decoded bytes are empty. Any length is
encoded whole. Repeated rows are encoded alike, empty tables give empty results, and other columns pass through.
"""

from __future__ import annotations

import base64
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plaintlens.llm.common import drop, store, text_of

#: Words in the word map, at most, and documents they are counted in, about.
CACHED = 400_000
SAMPLE = 60_000
#: Bits of a token id in a map entry.
BITS = 17
TOKEN = (1 << BITS) - 1
#: Columns that `tokenised` makes.
MADE = ("token_ids", "n_tokens", "ids_sha256", "decoded_sha256")
#: The rank of a pair that doesn't merge.
NEVER = 1 << BITS
#: Where the rank starts in the state of a fold: above the token and the place of its first byte.
RANK = 45
#: An empty place of the rank map: never less than NEVER, whatever the left token.
NOTHING = 1 << 34
#: What Unicode calls white space, for a character class; fixed values.
WHITE = r"\t-\r\x20\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000"


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: base64 bytes and rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def pair_table(ranks: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """The rank map of token pairs, as first place of each left token, and a flat table.

    The pair (left, right) is at the left token's first place plus right, where left and the merged token are
    packed in one number. Rows of different left tokens interleave: each takes the first offset at which its
    places are free, rows with most pairs first.
    """
    rows: dict[int, list[tuple[int, int]]] = {}
    for token, rank in ranks.items():
        for cut in range(1, len(token)):
            left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
            if left is not None and right is not None:
                rows.setdefault(left, []).append((right, rank))
    size = max(ranks.values()) + 1
    first, taken = np.zeros(size, np.int32), np.zeros(8 * size, bool)
    flat = np.full(len(taken), NOTHING)
    reached: dict[int, int] = {}  # a row starts where the last one of about its length found room
    for left, row in sorted(rows.items(), key=lambda item: -len(item[1])):
        rights = np.array([right for right, _ in row])
        offset = reached.get(len(row) // 8, 0)
        while True:
            offsets = np.arange(offset, offset + 256)
            if offsets[-1] + size > len(taken):
                taken, flat = np.concatenate([taken, np.zeros(len(taken), bool)]), np.concatenate([flat, np.full(len(flat), NOTHING)])
            free = np.flatnonzero(~taken[offsets[:, None] + rights].any(1))
            if len(free):
                break
            offset += 256
        first[left] = reached[len(row) // 8] = int(offsets[free[0]])
        taken[first[left] + rights] = True
        flat[first[left] + rights] = [(left << BITS) | rank for _, rank in row]
    return first, flat[: int(first.max()) + size]


@dataclass
class Tokenizer:
    """Rank map and pattern; the word map beside the rank map is empty until `with_cache`."""

    ranks: dict[bytes, int]
    pattern: str

    def __post_init__(self) -> None:
        self.first, self.flat = pair_table(self.ranks)
        # of each byte and the next one, and of each byte without a next one: the byte's token, below the rank of the pair
        single = [self.ranks[bytes([b])] for b in range(256)]
        self.start = [(self.ranks.get(bytes([a, b]), NEVER) << RANK) | single[a] for a in range(256) for b in range(256)]
        self.start += [(NEVER << RANK) | token for token in single]
        self.pieces = [""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            self.pieces[rank] = token.hex()
        self.little = [rank.to_bytes(4, "little").hex() for rank in range(len(self.pieces))]
        # the pattern's white space is Unicode's, the engine's is ASCII's
        split = self.pattern.replace(r"[^\s", f"[^{WHITE}").replace(r"[\s", f"[{WHITE}")
        self.split = split.replace(r"\S", f"[^{WHITE}]").replace(r"\s", f"[{WHITE}]")
        self.slots, self.maps = 1, None

    # ---- expressions

    def literal(self, spark: SparkSession) -> Column:
        """The maps as one constant value: a scalar subquery over their stored row.

        Spark reads the row once for each query and sends it to the tasks as it is, without a text form in the
        plan. A subquery can't stand in a higher-order function: select it as a column, and use that in the next select.
        """
        if self.maps is None:
            none = F.lit(None)
            fixed = {n: pa.array(getattr(self, n)) for n in ("first", "flat", "start", "pieces", "little")}
            row = spark.createDataFrame(pa.table({n: pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v) for n, v in fixed.items()}))
            self.maps = store(row.select("*", F.array(none.cast("string")).alias("words"), F.array(none.cast("array<int>")).alias("ids")))
        return self.maps.select(F.struct(*self.maps.columns)).scalar()

    def _entry(self, maps: Column, left: Column, right: Column) -> Column:
        """The place and token of left, with the rank of its pair with right above them.

        The rank is the table's entry less its left token, if that is this one, and NEVER otherwise.
        """
        token = left.bitwiseAND(F.lit(TOKEN))
        entry = F.get(maps["flat"], F.get(maps["first"], token) + right.bitwiseAND(F.lit(TOKEN)))
        rank = F.least(entry.bitwiseXOR(F.shiftleft(token, BITS)), F.lit(NEVER))
        return F.when(right.isNull(), left.bitwiseOR(F.lit(NEVER << RANK))).otherwise(F.shiftleft(rank, RANK).bitwiseOR(left))

    def folded(self, maps: Column, word: Column) -> Column:
        """Tokens of one word by ranked merges.

        The state is one number for each token: the rank of its pair with the next, the place of its first byte, and
        the token itself, so that the least number is the pair to merge.
        """
        characters = F.split(F.decode(word.cast("binary"), "ISO-8859-1"), "")
        codes = F.transform(characters, F.ascii)
        size = F.octet_length(word)
        low = F.lit((1 << RANK) - 1)

        def start(codes: Column) -> Column:
            def entry(code: Column, i: Column) -> Column:
                row = F.coalesce(F.shiftleft(code, 8).bitwiseOR(F.get(codes, i + 1)), code + F.lit(1 << 16))
                return F.get(maps["start"], row).bitwiseOR(F.shiftleft(i.cast("long"), BITS))

            return F.transform(codes, entry)

        def merge(state: Column, _: Column) -> Column:
            def at(least: Column) -> Column:
                def put(p: Column) -> Column:
                    merged = least.bitwiseAND(F.lit((1 << RANK) - 1 - TOKEN)).bitwiseOR(F.shiftright(least, RANK))
                    new = self._entry(maps, merged, F.get(state, p + 1))
                    both = F.when(p > 1, F.array(self._entry(maps, F.get(state, p - 2).bitwiseAND(low), merged), new)).otherwise(F.array(new))
                    # flatten, as concat of arrays is several times slower
                    return F.flatten(F.array(F.slice(state, F.lit(1), F.greatest(p - 2, F.lit(0))), both, F.slice(state, p + 2, size)))

                # counted, as array_position leaves its loop by an exception
                place = F.lit((1 << RANK) - 1 - TOKEN)
                return _let(F.size(F.filter(state, lambda part: part.bitwiseAND(place) <= least.bitwiseAND(place))), put)

            return _let(F.array_min(state), lambda least: F.when(least < F.lit(NEVER << RANK), at(least)).otherwise(state))

        turns = F.slice(F.sequence(F.lit(1), size), F.lit(1), size - 1)
        parts = _let(codes, lambda c: F.aggregate(turns, start(c), merge))
        return F.transform(parts, lambda part: part.bitwiseAND(F.lit(TOKEN)).cast("int"))

    def _encoded(self, text: Column, maps: Column) -> Column:
        words = F.regexp_extract_all(text, F.lit(self.split), F.lit(0))

        def tokens(word: Column, cached: Column, ids: Column) -> Column:
            out = self.folded(maps, word)
            for hashed in (F.xxhash64, F.hash):  # most cached words are in their first place, by hash
                place = F.pmod(hashed(word), F.lit(self.slots))
                out = F.when(F.get(cached, place) == word, F.get(ids, place)).otherwise(out)
            return out

        # the maps' fields are bound once, as reading one makes an object
        return _let(maps["words"], lambda cached: _let(maps["ids"], lambda ids: F.flatten(F.transform(words, lambda w: tokens(w, cached, ids)))))

    def encoded(self, text: Column, maps: Column) -> Column:
        """Token ids of a text; maps is a column selected as `literal`."""
        return _let(maps, lambda maps: self._encoded(text, maps))

    def digested(self, text: Column, maps: Column) -> Column:
        """Token ids of a text, their number, and digests as one struct; maps is a column selected as `literal`."""

        def parts(maps: Column, ids: Column) -> Column:
            digests = [F.sha2(of(ids, maps), 256) for of in (self.packed, self.decoded)]
            return F.struct(*(c.alias(n) for n, c in zip(MADE, (ids, F.size(ids).cast("long"), *digests), strict=True)))

        return _let(maps, lambda maps: _let(self._encoded(text, maps), lambda ids: parts(maps, ids)))

    def decoded(self, ids: Column, maps: Column) -> Column:
        """The bytes of token ids."""
        return F.unhex(_let(maps["pieces"], lambda p: F.array_join(F.transform(ids, lambda i: F.get(p, i)), "")))

    def packed(self, ids: Column, maps: Column) -> Column:
        """Token ids as little-endian unsigned 32-bit integers."""
        return F.unhex(_let(maps["little"], lambda p: F.array_join(F.transform(ids, lambda i: F.get(p, i)), "")))

    # ---- frames

    def with_cache(self, docs: DataFrame, cached: int = CACHED, sample: int = SAMPLE) -> Tokenizer:
        """This tokenizer with the most frequent words of a bounded sample of docs folded beforehand."""
        spark, share = docs.sparkSession, sample / max(1, docs.count())
        some = docs.select("text") if share >= 1 else docs.select("text").sample(share, seed=0)
        words = F.regexp_extract_all(text_of("text"), F.lit(self.split), F.lit(0))
        counted = some.select(F.explode(words).alias("word")).groupBy("word").count()
        often = store(counted.where("count > 1").orderBy(F.desc("count"), "word").limit(cached))
        slots = 3 * often.count() + 1
        spread = often.repartition(2 * spark.sparkContext.defaultParallelism).select("*", self.literal(spark).alias("maps"))
        ids = _let(F.col("maps"), lambda maps: self.folded(maps, F.col("word")))
        # each place has one word: the most frequent of those that it is the first place of, else of the others
        places = [F.struct(F.pmod(hashed("word"), F.lit(slots)).cast("long").alias("place"), F.lit(k).alias("turn")) for k, hashed in enumerate((F.hash, F.xxhash64))]
        tried = spread.select("word", "count", ids.alias("ids")).select("*", F.inline(F.array(*places)))
        best = tried.groupBy("place").agg(F.min_by(F.struct("word", "ids"), F.struct("turn", -F.col("count"), "word")).alias("entry"))
        every = spark.range(slots).join(best, F.col("id") == F.col("place"), "left").select("id", "entry.*")
        table = every.agg(F.array_sort(F.collect_list(F.struct("id", "word", "ids"))).alias("t")).select(F.col("t.word").alias("words"), F.col("t.ids").alias("ids"))
        self.maps, self.slots = store(self.maps.drop("words", "ids").crossJoin(table)), slots
        drop(often)
        return self


def _let(value: Column, body) -> Column:
    """body(value) with the value computed once: a lambda over an array of one."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _with_maps(docs: DataFrame, tokenizer: Tokenizer) -> tuple[list[Column], DataFrame]:
    """The columns that pass through, and docs as these, the text, and the maps as token_ids."""
    others = [F.col(f"`{c}`") for c in docs.columns if c not in ("text", *MADE)]
    maps = tokenizer.literal(docs.sparkSession)
    return others, docs.select(*others, text_of("text").alias("text"), maps.alias("token_ids"))


def encode(docs: DataFrame, tokenizer: Tokenizer) -> DataFrame:
    """docs with a column token_ids in place of text; columns named like those made here give way."""
    others, both = _with_maps(docs, tokenizer)
    return both.select(*others, tokenizer.encoded(F.col("text"), F.col("token_ids")).alias("token_ids"))


def tokenised(docs: DataFrame, tokenizer: Tokenizer) -> DataFrame:
    """encode, with n_tokens and SHA-256 of the packed ids and of the bytes decoded from them."""
    others, both = _with_maps(docs, tokenizer)
    made = both.select(*others, tokenizer.digested(F.col("text"), F.col("token_ids")).alias("token_ids"))
    return made.select(*others, *(F.col("token_ids")[name].alias(name) for name in MADE))
