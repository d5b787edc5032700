"""Periodic runs of words by internal pattern matching.

A run is a stretch of words with smallest period q, at least max(LEAST, 2 q) words long, that no neighbouring
word extends keeping the period. Every run holds, in its first q words, a dyadic block (2^j words from a
multiple of 2^j on) that stands again q words later. So for each level j and each block the occurrences in the
window of distances that belong to the level are asked for; they give the candidate periods. Each candidate
is extended as far as it goes on both sides, which tells the run exactly.

Occurrences come from a suffix array of the batch and a wavelet matrix over it. Prefix doubling sorts only what is
not yet unique, and puts words of different documents apart from the start; the rank of a place after
j rounds names its first 2^j words and is where their interval of the suffix array begins. Of a block's interval the
wavelet matrix tells the number of places before the window, the first, the next and the last one within. Where there
are more than two they are a progression (they overlap by half or more), so these three give all. Extensions
halve their step through the ranks of all rounds; two places agree in 2^j words where their ranks do.

Work is n log n in the words of a batch plus the candidates, of which a block has one for each of its occurrences
in the window: at most a fixed number for each word and level. Memory is four bytes for each word and
round, and rounds are the logarithm of the longest repetition. A batch holds about SLICE bytes or one
longer text. Nothing is shuffled.

Defined cases: null, empty and blank texts have no words and no runs, and collapse to the empty text. Texts of any
length are read whole. Repeated rows are treated alike, empty tables give empty results. Other columns pass
through; those named like a column made here give way.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plaintlens.llm.common import one_space, text_of

#: The shortest run, in words.
LEAST = 12
#: Texts searched together hold about so many bytes.
SLICE = 4 << 20
MADE = ("runs", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed", "collapsed_sha256")


class Wavelet:
    """A wavelet matrix of a permutation of 0..n-1: counts and quantiles within ranges of places."""

    def __init__(self, values: np.ndarray) -> None:
        self.bits = max(1, int(len(values) - 1).bit_length()) if len(values) else 1
        self.zeros: list[int] = []
        self.ones: list[np.ndarray] = []  # ones before each place, by bit from the highest
        for bit in range(self.bits - 1, -1, -1):
            one = (values >> bit) & 1
            self.ones.append(np.append(0, np.cumsum(one)).astype(np.int32))
            self.zeros.append(len(values) - int(self.ones[-1][-1]))
            values = np.concatenate([values[one == 0], values[one == 1]])

    def below(self, left: np.ndarray, right: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """How many values of each range are below its limit (0..n)."""
        left, right = left.astype(np.int64), right.astype(np.int64)
        count = np.where(limit >> self.bits, right - left, 0)
        for step, bit in enumerate(range(self.bits - 1, -1, -1)):
            ones, zeros = self.ones[step], self.zeros[step]
            one = ((limit >> bit) & 1).astype(bool)
            a, b = ones[left], ones[right]
            count += np.where(one & ~(limit >> self.bits).astype(bool), (right - left) - (b - a), 0)
            left, right = np.where(one, zeros + a, left - a), np.where(one, zeros + b, right - b)
        return count

    def quantile(self, left: np.ndarray, right: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """The value with `rank` smaller ones in its range."""
        left, right, rank = left.astype(np.int64), right.astype(np.int64), rank.astype(np.int64)
        value = np.zeros(len(left), np.int64)
        for step, bit in enumerate(range(self.bits - 1, -1, -1)):
            ones, zeros = self.ones[step], self.zeros[step]
            a, b = ones[left], ones[right]
            small = (right - left) - (b - a)
            one = rank >= small
            rank = np.where(one, rank - small, rank)
            value |= one.astype(np.int64) << bit
            left, right = np.where(one, zeros + a, left - a), np.where(one, zeros + b, right - b)
        return value


def _levels(least: int, longest: int) -> Iterator[tuple[int, int, int]]:
    """(j, first distance, distance beyond the last) for blocks of 2^j words, covering all periods once.

    A block of 2^j words fits before its copy at distance q in any run of period q if 2^(j+1) + q words do.
    """
    q = 1
    while q <= longest:
        j = max(0, (max(least - q, q) // 2).bit_length() - 1)
        # periods up to `least` one by one; beyond, a level's distances in windows no wider than a block
        end = q + 1 if q <= least else min(q + (1 << j), 4 << j, longest + 1)
        yield j, q, end
        q = end


def _doubled(words: np.ndarray, document: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Ranks of the first 1, 2, 4, ... words from every place, and the places in suffix order.

    A rank is the suffix array's first slot of the places that agree; places of different documents never
    agree, nor do unique ones with any. One more place, the end, is unique.
    """
    n = len(words)
    order = np.lexsort((words, document))
    order = np.append(order, n)
    key_doc, key_word = np.append(document, -1), np.append(words, -1)
    new = np.append(True, (key_doc[order][1:] != key_doc[order][:-1]) | (key_word[order][1:] != key_word[order][:-1]))
    slots = np.arange(n + 1)
    first = np.maximum.accumulate(np.where(new, slots, 0))
    rank = np.empty(n + 1, np.int32)
    rank[order] = first
    ranks, width = [rank], 1
    single = new & np.append(new[1:], True)
    active = np.flatnonzero(~single)  # slots of places not yet unique
    while len(active):
        places = order[active]
        key = rank[places].astype(np.int64) * (n + 2) + rank[np.minimum(places + width, n)]
        by_key = np.argsort(key, kind="stable")
        places, key = places[by_key], key[by_key]
        order[active] = places
        new = np.append(True, key[1:] != key[:-1])
        first = np.maximum.accumulate(np.where(new, active, 0))
        rank = rank.copy()
        rank[places] = first
        ranks.append(rank)
        width *= 2
        active = active[~(new & np.append(new[1:], True))]
    return ranks, order


def _extent(ranks: list[np.ndarray], place: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The longest stretch of places around `place` whose words equal those `period` later: first, end."""
    n = len(ranks[0]) - 1
    end, first = place.copy(), place.copy()
    for j in range(len(ranks) - 1, -1, -1):
        rank, width = ranks[j], 1 << j
        there = end + period <= n
        same = there & (rank[np.minimum(end, n)] == rank[np.minimum(end + period, n)])
        end = np.where(same, end + width, end)
        before = first - width
        same = (before >= 0) & (rank[np.maximum(before, 0)] == rank[np.maximum(before, 0) + period])
        first = np.where(same, before, first)
    return first, end


def find_runs(words: np.ndarray, document: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and period of all runs, by start and then period.

    words are numbers of words, document the number of each one's document; a document's words stand together.
    """
    none = (np.zeros(0, np.int64),) * 3
    n = len(words)
    if n < least:
        return none
    ranks, order = _doubled(words, document)
    # only places that agree with another in as many words as the shortest blocks have are of use
    base = ranks[min(min(j for j, _, _ in _levels(least, n)), len(ranks) - 1)]
    in_order = base[order]
    again = np.append(False, in_order[1:] == in_order[:-1])
    used = np.flatnonzero(again | np.append(again[1:], False))
    if not len(used):
        return none
    places = np.sort(order[used])
    wavelet = Wavelet(np.searchsorted(places, order[used]))
    slot = np.append(np.searchsorted(used, np.arange(n + 2)), len(used))  # slots of the suffix array in the matrix

    longest = int(np.bincount(document).max()) // 2
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    sized = -1
    for j, near, far in _levels(least, longest):
        if j >= len(ranks):
            break
        rank = ranks[j]
        if j != sized:
            sizes, sized = np.bincount(rank, minlength=n + 1), j
            repeating = np.arange(0, n, 1 << j)
            repeating = repeating[sizes[rank[repeating]] > 1]
        blocks = repeating
        left, right = slot[rank[blocks]], slot[rank[blocks] + sizes[rank[blocks]]]
        low, high = np.searchsorted(places, blocks + near), np.searchsorted(places, blocks + far)
        some = low < high
        blocks, left, right, low, high = (a[some] for a in (blocks, left, right, low, high))
        if not len(blocks):
            continue
        before = wavelet.below(left, right, low)
        count = wavelet.below(left, right, high) - before
        some = count > 0
        blocks, left, right, before, count = (a[some] for a in (blocks, left, right, before, count))
        if not len(blocks):
            continue
        first = places[wavelet.quantile(left, right, before)]
        last = places[wavelet.quantile(left, right, before + count - 1)]
        step = (last - first) // np.maximum(count - 1, 1)  # a progression
        which = np.repeat(np.arange(len(blocks)), count)
        nth = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
        place, period = blocks[which], first[which] + nth * step[which] - blocks[which]
        begin, end = _extent(ranks, place, period)
        size = end + period - begin
        good = size >= np.maximum(least, 2 * period)
        found.append((begin[good], (end + period)[good], period[good]))
    if not found:
        return none
    start, end, period = (np.concatenate(part) for part in zip(*found, strict=True))
    # of equal stretches the smallest period counts: the others are its multiples
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    fresh = np.append(True, (start[1:] != start[:-1]) | (end[1:] != end[:-1]))[: len(start)]
    start, end, period = start[fresh], end[fresh], period[fresh]
    order = np.lexsort((period, start))
    return start[order], end[order], period[order]


def searched(texts: pa.Array, least: int = LEAST) -> Iterator[tuple[list[tuple[int, int, int]], bytes]]:
    """For each text its runs (start, length, period) and the words outside all runs' later periods."""
    lists = [t.as_buffer().to_pybytes().split() if t.is_valid else [] for t in texts.cast(pa.binary())]
    sizes = np.array([len(ws) for ws in lists], np.int64)
    # texts too short for a run take no part; a separator is not needed, as documents differ
    long = np.flatnonzero(sizes >= least)
    numbers = pa.array([w for k in long for w in lists[k]], pa.binary()).dictionary_encode().indices.to_numpy()
    document = np.repeat(np.arange(len(long)), sizes[long])
    start, end, period = find_runs(numbers.astype(np.int64), document, least)
    firsts = np.cumsum(sizes[long]) - sizes[long]
    of = document[start] if len(start) else np.zeros(0, np.int64)
    edges = np.searchsorted(of, np.arange(len(long) + 1))
    place = {int(k): number for number, k in enumerate(long)}
    for k, ws in enumerate(lists):
        number = place.get(k)
        a, b = (edges[number], edges[number + 1]) if number is not None else (0, 0)
        if a == b:
            yield [], b" ".join(ws)
            continue
        s, e, q = start[a:b] - firsts[number], end[a:b] - firsts[number], period[a:b]
        change = np.zeros(len(ws) + 1, np.int64)
        np.add.at(change, s + q, 1)
        np.add.at(change, e, -1)
        kept = np.cumsum(change[:-1]) == 0
        yield list(zip(s.tolist(), (e - s).tolist(), q.tolist())), b" ".join(w for w, stays in zip(ws, kept) if stays)


KINDS = {
    "runs": "array<struct<start:long,length:long,period:long>>", "n_runs": "long", "start": "long", "length": "long", "period": "long",
    "exponent_milli": "long", "runs_sha256": "string", "collapsed": "string", "collapsed_sha256": "string",
}
ARROW = {
    "runs": pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])),
    **dict.fromkeys(("n_runs", "start", "length", "period", "exponent_milli"), pa.int64()),
    **dict.fromkeys(("runs_sha256", "collapsed", "collapsed_sha256"), pa.string()),
}


def _described(runs: list[tuple[int, int, int]], collapsed: bytes) -> dict:
    """All columns that can be made of a text's runs and what is left of it."""
    start, length, period = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=(None, None, None))
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    return {
        "runs": [dict(zip(("start", "length", "period"), r)) for r in runs], "n_runs": len(runs),
        "start": start, "length": length, "period": period, "exponent_milli": None if period is None else 1000 * length // period,
        "runs_sha256": hashlib.sha256(listed.encode()).hexdigest(),
        "collapsed": collapsed.decode(), "collapsed_sha256": hashlib.sha256(collapsed).hexdigest(),
    }


def periodic_runs(docs: DataFrame, wanted: tuple[str, ...] = MADE, least: int = LEAST) -> DataFrame:
    """docs without text, with the wanted ones of: runs (by start, then period) and their number; start, length,
    period and exponent of the longest (of equals the first, then of smallest period); the text without the
    words that only repeat a run's first period (collapsed); digests of both."""
    others = F.struct(F.lit(0).alias("none"), *(F.col(f"`{c}`") for c in docs.columns if c not in ("text", *MADE)))
    rows = docs.select(others.alias("others"), text_of("text").alias("text"))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            step = max(1, batch.num_rows * SLICE // max(1, batch["text"].nbytes))
            for first in range(0, batch.num_rows, step):
                part = batch.slice(first, step)
                made = [_described(*one) for one in searched(part["text"], least)]
                columns = [pa.array([m[c] for m in made], ARROW[c]) for c in wanted]
                yield pa.RecordBatch.from_arrays([part["others"], *columns], ["others", *wanted])

    schema = rows.select("others", *(F.lit(None).cast(KINDS[c]).alias(c) for c in wanted)).schema
    whole = rows.mapInArrow(search, schema)
    return whole.select(*(F.col(f"others.`{c}`") for c in docs.columns if c not in ("text", *MADE)), *wanted)


def words_of(text: Column) -> Column:
    """The words of a text as an array; none for a blank one."""
    bare = F.trim(one_space(text_of(text)))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, " "))


def repeated(text: Column, doc_id: Column) -> Column:
    """Words joined by one space, where one text in ten repeats a period from some word on to its end.

    By the crc32 of the id: of those divisible by 10, each word from a on is the original word a + (i - a) % p.
    A null id changes nothing.
    """
    crc = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(crc / 10).cast("long")

    def planted(words: Column) -> Column:
        n = F.size(words)
        a = (g % n).cast("int")
        p = (F.floor((n - a) / (g % 8 + 3)) + 1).cast("int")
        again = F.transform(F.sequence(F.lit(0), n - 1 - a), lambda i: F.get(words, a + i % p))
        return F.array_join(F.concat(F.slice(words, F.lit(1), a), again), " ")

    changed = F.element_at(F.transform(F.array(words_of(text)), planted), 1)
    return F.when((crc % 10 == 0) & (F.trim(one_space(text_of(text))) != ""), changed).otherwise(text_of(text))
