"""Language identification by prediction by partial matching.

Each language has a context tree over bytes, up to ORDER bytes deep. A node that has seen n symbols, q
of them distinct, predicts a symbol seen c times with c / (n + q) and escapes to the next shorter
context with q / (n + q); below the empty context all bytes are alike. The statistics are frozen
after fitting, so the exact code length of a byte depends on its context alone: it is computed once for
every context and symbol that any language has seen, and texts are scored by looking these lengths up.
The language with the shortest code for the whole text wins.

Fitting reads whole texts of at most SAMPLE rows of each language, those with the smallest hash of
their id. Scoring reads every byte of every text, in slices of bounded size.

Defined cases: null text, and text without a letter, is `und` with score 0; so is every text if nothing
can be learned. Rows without language or id teach nothing. Ties go to the language that sorts first. Repeated
rows are scored alike; extra columns take no part; empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plaintlens.llm.common import in_fold, text_of

#: Bytes of context at most.
ORDER = 3
#: Rows of each language used for fitting, at most.
SAMPLE = 300
#: Bytes that are scored at once.
SLICE = 1 << 20
#: The score is the winner's probability for a text of so many bytes at the same rates.
SCORED_BYTES = 64
UNKNOWN = "und"
#: What stands before each text.
PAD = b" " * ORDER


def _grams(raw: np.ndarray, size: int) -> np.ndarray:
    """The `size` bytes that end at each position from ORDER on, as one number."""
    total = np.zeros(len(raw) - ORDER, np.uint32)
    for back in range(size):
        total |= raw[ORDER - back : len(raw) - back].astype(np.uint32) << np.uint32(8 * back)
    return total


class _Lookup:
    """Rows of costs by number: open addressing, a quarter full at most."""

    def __init__(self, keys: np.ndarray, rows: np.ndarray) -> None:
        self.bits = max(4, int(np.ceil(np.log2(4 * max(1, len(keys))))))
        self.rows = np.vstack([rows, np.zeros((1, rows.shape[1]), np.float32)]).astype(np.float32)
        size = 1 << self.bits
        self.keys, self.row = np.zeros(size, np.uint32), np.full(size, len(keys), np.int32)
        slot, todo = self._slots(keys), np.arange(len(keys))
        while len(todo):
            free = np.flatnonzero(self.row[slot[todo]] == len(keys))
            placed = todo[free]
            self.keys[slot[placed]], self.row[slot[placed]] = keys[placed], placed  # of several, the last stays
            todo = todo[self.row[slot[todo]] != todo]
            slot[todo] = (slot[todo] + 1) % size

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint32(2654435769)) >> np.uint32(32 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The row of each key, or that of zeros after the last."""
        none = len(self.rows) - 1
        slot = self._slots(keys)
        row = self.row[slot]
        wrong = np.flatnonzero((self.keys[slot] != keys) & (row != none))
        while len(wrong):
            slot[wrong] = (slot[wrong] + 1) % len(self.row)
            row[wrong] = self.row[slot[wrong]]
            wrong = wrong[(self.keys[slot[wrong]] != keys[wrong]) & (row[wrong] != none)]
        return row


class Model:
    """Frozen code lengths, in bits, of every context and symbol seen, for all languages at once."""

    def __init__(self, languages: list[str], counts: list[dict[int, tuple[np.ndarray, np.ndarray]]]) -> None:
        """counts: for each language, by order, the grams of order + 1 bytes and how often they came."""
        self.languages = languages
        width = len(languages)
        self.symbols: list[_Lookup] = []
        self.escapes: list[_Lookup] = []
        below, below_keys = np.full((256, width), 8.0), np.arange(256, dtype=np.uint32)
        for order in range(ORDER + 1):
            keys = np.unique(np.concatenate([by[order][0] for by in counts] or [np.zeros(0, np.uint32)]))
            contexts = np.unique(keys >> np.uint32(8))
            shorter = keys & np.uint32((1 << (8 * max(order, 1))) - 1)
            costs = below[np.searchsorted(below_keys, shorter)].copy()
            escape = np.zeros((len(contexts), width))
            for lang, by in enumerate(counts):
                grams, times = by[order]
                own, place = np.unique(grams >> np.uint32(8), return_inverse=True)
                seen, distinct = np.bincount(place, times, len(own)), np.bincount(place, minlength=len(own))
                escape[np.searchsorted(contexts, own), lang] = np.log2((seen + distinct) / distinct)
                costs[:, lang] += escape[np.searchsorted(contexts, keys >> np.uint32(8)), lang]
                costs[np.searchsorted(keys, grams), lang] = np.log2((seen + distinct)[place] / times)
            self.symbols.append(_Lookup(keys, costs))
            self.escapes.append(_Lookup(contexts, escape))
            below, below_keys = costs, keys

    def _costs(self, raw: np.ndarray) -> np.ndarray:
        """Bits of each byte from position ORDER on, by language."""
        order = ORDER
        grams = _grams(raw, order + 1)
        row = self.symbols[order].find(grams)
        bits = self.symbols[order].rows[row]
        todo = np.flatnonzero(row == len(self.symbols[order].rows) - 1)
        while len(todo):
            key = grams[todo]
            bits[todo] += self.escapes[order].rows[self.escapes[order].find(key >> np.uint32(8))]
            order -= 1
            if order < 0:
                bits[todo] += 8
                break
            grams[todo] = key = key & np.uint32((1 << (8 * (order + 1))) - 1)
            row = self.symbols[order].find(key)
            bits[todo] += self.symbols[order].rows[row]
            todo = todo[row == len(self.symbols[order].rows) - 1]
        return bits

    def code_lengths(self, texts: list[bytes]) -> np.ndarray:
        """Bits of each text in each language."""
        out = np.zeros((len(texts), len(self.languages)))
        group, size = [], 0
        for i, text in enumerate(texts):
            for first in range(0, len(text), SLICE):
                piece = (text[first - ORDER : first] if first else PAD) + text[first : first + SLICE]
                group.append((i, piece))
                size += len(piece)
                if size >= SLICE:
                    self._add(out, group)
                    group, size = [], 0
        if group:
            self._add(out, group)
        return out

    def _add(self, out: np.ndarray, group: list[tuple[int, bytes]]) -> None:
        bits = self._costs(np.frombuffer(b"".join(piece for _, piece in group), np.uint8))
        ends = np.cumsum([len(piece) for _, piece in group])
        starts = ends - [len(piece) for _, piece in group]
        # position p of the joined bytes is row p - ORDER; the first ORDER bytes of a piece are context only
        cuts = np.stack([starts, ends - ORDER], 1).ravel()
        sums = np.add.reduceat(np.vstack([bits, np.zeros((1, bits.shape[1]), bits.dtype)]), cuts[: 2 * len(group)], axis=0, dtype=np.float64)
        np.add.at(out, [i for i, _ in group], sums[::2])

    def best(self, texts: list[bytes]) -> tuple[list[str], np.ndarray]:
        bits = self.code_lengths(texts)
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        chosen = bits.argmin(1)
        length = np.array([max(1, len(t)) for t in texts])
        more = (bits - bits.min(1, keepdims=True)) * (SCORED_BYTES / length)[:, None]
        return [self.languages[k] for k in chosen], 1 / np.exp2(-np.minimum(more, 500)).sum(1)


def _counted(docs: DataFrame, most: int) -> DataFrame:
    """lang, size, gram and n: how often each run of 1 to ORDER + 1 bytes came in the sampled rows."""
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    named = docs.where("lang is not null and doc_id is not null")
    chosen = named.select("lang", "doc_id").distinct().withColumn("place", F.row_number().over(order))
    chosen = chosen.where(F.col("place") <= most).select("lang", "doc_id")
    texts = named.join(F.broadcast(chosen), ["lang", "doc_id"]).select("lang", F.lower(text_of("text")).alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist(), strict=True):
                raw = np.frombuffer(PAD + text.encode(), np.uint8)
                for size in range(1, ORDER + 2):
                    grams, times = np.unique(_grams(raw, size), return_counts=True)
                    yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(grams), pa.string()), "size": pa.array(np.full(len(grams), size, np.int32)), "gram": pa.array(grams.astype(np.int64)), "n": pa.array(times.astype(np.int64))})

    counted = texts.mapInArrow(count, "lang string, size int, gram long, n long")
    return counted.groupBy("lang", "size", "gram").agg(F.sum("n").alias("n"))


def train(docs: DataFrame, most: int = SAMPLE) -> Model:
    """Fit on at most `most` rows of each language of docs (doc_id, text, lang)."""
    found = _counted(docs, most).toArrow().to_pandas()
    languages = sorted(found["lang"].unique(), key=lambda name: name.encode())
    counts = []
    for name in languages:
        own = found[found["lang"] == name]
        by = {}
        for order in range(ORDER + 1):
            rows = own[own["size"] == order + 1].sort_values("gram")
            by[order] = (rows["gram"].to_numpy().astype(np.uint32), rows["n"].to_numpy().astype(float))
        counts.append(by)
    return Model(languages, counts)


def identified(docs: DataFrame, model: Model, *kept: str) -> DataFrame:
    """The kept columns of docs with lang_pred and score of its column text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    letters = docs.select(*kept, text_of("text").rlike(r"\p{L}").alias("__letters"), F.lower(text_of("text")).alias("__text"))
    schema = docs.select(*kept, F.lit("").alias("lang_pred"), F.lit(0.0).alias("score")).schema

    def identify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.encode() if has else b"" for t, has in zip(batch["__text"].to_pylist(), batch["__letters"].to_pylist(), strict=True)]
            names, scores = shared.value.best(texts)
            has = np.array(batch["__letters"].to_pylist(), bool)
            names = [name if ok else UNKNOWN for name, ok in zip(names, has, strict=True)]
            columns = [batch[c] for c in kept]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(names, pa.string()), pa.array(np.where(has, scores, 0.0))], [*kept, "lang_pred", "score"])

    return letters.mapInArrow(identify, schema)


def languages(docs: DataFrame, most: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document; one id in five is never learned from."""
    held = in_fold(F.col("doc_id"), 5, 0)
    model = train(docs.select("doc_id", "text", "lang").where(~held), most)
    return identified(docs.select("doc_id", held.alias("held_out"), "text"), model, "doc_id", "held_out")
