"""BPE with word ends: encoding by batched merge rounds in numpy, and decoding.

Many distinct words are encoded at once. Their symbols lie in one flat array. In each round every pair of
neighbours within a word is packed into one key and found by binary search among the sorted keys of all
merges; each word's lowest-ranked pair then merges wherever it occurs in that word, from left to right. Words
without a pair left leave the array. A merge's result takes part in later merges only (checked when the
file is read), so merging all places of a pair in one round gives what merging them one by one gives.

A batch splits its texts at ASCII white space and encodes each distinct piece once: special tokens are cut
out, what is between them is brought into NFC and lower case character by character, and cut into words
by the tokenizer's pattern. No step looks across white space, so pieces can be encoded apart. Nothing
is shuffled or cached; the vocabulary is broadcast, its size is that of the file.

Defined cases: null and empty texts have no tokens and decode to the empty text; so does a null list of
ids. Ids outside the vocabulary decode to nothing. Any length is encoded whole; a word of n characters
takes at most as many rounds as it has different merges, each over the symbols it has left. Repeated
rows are encoded alike, empty tables give empty results. Characters that the installed Unicode tables do
not know yet may be cut otherwise than by a library with newer or older tables. Other columns pass through; those named like a
column made here give way.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plaintlens.llm.common import text_of

#: What Unicode calls white space, for a character class; fixed values.
WHITE = r"\t-\r\x20\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000"
#: Texts encoded together hold about so many bytes.
SLICE = 4 << 20
#: Bits of a token id in a pair's key, and a rank beyond all others.
BITS = 20
NEVER = np.int32(2**31 - 1)
#: Columns that `tokenised` can make.
MADE = ("token_ids", "n_tokens", "ids_sha256", "decoded_sha256")


@cache
def _pattern(pattern: str) -> regex.Pattern:
    return regex.compile(pattern)


def _plain(text: str) -> str:
    """NFC, then lower case of every character by itself: a capital sigma doesn't look at its neighbours."""
    return text.lower() if text.isascii() else unicodedata.normalize("NFC", text).replace("\u03A3", "\u03C3").lower()


def _byte_letters() -> list[str]:
    """The character that stands for each byte: itself where it is visible in Latin-1, else one from 256 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = iter(range(256, 512))
    return [chr(b) if b in visible else chr(next(hidden)) for b in range(256)]


def _gather(flat: np.ndarray, sizes: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The concatenated lists number `wanted` of a flat array of lists, and their sizes."""
    starts = np.cumsum(sizes) - sizes
    taken = sizes[wanted]
    before = np.cumsum(taken) - taken
    return flat[np.repeat(starts[wanted] - before, taken) + np.arange(int(taken.sum()))], taken


@dataclass(frozen=True)
class Tokenizer:
    """Merges as sorted pair keys with their ranks and results, the ids of bytes inside and at the end of words."""

    keys: np.ndarray
    ranks: np.ndarray
    results: np.ndarray
    inner: np.ndarray
    last: np.ndarray
    tokens: pa.Array
    special: dict[str, int]
    pattern: str

    # ---- words

    def merged(self, words: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all words, one after the other, and the number of each. No word is empty."""
        sizes = np.array([len(w) for w in words], np.int64)
        raw = np.frombuffer(b"".join(words), np.uint8)
        symbols, word = self.inner[raw], np.repeat(np.arange(len(sizes)), sizes)
        ends = np.cumsum(sizes) - 1
        symbols[ends] = self.last[raw[ends]]
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(symbols):
            inside = np.append(word[1:] == word[:-1], False)
            key = (symbols << BITS) | np.append(symbols[1:], 0)
            found = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            rank = np.where(inside & (self.keys[found] == key), self.ranks[found], NEVER)
            starts = np.flatnonzero(np.append(True, ~inside[:-1]))
            least = np.repeat(np.minimum.reduceat(rank, starts), np.diff(np.append(starts, len(symbols))))
            open_ = least < NEVER
            if not open_.all():
                done.append((symbols[~open_], word[~open_]))
                symbols, word, rank, least, found = (a[open_] for a in (symbols, word, rank, least, found))
            at = np.flatnonzero((rank == least) & (rank < NEVER))
            # of neighbouring places, which share a symbol, every other one merges
            fresh = np.append(True, np.diff(at) != 1)[: len(at)]
            at = at[(at - np.maximum.accumulate(np.where(fresh, at, 0))) % 2 == 0]
            symbols[at] = self.results[found[at]]
            stays = np.ones(len(symbols), bool)
            stays[at + 1] = False
            symbols, word = symbols[stays], word[stays]
        if not done:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        symbols, word = (np.concatenate(part) for part in zip(*done, strict=True))
        order = np.argsort(word, kind="stable")
        return symbols[order], np.bincount(word, minlength=len(sizes))

    # ---- texts

    def _cut(self, pieces: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
        """Words and special tokens of pieces without white space, coded, and the number in each piece.

        Pieces are cut in one go, joined by line feeds that the pattern finds as well; those with a special
        token, which keeps its case, are cut one by one.
        """
        pieces = pieces.to_pylist()
        cut = _pattern(r"\n|" + self.pattern)
        found: list[str] = []
        first = 0
        for number in [*(k for k, p in enumerate(pieces) if "<" in p and any(t in p for t in self.special)), len(pieces)]:
            if first < number:
                found += cut.findall(_plain("\n".join(pieces[first:number])))
                found.append("\n")
            if number < len(pieces):
                for part in regex.split("(" + "|".join(map(regex.escape, self.special)) + ")", pieces[number]):
                    found += [part] if part in self.special else cut.findall(_plain(part))
                found.append("\n")
            first = number + 1
        coded = pa.array(found, pa.string()).dictionary_encode()
        ends = np.flatnonzero(coded.indices.to_numpy() == coded.dictionary.index("\n").as_py())
        return coded, np.diff(np.append(-1, ends)) - 1

    def encoded(self, texts: pa.Array) -> pa.ListArray:
        """Token ids of each text."""
        lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        pieces = lists.values.dictionary_encode()
        words, in_piece = self._cut(pieces.dictionary)
        known = words.dictionary.to_pylist()
        flat, sizes = self.merged([w.encode() for w in known])
        own = [k for k, w in enumerate(known) if w in self.special]  # cut out whole, so never a plain word
        if own:
            whole = np.split(flat, np.cumsum(sizes)[:-1])
            for k in own:
                whole[k] = np.array([self.special[known[k]]])
            flat, sizes = np.concatenate(whole), np.array([len(w) for w in whole])
        number = words.indices.to_numpy()
        number = number[number != known.index("\n")] if "\n" in known else number
        word_ids, per_word = _gather(flat, sizes, number)
        edges = np.append(0, np.cumsum(per_word))[np.append(0, np.cumsum(in_piece))]
        ids, per_piece = _gather(word_ids, np.diff(edges), pieces.indices.to_numpy())
        ends = np.append(0, np.cumsum(per_piece))[lists.offsets.to_numpy()]
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32()))

    def decoded(self, ids: pa.ListArray) -> pa.Array:
        """The tokens of each list joined by one space."""
        known = self.tokens.take(pc.if_else(pc.and_(pc.greater_equal(ids.values, 0), pc.less(ids.values, len(self.tokens))), ids.values, None))
        if known.null_count:
            kept = known.is_valid().to_numpy(zero_copy_only=False)
            ends = np.append(0, np.cumsum(kept))[ids.offsets.to_numpy()]
            return pc.binary_join(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), known.drop_null()), " ")
        return pc.binary_join(pa.ListArray.from_arrays(ids.offsets, known), " ")


def read_tokenizer(path: str) -> Tokenizer:
    """A tokenizer file with byte-level BPE, word ends, and NFC and lower case before its pattern."""
    with open(path, encoding="utf-8") as file:
        told = json.load(file)
    model, vocab = told["model"], dict(told["model"]["vocab"])
    pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    made = {left + right: rank for rank, (left, right) in enumerate(pairs)}
    if len(made) < len(pairs) or any(made.get(side, -1) >= rank for rank, pair in enumerate(pairs) for side in pair):
        raise ValueError(f"{path}: a merge comes before one that makes its symbols, or makes what another makes")
    special = {t["content"]: t["id"] for t in told["added_tokens"]}
    tokens: list[str | None] = [None] * (1 + max([*vocab.values(), *special.values()]))
    for token, number in {**vocab, **special}.items():
        tokens[number] = token
    keys = np.array([(vocab[a] << BITS) | vocab[b] for a, b in pairs], np.int64)
    order = np.argsort(keys)
    end = model["end_of_word_suffix"]
    split = next(p for p in told["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")["pattern"]["Regex"]
    return Tokenizer(
        keys=keys[order],
        ranks=order.astype(np.int32),
        results=np.array([vocab[a + b] for a, b in pairs], np.int64)[order],
        inner=np.array([vocab[c] for c in _byte_letters()], np.int64),
        last=np.array([vocab[c + end] for c in _byte_letters()], np.int64),
        tokens=pa.array(tokens, pa.string()),
        special=special,
        pattern=split.replace(r"\s", WHITE),
    )


def _sliced(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        step = max(1, batch.num_rows * SLICE // max(1, batch[column].nbytes))
        for first in range(0, batch.num_rows, step):
            yield batch.slice(first, step)


def _sha256(values: pa.Array) -> pa.Array:
    return pa.array([hashlib.sha256(v.as_buffer() or b"").hexdigest() for v in values.cast(pa.binary())], pa.string())


def _others(docs: DataFrame, *gone: str) -> Column:
    return F.struct(F.lit(0).alias("none"), *(F.col(f"`{c}`") for c in docs.columns if c not in gone)).alias("others")


def tokenised(docs: DataFrame, tokenizer: Tokenizer, wanted: Sequence[str] = MADE) -> DataFrame:
    """docs without text, with the wanted ones of: token_ids, n_tokens, SHA-256 of the decimal ids joined by
    one space, and SHA-256 of the text decoded from them."""
    shared = docs.sparkSession.sparkContext.broadcast(tokenizer)
    kinds = {"token_ids": "array<int>", "n_tokens": "long", "ids_sha256": "string", "decoded_sha256": "string"}
    rows = docs.select(_others(docs, "text", *MADE), text_of("text").alias("text"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numerals = None
        for part in _sliced(batches, "text"):
            ids = shared.value.encoded(part["text"])
            made = {"token_ids": ids, "n_tokens": pc.list_value_length(ids).cast(pa.int64())}
            if "ids_sha256" in wanted:
                numerals = pa.array(np.arange(len(shared.value.tokens)).astype(str), pa.string()) if numerals is None else numerals
                made["ids_sha256"] = _sha256(pc.binary_join(pa.ListArray.from_arrays(ids.offsets, numerals.take(ids.values)), " "))
            if "decoded_sha256" in wanted:
                made["decoded_sha256"] = _sha256(shared.value.decoded(ids))
            yield pa.RecordBatch.from_arrays([part["others"], *(made[c] for c in wanted)], ["others", *wanted])

    schema = rows.select("others", *(F.lit(None).cast(kinds[c]).alias(c) for c in wanted)).schema
    whole = rows.mapInArrow(encode, schema)
    kept = [F.col(f"others.`{c}`") for c in docs.columns if c not in ("text", *MADE)]
    return whole.select(*kept, *wanted)


def detokenised(docs: DataFrame, tokenizer: Tokenizer) -> DataFrame:
    """docs with a column text decoded from token_ids; an earlier text gives way."""
    shared = docs.sparkSession.sparkContext.broadcast(tokenizer)
    rows = docs.select(_others(docs, "text"), F.coalesce("token_ids", F.array().cast("array<int>")).alias("ids"))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _sliced(batches, "ids"):
            ids = part["ids"]
            flat = pa.ListArray.from_arrays(pc.subtract(ids.offsets, ids.offsets[0]), ids.flatten())
            yield pa.RecordBatch.from_arrays([part["others"], shared.value.decoded(flat)], ["others", "text"])

    whole = rows.mapInArrow(decode, rows.select("others", F.lit("").alias("text")).schema)
    return whole.select(*(F.col(f"others.`{c}`") for c in docs.columns if c != "text"), "text")
