"""Language model scores from a bigram trie in Elias-Fano levels, built and queried shard by shard.

The probability of a word after its context is smoothed towards its own: (n(context, word) + STRENGTH
p(word)) / (n(context) + STRENGTH), with p(word) = (c + 0.5) / (N + 0.5 (V + 1)). It falls apart into a part that
only concerns the pair, and one that only concerns the context word. So a shard that holds all occurrences
of a word can score them alone: as a word after its context, and as the context of what follows.

1. Words of the training documents are counted: N, V, and the words with more than one in 1024 of all
   occurrences, of which there are fewer than 1024.
2. Every occurrence (word, context, document) goes to the shard of its word; those of a frequent word are
   dealt out by their context, its count being known to all shards. The occurrences of a batch of
   documents travel in one packed row for each shard.
3. A shard counts its pairs in the training documents, writes its trie with quantised weights to a
   scratch folder of the task, maps the levels into memory, finds every distinct pair by successor search, and
   returns the documents' shares of the scores, packed in one row for each batch; a batch sums its shares. Shards hold about SHARD tokens each, so the model has as many
   shards as the corpus needs, and no task and no driver ever holds it whole.

Words are known by 64-bit hashes, contexts below a word by 40 bits of theirs.

Defined cases: null text counts as empty: its only token is the end. Rows with null ids learn and are not held out.
Repeated rows are scored alike, and each counts in training. Without training documents every count
is 0. An empty table gives an empty result. Any text length is read whole. Extra columns take no part.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plaintlens.llm.common import HEAVY_PARTS, in_fold, store, text_of
from plaintlens.llm.eliasfano import CONTEXT, Trie
from plaintlens.llm.wordhash import mixed, word_hashes

#: Tokens in a shard, about.
SHARD = 2_500_000
#: How many observations the word's own probability is worth.
STRENGTH = 100.0
#: Bytes of text tokenised at once.
SLICE = 3 << 20
END, BEGIN = np.uint64(1), np.uint64(2)
SUMS = ("n_tokens", "n_known", "base_score", "score")


def tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number, token and context of every token: the words of each text, then its end."""
    text, words = word_hashes(texts, lower=True)
    count = np.bincount(text, minlength=len(texts))
    ends = np.cumsum(count + 1) - 1
    word = np.empty(len(words) + len(texts), np.uint64)
    inner = np.ones(len(word), bool)
    inner[ends] = False
    word[inner], word[ends] = words, END
    context = np.concatenate([[BEGIN], word[:-1]])
    context[ends[:-1] + 1] = BEGIN
    return np.repeat(np.arange(len(texts)), count + 1), word, context


def _slices(texts: list[bytes]) -> Iterator[tuple[int, list[bytes]]]:
    first, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= SLICE:
            yield first, texts[first : i + 1]
            first, size = i + 1, 0
    if first < len(texts):
        yield first, texts[first:]


def word_counts(texts: DataFrame) -> DataFrame:
    """word (hash) and n for all tokens of the column text; each batch is summed before it is moved."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [np.unique(tokens(group)[1], return_counts=True) for _, group in _slices([t.encode() for t in batch["text"].to_pylist()])]
            if parts:
                words, back = np.unique(np.concatenate([w for w, _ in parts]), return_inverse=True)
                n = np.bincount(back, np.concatenate([c for _, c in parts]), len(words)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(n)], ["word", "n"])

    return texts.select("text").mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


def shard_of(word: np.ndarray, context: np.ndarray, frequent: np.ndarray, shards: int) -> np.ndarray:
    """A word's shard; that of word and context for frequent words."""
    at = np.minimum(np.searchsorted(frequent, word), max(0, len(frequent) - 1))
    hot = frequent[at] == word if len(frequent) else np.zeros(len(word), bool)
    return (mixed(np.where(hot, word + mixed(context), word)) % np.uint64(shards)).astype(np.int32)


def pack(word: np.ndarray, context: np.ndarray, doc: np.ndarray) -> bytes:
    """Occurrences, sorted by word, then context: distinct words, their numbers, contexts of 5 bytes, documents of 3."""
    new = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
    lengths = np.diff(np.append(new, len(word))).astype(np.uint32)
    five = np.ascontiguousarray(context).view(np.uint8).reshape(-1, 8)[:, :5]
    three = doc.astype(np.uint32).view(np.uint8).reshape(-1, 4)[:, :3]
    head = np.array([len(new), len(word)], np.int64).tobytes()
    body = head + word[new].tobytes() + lengths.tobytes() + five.T.tobytes() + three.T.tobytes()
    return zstandard.ZstdCompressor(level=1).compress(body)


def unpack(block: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct words, their numbers of occurrences, and context and document of each occurrence."""
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(block), np.uint8)
    kinds, n = raw[:16].view(np.int64)
    at = 16 + 8 * kinds
    words, lengths = raw[16:at].view(np.uint64), raw[at : at + 4 * kinds].view(np.uint32)
    at += 4 * kinds
    context = np.zeros((n, 8), np.uint8)
    context[:, :5] = raw[at : at + 5 * n].reshape(5, n).T
    doc = np.zeros((n, 4), np.uint8)
    doc[:, :3] = raw[at + 5 * n : at + 8 * n].reshape(3, n).T
    return words, lengths, context.reshape(-1).view(np.uint64), doc.reshape(-1).view(np.uint32)


ROUTED = ["shard", "slice", "learn", "ids", "block"]


def _row(shard: int, piece: int, learn: np.ndarray, ids: pa.Array | None, kind: pa.DataType, block: bytes | None) -> pa.RecordBatch:
    """One row of routed data: a slice's ids, or its occurrences in one shard."""
    listed = pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids) if ids is not None else pa.nulls(1, pa.list_(kind))
    flags = np.array([len(learn)], np.int32).tobytes() + np.packbits(learn).tobytes()
    return pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([piece]), pa.array([flags], pa.binary()), listed, pa.array([block], pa.binary())], ROUTED)


def _flags(data: bytes) -> np.ndarray:
    """Which documents of a slice are learned from."""
    return np.unpackbits(np.frombuffer(data, np.uint8, offset=4))[: int(np.frombuffer(data, np.int32, 1)[0])].astype(bool)


def _routed(docs: DataFrame, frequent: np.ndarray, shards: int) -> DataFrame:
    """Packed occurrences by shard and slice, and each slice's ids in a row of their own, in any shard.

    docs: id, learn, text. A slice is a run of documents that one task packs together. It is named by the number
    of its first row, given in the one read that also packs it, so that the shares of a document find
    together by slice and place, without its id having to be unique.
    """
    schema = f"shard int, slice long, learn binary, ids array<{dict(docs.dtypes)['id']}>, block binary"

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, learn = batch["row"].to_numpy(), np.array(batch["learn"].to_pylist(), bool)
            kind = batch["id"].type
            for first, group in _slices([t.encode() for t in batch["text"].to_pylist()]):
                doc, word, context = tokens(group)
                shard = shard_of(word, context, frequent, shards)
                context = mixed(context) & np.uint64((1 << CONTEXT) - 1)
                order = np.lexsort((context, word, shard))
                cuts = np.flatnonzero(np.diff(shard[order], prepend=-1, append=shards + 1))
                own = learn[first : first + len(group)]
                piece = int(rows[first])
                yield _row(piece % shards, piece, own, batch["id"][first : first + len(group)], kind, None)
                for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                    part = order[a:b]
                    yield _row(int(shard[part[0]]), piece, own, None, kind, pack(word[part], context[part], doc[part]))

    return docs.withColumn("row", F.monotonically_increasing_id()).mapInArrow(route, schema)


def score_shard(blocks: pa.Table, frequent: np.ndarray, frequent_counts: np.ndarray, total: int, distinct: int, strength: float) -> pa.Table:
    """Build a shard's trie from its training occurrences and score all its occurrences.

    Returns the ids that came along, and for each slice one row with the sums of its documents in this shard.
    """
    named, blocks = blocks.filter(pc.is_null(blocks["block"])), blocks.filter(pc.is_valid(blocks["block"]))
    out = [named.select(["slice", "learn", "ids"]).append_column("sums", pa.nulls(named.num_rows, pa.binary()))]
    if not blocks.num_rows:
        return out[0]
    parts = [unpack(b.as_py()) for b in blocks["block"]]
    flags = [_flags(b.as_py()) for b in blocks["learn"]]
    shift = np.cumsum([0, *map(len, flags)])
    learns = np.concatenate(flags)
    words = np.unique(np.concatenate([p[0] for p in parts]))
    number = np.concatenate([np.repeat(np.searchsorted(words, p[0]), p[1]) for p in parts])
    doc = np.concatenate([p[3] + s for p, s in zip(parts, shift[:-1], strict=True)])
    key = (number.astype(np.uint64) << np.uint64(CONTEXT)) | np.concatenate([p[2] for p in parts])
    del parts
    order = np.argsort(key, kind="stable")  # sorted blocks one after the other: merged, not sorted anew
    key, doc, number = key[order], doc[order], number[order]
    del order
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    learn = learns[doc]
    seen = np.add.reduceat(learn.astype(np.int64), first)
    pair, of_pair = key[first], number[first]
    counted = np.bincount(number, learn, len(words)).astype(np.int64)
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, words), len(frequent) - 1)
        counted = np.where(frequent[at] == words, frequent_counts[at], counted)

    scale = total + 0.5 * (distinct + 1)
    with tempfile.TemporaryDirectory() as folder:
        known = np.flatnonzero(counted > 0)
        place = np.cumsum(counted > 0) - 1
        kept = np.flatnonzero(seen > 0)
        weights = np.log10(seen[kept] + strength * (counted[of_pair[kept]] + 0.5) / scale)
        Trie.save(Path(folder), words[known], counted[known], place[of_pair[kept]], pair[kept] & np.uint64((1 << CONTEXT) - 1), weights)
        trie = Trie(Path(folder))
        index, count = trie.counts(words)
        weight = trie.weights(index[of_pair], pair & np.uint64((1 << CONTEXT) - 1))
        del trie
    own = (count + 0.5) / scale
    weight = np.where(np.isnan(weight), np.log10(strength * own)[of_pair], weight)
    each = np.repeat(weight, np.diff(np.append(first, len(key)))) - np.log10(count + strength)[number]
    n = len(learns)
    sums = [np.bincount(doc, w, n) for w in (None, (count > 0)[number], np.log10(own)[number], each)]
    packed = [pack_sums([v[a:b] for v in sums]) for a, b in zip(shift[:-1], shift[1:], strict=True)]
    out.append(pa.table([blocks["slice"], pa.nulls(blocks.num_rows, pa.binary()), pa.nulls(blocks.num_rows, named["ids"].type), pa.array(packed, pa.binary())], ["slice", "learn", "ids", "sums"]))
    return pa.concat_tables(out)


def pack_sums(sums: list[np.ndarray]) -> bytes:
    """Tokens, known tokens and both sums of the documents that have any: places first, then each sum."""
    there = np.flatnonzero(sums[0])
    kinds = (np.uint32, np.uint32, np.float64, np.float64)
    body = np.array([len(there)], np.int64).tobytes() + there.astype(np.uint32).tobytes()
    return zstandard.ZstdCompressor(level=1).compress(body + b"".join(v[there].astype(k).tobytes() for v, k in zip(sums, kinds, strict=True)))


def unpack_sums(data: bytes) -> tuple[np.ndarray, list[np.ndarray]]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    n, at = int(np.frombuffer(raw, np.int64, 1)[0]), 8
    out = []
    for kind in (np.uint32, np.uint32, np.uint32, np.float64, np.float64):
        out.append(np.frombuffer(raw, kind, n, at))
        at += n * np.dtype(kind).itemsize
    return out[0], out[1:]


def sum_slice(shares: pa.Table) -> pa.Table:
    """The documents of one slice, with their sums over all shards."""
    named, shares = shares.filter(pc.is_null(shares["sums"])), shares.filter(pc.is_valid(shares["sums"]))
    learn = _flags(named["learn"][0].as_py())
    totals = [np.zeros(len(learn), kind) for kind in (np.int64, np.int64, np.float64, np.float64)]
    for data in sorted(s.as_py() for s in shares["sums"]):  # in one order, so that reruns agree to the last bit
        there, sums = unpack_sums(data)
        for total, part in zip(totals, sums, strict=True):
            total[there] += part.astype(total.dtype)
    return pa.table([named["ids"].combine_chunks().flatten(), pa.array(learn), *map(pa.array, totals)], names=["id", "learn", *SUMS])


def scored(docs: DataFrame, strength: float = STRENGTH, shard: int = SHARD) -> DataFrame:
    """id, learn, n_tokens, n_known, train_tokens, base_score and score of every row of docs (id, learn, text).

    `learn` says which rows the model is made of.
    """
    counts = store(word_counts(docs.where("learn").select("text")))
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    often = counts.where(F.col("n") > total / HEAVY_PARTS).collect()
    often = sorted((np.uint64(r["word"] % (1 << 64)), r["n"]) for r in often)
    frequent = np.array([w for w, _ in often], np.uint64)
    frequent_counts = np.array([n for _, n in often], np.int64)
    shards = 1 + int(total // shard)

    def score(blocks: pa.Table) -> pa.Table:
        return score_shard(blocks, frequent, frequent_counts, total, distinct, strength)

    kind = dict(docs.dtypes)["id"]
    shares = _routed(docs, frequent, shards).groupBy("shard").applyInArrow(score, f"slice long, learn binary, ids array<{kind}>, sums binary")
    schema = f"id {kind}, learn boolean, n_tokens long, n_known long, base_score double, score double"
    return shares.groupBy("slice").applyInArrow(sum_slice, schema).withColumn("train_tokens", F.lit(int(total)).cast("long"))


def held_out_scores(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score; one id in five is never learned from."""
    held = in_fold(F.col("doc_id"), 5, 1)
    found = scored(docs.select(F.col("doc_id").alias("id"), (~held).alias("learn"), text_of("text").alias("text")))
    return found.select(
        F.col("id").alias("doc_id"), (~F.col("learn")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )
