"""Ranked lexical search by dual-tree branch and bound.

A document's coordinate for a term is the term's weight times its saturated frequency, an item has 0 or 1
there, and the score is their inner product. Items stand in one tree, the documents of a slice in another;
each node holds its rows' coordinate maxima. A pair of nodes bounds every score between its items and its
documents by the inner product of the two maxima. Pairs are opened from the highest bound on; one whose
bound lies below the weakest k-th score of its items goes with all rows under it, unscored. At equality
the ids decide, as they decide ties. What remains is scored in whole numbers, so the result is exact.

One read of the texts keeps, for each document, its length and the frequencies of the items' terms; sums
over that table give the document frequencies. A search of about SEED random documents gives each item a k-th
score that no result lies below; all tasks start from it, so that most batches go unscored however few documents a
task has. Slices are searched where they lie; a task carries its k-th scores from slice to slice and returns at
most k rows for each item, which are merged in two steps. The driver and each task hold a block of the items at a time: about BLOCK (item, term) pairs, or one
item that has more. More items make more blocks, each read against all documents.

Defined cases: null text has no term, and documents without terms are neither counted nor found. Rows of
documents that repeat, also in their id, are documents of their own; ties go to the smaller id, a null id
comes last. Rows of one item id are one item with the terms of all of them; a null id is an item. Items
without terms, or without a document that shares a term of positive weight, have no rows. Empty tables
give empty results, extra columns take no part, and texts of any length are read whole.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plaintlens.llm.common import drop, store, text_of

#: Results for each item.
MOST = 50
#: (item, term) pairs searched at a time, about.
BLOCK = 1 << 15
#: Rows in a leaf of either tree, and children of an inner node of documents.
ITEM_LEAF, DOC_LEAF, FAN = 8, 16, 8
#: Documents in a slice at most, and cells in the maxima of its leaves.
SLICE, CELLS = 8192, 1 << 23
#: Documents, about, whose k-th scores every task starts from.
SEED = 20_000
#: Parts in which the rows found for one item are merged first.
PARTS = 16
#: What a term consists of, ASCII letters being lower case: ASCII letters and digits and everything beyond ASCII.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Bytes of a text with ASCII in lower case and everything that separates terms as a space.
PLAIN = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)).lower()


def terms_of(text: Column) -> Column:
    """The terms of a text, with repeats."""
    return F.regexp_extract_all(F.translate(text_of(text), UPPER, UPPER.lower()), F.lit(TERM), F.lit(0))


# ---- items


@dataclass(frozen=True)
class Items:
    """Items in the order of their tree. A node is (first, end, terms, children); terms are sorted numbers.

    `inside` has, for each leaf, which of its terms (rows) which of its items (columns) holds.
    """

    ids: list[int | None]
    nodes: list[tuple[int, int, np.ndarray, tuple[int, ...]]]
    inside: dict[int, np.ndarray]


def item_tree(ids: list[int | None], terms: list[np.ndarray]) -> Items:
    """A tree over items: a node parts by the term that halves it best, down to ITEM_LEAF items."""
    order: list[int] = []
    nodes: list = []

    def grow(members: list[int]) -> int:
        number, first = len(nodes), len(order)
        nodes.append(None)
        all_terms, having = np.unique(np.concatenate([terms[i] for i in members]), return_counts=True)
        children: tuple[int, ...] = ()
        if len(members) <= ITEM_LEAF:
            order.extend(members)
        else:
            best = all_terms[np.argmin(abs(2 * having - len(members)))]
            with_it = [i for i in members if best in terms[i]]
            chosen = set(with_it)
            without = [i for i in members if i not in chosen]
            if not without:  # every term is everywhere: any halves do
                with_it, without = members[: len(members) // 2], members[len(members) // 2 :]
            children = (grow(with_it), grow(without))
        nodes[number] = (first, len(order), all_terms, children)
        return number

    if ids:
        grow(list(range(len(ids))))
    leaves = {
        k: np.stack([np.isin(all_terms, terms[i]) for i in order[first:end]], 1).astype(float)
        for k, (first, end, all_terms, children) in enumerate(nodes) if not children
    }
    return Items([ids[i] for i in order], nodes, leaves)


# ---- documents


class Best:
    """The k best documents of each item so far: score, null id, id, ordered as results are."""

    def __init__(self, least: np.ndarray, most: int) -> None:
        """least: a score for each item, 1 or more, that its results have at least."""
        self.most = most
        self.found = [(np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64)) for _ in least]
        self.score, self.none, self.id = least.copy(), np.ones(len(least), bool), np.full(len(least), 2**63 - 1)

    def beaten(self, first: int, end: int, bound: int | np.ndarray, none: bool, least: int) -> np.ndarray:
        """For each item of a range, whether nothing of at most this score and at least this id is a result."""
        kth, kth_none, kth_id = self.score[first:end], self.none[first:end], self.id[first:end]
        later = (none & ~kth_none) | ((none == kth_none) & (least > kth_id))
        return (bound < kth) | ((bound == kth) & later)

    def add(self, item: int, score: np.ndarray, none: np.ndarray, ids: np.ndarray) -> None:
        strong = score >= self.score[item]
        if not strong.any():
            return
        score, none, ids = (np.concatenate([a, b[strong]]) for a, b in zip(self.found[item], (score, none, ids)))
        order = np.lexsort((ids, none, -score))[: self.most]
        self.found[item] = score[order], none[order], ids[order]
        if len(order) == self.most:
            self.score[item], self.none[item], self.id[item] = (a[order[-1]] for a in (score, none, ids))


class Slice:
    """Documents in a tree: `sizes` entries each of (term, value), values being whole and positive."""

    def __init__(self, ids: np.ndarray, none: np.ndarray, sizes: np.ndarray, term: np.ndarray, value: np.ndarray, n_terms: int) -> None:
        row = np.repeat(np.arange(len(ids)), sizes)
        # documents with the same strongest term, then those with like values there, stand together
        strongest = np.lexsort((term, -value, row))[np.cumsum(sizes) - sizes]  # its entry of highest value
        order = np.lexsort((none, ids, -value[strongest], term[strongest]))
        place = np.empty(len(ids), np.int64)
        place[order] = np.arange(len(ids))
        by_place = np.argsort(place[row], kind="stable")
        self.ids, self.none = ids[order], none[order]
        self.row, self.term, self.value = place[row][by_place], term[by_place], value[by_place]
        self.starts = np.append(0, np.cumsum(sizes[order]))
        leaves = -(-len(ids) // DOC_LEAF)
        maxima = np.zeros((leaves, n_terms), np.int64)
        np.maximum.at(maxima, (self.row // DOC_LEAF, self.term), self.value)
        firsts = np.arange(0, len(ids), DOC_LEAF)
        has_id = np.where(self.none, 2**63 - 1, self.ids)
        self.levels = [(maxima, np.minimum.reduceat(has_id, firsts), np.minimum.reduceat(self.none, firsts))]
        while len(self.levels[-1][0]) > 1:
            firsts = np.arange(0, len(self.levels[-1][0]), FAN)
            below, least, none_ = self.levels[-1]
            self.levels.append((np.maximum.reduceat(below, firsts), np.minimum.reduceat(least, firsts), np.minimum.reduceat(none_, firsts)))

    def search(self, items: Items, best: Best) -> int:
        """Enter this slice's documents into the best; returns the number of pairs of leaves that were scored."""
        top = len(self.levels) - 1
        scored = 0
        bound = int(self.levels[top][0][0][items.nodes[0][2]].sum())
        queue = [(-bound, 0, top, 0)]
        while queue:
            bound, node, level, place = heapq.heappop(queue)
            first, end, terms, children = items.nodes[node]
            maxima, least, none = self.levels[level]
            if bound == 0 or best.beaten(first, end, -bound, bool(none[place]), int(least[place])).all():
                continue
            if not children and not level:
                scored += self._score(items, node, place, best)
            elif children and (not level or end - first >= DOC_LEAF * FAN**level):
                for child in children:
                    heapq.heappush(queue, (-int(maxima[place][items.nodes[child][2]].sum()), child, level, place))
            else:
                below = self.levels[level - 1][0][place * FAN : place * FAN + FAN]
                for k, sum_ in enumerate(below[:, terms].sum(1)):
                    heapq.heappush(queue, (-int(sum_), node, level - 1, place * FAN + k))
        return scored

    def _score(self, items: Items, node: int, leaf: int, best: Best) -> bool:
        """Score the leaf's documents for those of the node's items whose own bound passes."""
        first, end, terms, _ = items.nodes[node]
        maxima, least, none = (a[leaf] for a in self.levels[0])
        inside = items.inside[node]
        going = ~best.beaten(first, end, (maxima[terms] @ inside).astype(np.int64), bool(none), int(least))
        if not going.any():
            return False
        rows = slice(leaf * DOC_LEAF, min(len(self.ids), (leaf + 1) * DOC_LEAF))
        entries = slice(self.starts[rows.start], self.starts[rows.stop])
        column = np.minimum(np.searchsorted(terms, self.term[entries]), len(terms) - 1)
        there = terms[column] == self.term[entries]
        values = np.zeros((rows.stop - rows.start, len(terms)))
        values[self.row[entries][there] - rows.start, column[there]] = self.value[entries][there]
        scores = (values @ inside[:, going]).astype(np.int64)  # whole numbers far below 2**53: exact in doubles
        for item, score in zip(first + np.flatnonzero(going), scores.T):
            best.add(item, score, self.none[rows], self.ids[rows])
        return True


# ---- frames


def counted(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """doc_id, n_terms and, for terms of the vocabulary, number and frequency; documents without terms go."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of("text").alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value.get
        for batch in batches:
            ids, sizes, terms, freqs = [], [], [], []
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"]):
                words = text.as_buffer().to_pybytes().translate(PLAIN).split()
                if words:
                    known = np.array([k for k in map(number, words) if k is not None], np.int32)
                    term, freq = np.unique(known, return_counts=True)
                    ids.append(doc_id)
                    sizes.append(len(words))
                    terms.append(term)
                    freqs.append(freq)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(terms, pa.list_(pa.int32())), pa.array(freqs, pa.list_(pa.int64()))],
                ["doc_id", "n_terms", "terms", "freqs"],
            )

    return rows.mapInArrow(count, "doc_id long, n_terms long, terms array<int>, freqs array<long>")


def found(
    rows: DataFrame, items: Items, weights: np.ndarray, documents: int, length: int, most: int, least: np.ndarray
) -> DataFrame:
    """item_id, doc_id, score: the best documents of each item, task by task, of those that reach its least score."""
    shared = rows.sparkSession.sparkContext.broadcast((items, weights, least))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, weights, least = shared.value
        best = Best(least, most)
        step = max(DOC_LEAF * FAN, min(SLICE, DOC_LEAF * CELLS // max(1, len(weights))))
        for batch in batches:
            for first in range(0, batch.num_rows, step):
                part = batch.slice(first, step)
                sizes = np.diff(part["terms"].offsets.to_numpy())
                term = part["terms"].flatten().to_numpy()
                freq = part["freqs"].flatten().to_numpy()
                norm = 50 + 50 * part["n_terms"].to_numpy() * documents // length
                value = weights[term] * (10**9 * freq // (1000 * freq + 20 * np.repeat(norm, sizes)))
                use = value > 0
                sizes = np.bincount(np.repeat(np.arange(len(sizes)), sizes)[use], minlength=len(sizes))
                some = sizes > 0
                if some.any():
                    none = part["doc_id"].is_null().to_numpy(zero_copy_only=False)
                    ids = part["doc_id"].fill_null(0).to_numpy()
                    Slice(ids[some], none[some], sizes[some], term[use], value[use], len(weights)).search(items, best)
        for item, (score, none, ids) in zip(items.ids, best.found):
            if len(ids):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([item] * len(ids), pa.int64()), pa.array(ids, pa.int64(), mask=none), pa.array(score, pa.int64())],
                    ["item_id", "doc_id", "score"],
                )

    return rows.mapInArrow(search, "item_id long, doc_id long, score long")


def _best(rows: DataFrame, most: int) -> DataFrame:
    """The best rows of each item and their ranks, those of each of PARTS parts of the documents first."""
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    part = F.pmod(F.xxhash64("doc_id"), F.lit(PARTS))
    in_part = rows.withColumn("rank", F.row_number().over(Window.partitionBy("item_id", part).orderBy(*order)))
    left = in_part.where(F.col("rank") <= most).drop("rank")
    ranked = left.withColumn("rank", F.row_number().over(Window.partitionBy("item_id").orderBy(*order)))
    return ranked.where(F.col("rank") <= most).select("item_id", "rank", "doc_id", "score")


def ranked(docs: DataFrame, items: DataFrame, most: int = MOST, block: int = BLOCK) -> DataFrame:
    """item_id, rank, doc_id and score of the `most` documents that score highest for each item.

    docs has doc_id and text, items has item_id and text; both ids are whole numbers.
    """
    spark = docs.sparkSession
    pairs = items.select(F.col("item_id").cast("long").alias("item_id"), F.explode(terms_of(F.col("text"))).alias("term"))
    pairs = store(pairs.distinct())
    blocks = max(1, -(-pairs.count() // block))
    parts = []
    for number in range(blocks):
        mine = pairs.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == number).toArrow()
        coded = mine["term"].combine_chunks().dictionary_encode()
        if not len(coded):
            continue
        of_item: dict[int | None, list[int]] = {}
        for item, term in zip(mine["item_id"].to_pylist(), coded.indices.to_pylist()):
            of_item.setdefault(item, []).append(term)
        tree = item_tree(list(of_item), [np.sort(np.array(t, np.int32)) for t in of_item.values()])
        vocabulary = {t.encode(): k for k, t in enumerate(coded.dictionary.to_pylist())}
        rows = store(counted(docs, vocabulary))
        documents, length = rows.agg(F.count("*"), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
        having = np.zeros(len(vocabulary), np.int64)
        for term, count in rows.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
            having[term] = count
        weights = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * int(df) + 1))) for df in having], np.int64)
        if not documents:
            continue
        least = np.ones(len(tree.ids), np.int64)
        if documents > 2 * SEED:
            some = found(rows.sample(SEED / documents, seed=0), tree, weights, documents, length, most, least)
            place = {item: k for k, item in enumerate(tree.ids)}
            for row in _best(some, most).where(F.col("rank") == most).collect():
                least[place[row["item_id"]]] = row["score"]
        parts.append(_best(found(rows, tree, weights, documents, length, most, least), most))
    drop(pairs)
    empty = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return reduce(DataFrame.unionByName, parts) if parts else empty
