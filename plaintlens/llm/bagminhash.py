"""Near-duplicates by BagMinHash signatures, bands, and verified multiset overlap.

A text is the multiset of its runs of five words (all its words, if fewer). Two texts are linked when
the multisets overlap by SIMILARITY or more: sum of smaller counts over sum of larger ones. Classes are the
connected components of the links.

Signatures: every shingle and weight level has a Poisson process of points, each with a time, one of
SIZE positions and a weight within the level. Levels are the intervals (0, 1], (1, 2], (2, 4], (4, 8], ...; a
level that a count covers in part keeps the points below the count. A position's value is the
first time of any point there, so two texts agree in it with a probability equal to their weighted
Jaccard similarity. Points later than any position can need are never drawn: the number drawn follows
SIZE, not the text.

Bands of ROWS values give bucket keys. At a similarity of 0.8, no bucket is shared with probability
(1 - 0.8**4)**24 = 3e-6. Texts that are equal up to white space are one node from the start. The first node of each bucket
stands for it. Each node is compared with the smallest of those that stand for its buckets; after connecting what
overlaps, with the others whose class is another one. The nodes of buckets that still hold several classes are compared
across classes, where they share a bucket and one of their rarest shingles, and where enough of the shingles after that one
are left in both: exact conditions for the overlap, which texts with a frequent passage in common don't meet. So every
pair that shares a bucket and overlaps is connected. There is no cap on buckets or partners, and no pairs within one class.

Defined cases: null text counts as empty; texts without words are one class. A class's id is the
smallest id in it, nulls last; repeated rows are in one class and one of them is kept. Empty tables
give empty results. Very long texts are handled whole, one at a time if need be. Extra columns take no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plaintlens.llm.common import one_space, store, text_of
from plaintlens.llm.wordhash import GOLDEN, mixed, word_hashes

WORDS = 5
SIMILARITY = 0.8
BANDS, ROWS = 24, 4
SIZE = BANDS * ROWS
#: Bytes of text whose shingles are made at once.
SLICE = 4 << 20
#: Shingles of pairs that are compared at once, about.
PAIRED = 1 << 20
#: Buckets of the bounded set that keeps texts without a candidate from being moved.
FILTER = 1 << 20


def shingles(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Text number and hash of each run of WORDS words; words are parted by spaces."""
    text, word = word_hashes(texts)
    if not len(word):
        return text, word
    count = np.bincount(text, minlength=len(texts))
    first = np.cumsum(count) - count
    whole = word.copy()
    for back in range(1, WORDS):
        whole[: len(word) - back] = mixed(whole[: len(word) - back] * GOLDEN + word[back:])
    last = len(word) - WORDS + 1
    full = np.flatnonzero(text[: max(0, last)] == text[WORDS - 1 :]) if last > 0 else np.zeros(0, np.int64)
    short = np.flatnonzero((count > 0) & (count < WORDS))
    few = []
    for t in short:
        x = word[first[t] : first[t] + 1]
        for back in range(1, count[t]):
            x = mixed(x * GOLDEN + word[first[t] + back : first[t] + back + 1])
        few.append(mixed(x + np.uint64(1))[0])
    texts_of = np.concatenate([text[full], short])
    hashes = np.concatenate([whole[full], np.array(few, np.uint64)])
    order = np.argsort(texts_of, kind="stable")
    return texts_of[order], hashes[order]


def weighted(text: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text with their counts."""
    order = np.lexsort((hashes, text))
    text, hashes = text[order], hashes[order]
    new = np.concatenate([[True], (text[1:] != text[:-1]) | (hashes[1:] != hashes[:-1])]) if len(text) else np.zeros(0, bool)
    at = np.flatnonzero(new)
    return text[at], hashes[at], np.diff(np.append(at, len(text)))


def signatures(text: np.ndarray, hashes: np.ndarray, counts: np.ndarray, texts: int) -> np.ndarray:
    """First times at SIZE positions for each text; infinite for texts without shingles."""
    out = np.full((texts, SIZE), np.inf)
    weight = np.bincount(text, counts, texts)
    levels = [np.zeros(len(text), np.int64)]
    element = [np.arange(len(text))]
    level = 1
    while (more := np.flatnonzero(counts > (1 << (level - 1)))).size:
        levels.append(np.full(len(more), level))
        element.append(more)
        level += 1
    of, level = np.concatenate(element), np.concatenate(levels)
    low = np.where(level > 0, np.left_shift(1, np.maximum(level - 1, 0)), 0)
    width = np.maximum(low, 1)
    seed = mixed(hashes[of] + level.astype(np.uint64) * np.uint64(0xD1342543DE82EF95))
    room = counts[of] - low
    doc = text[of]
    horizon = np.zeros(texts)
    todo = weight > 0
    horizon[todo] = SIZE * (np.log(SIZE) + 4) / weight[todo]
    flat = out.ravel()
    while todo.any():
        active = np.flatnonzero(todo[doc])
        now, turn = np.zeros(len(active)), 0
        while len(active):
            turn += 1
            random = mixed(seed[active] + np.uint64(turn * 0x9E3779B97F4A7C15 % (1 << 64)))
            now = now - np.log((np.right_shift(random, np.uint64(11)).astype(np.float64) + 0.5) / 2**53) / width[active]
            stay = now <= horizon[doc[active]]
            active, now, random = active[stay], now[stay], random[stay]
            other = mixed(random)
            position = (np.right_shift(other, np.uint64(32)) * np.uint64(SIZE)) >> np.uint64(32)
            share = (other & np.uint64(0xFFFFFFFF)).astype(np.float64) / 2**32
            there = np.floor(share * width[active]) < room[active]
            np.minimum.at(flat, doc[active[there]] * SIZE + position[there].astype(np.int64), now[there])
        todo = np.isinf(out).any(1) & (weight > 0)
        horizon[todo] *= 2
    return out


def band_keys(signature: np.ndarray) -> np.ndarray:
    """One key for each band of each signature."""
    bits = signature.view(np.uint64).reshape(len(signature), BANDS, ROWS)
    key = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), bits.shape[:2])
    for row in range(ROWS):
        key = mixed(key * GOLDEN + bits[:, :, row])
    return key.view(np.int64)


def _groups(texts: list[bytes]) -> Iterator[list[bytes]]:
    group, size = [], 0
    for text in texts:
        group.append(text)
        size += len(text)
        if size >= SLICE:
            yield group
            group, size = [], 0
    if group:
        yield group


def signed(docs: DataFrame) -> DataFrame:
    """doc_id, digest of the normalised text, number of shingles, and band keys."""
    norm = F.trim(one_space(text_of("text")))
    kind = dict(docs.dtypes)["doc_id"]

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first = 0
            for group in _groups([t.encode() for t in batch["norm"].to_pylist()]):
                text, hashes, counts = weighted(*shingles(group))
                keys = band_keys(signatures(text, hashes, counts, len(group)))
                total = np.bincount(text, counts, len(group)).astype(np.int64)
                rows = [k if n else [] for k, n in zip(keys, total, strict=True)]
                part = batch.slice(first, len(group))
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], part["digest"], pa.array(total), pa.array(rows, pa.list_(pa.int64()))], ["doc_id", "digest", "weight", "keys"]
                )
                first += len(group)

    prepared = docs.select("doc_id", F.unhex(F.md5(norm)).alias("digest"), norm.alias("norm"))
    return prepared.mapInArrow(sign, f"doc_id {kind}, digest binary, weight long, keys array<long>")


def components(links: DataFrame) -> DataFrame:
    """node and root (its component's smallest node) of every linked node: large-star and small-star rounds.

    links has columns a and b. A hot node's neighbours are folded to their minimum before they are moved;
    both sides of each join are stored tables, so that adaptive execution sees their true sizes and
    splits a hot node's rows.
    """
    edges = store(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct())
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        edges = _star(_star(both, F.col("v") > F.col("u")), F.lit(True))
        # settled when every node has one neighbour and no root has any
        seen = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
            edges.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))
        )
        sides = seen.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
        if sides.where("up > 1 or (up > 0 and down > 0)").isEmpty():
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _star(edges: DataFrame, which) -> DataFrame:
    """Connect the chosen neighbours of each u, and u itself, to the smallest of them."""
    least = store(edges.groupBy("u").agg(F.least(F.min("v"), F.min("u")).alias("m")))
    linked = edges.where(which).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = least.select("u", F.col("m").alias("v"))
    return store(linked.unionByName(own).where("u != v").distinct())


def overlaps(one: pa.Array, other: pa.Array) -> np.ndarray:
    """Weighted Jaccard similarity of each pair of normalised texts; each distinct text is cut once."""
    coded = pa.concat_arrays([one.cast(pa.string()), other.cast(pa.string())]).dictionary_encode()
    texts = len(coded.dictionary)
    text, hashes, counts = weighted(*shingles([t.encode() for t in coded.dictionary.to_pylist()]))
    start = np.searchsorted(text, np.arange(texts + 1))
    size, total = np.diff(start), np.bincount(text, counts, texts)
    left, right = np.split(coded.indices.to_numpy().astype(np.int64), 2)
    shared = np.zeros(len(left))
    step = np.cumsum(size[left] + size[right]) // PAIRED
    for part in np.split(np.arange(len(left)), np.flatnonzero(np.diff(step)) + 1):
        sides = np.concatenate([left[part], right[part]])
        pair = np.repeat(np.concatenate([part, part]), size[sides])
        inside = np.arange(len(pair)) - np.repeat(np.cumsum(size[sides]) - size[sides], size[sides])
        at = np.repeat(start[sides], size[sides]) + inside
        order = np.lexsort((hashes[at], pair))
        at, pair = at[order], pair[order]
        both = np.flatnonzero((pair[1:] == pair[:-1]) & (hashes[at[1:]] == hashes[at[:-1]]))
        shared += np.bincount(pair[both], np.minimum(counts[at[both]], counts[at[both + 1]]), len(left))
    return shared / np.maximum(total[left] + total[right] - shared, 1)


def _verified(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose texts overlap enough."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                good = overlaps(batch["one"], batch["other"]) >= similarity
                yield batch.select(["a", "b"]).filter(pa.array(good))

    one = texts.select(F.col("node").alias("a"), F.col("norm").alias("one"))
    other = texts.select(F.col("node").alias("b"), F.col("norm").alias("other"))
    return pairs.join(one, "a").join(other, "b").select("a", "b", "one", "other").mapInArrow(check, "a long, b long")


def _comparable(pairs: DataFrame, similarity: float) -> DataFrame:
    """Distinct pairs whose weights allow the similarity."""
    smaller, larger = F.least("weight_a", "weight_b"), F.greatest("weight_a", "weight_b")
    return pairs.where(smaller >= larger * similarity).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _rare(texts: DataFrame, nodes: DataFrame, similarity: float) -> DataFrame:
    """The rarest members of nodes' multisets, as many as decide whether they overlap enough with others.

    Two multisets that overlap by s share one of the w - ceil(s w) + 1 rarest members of each, in any common
    order of rarity. So texts that share a frequent passage and little else never meet, however many there are.
    Members that only one text has decide nothing but how many of the others count. Each row has its place in that
    order and the buckets of its node.
    """
    fields = "node long, root long, weight long, member long"

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first = 0
            for group in _groups([t.encode() for t in batch["norm"].to_pylist()]):
                text, hashes, counts = weighted(*shingles(group))
                copy = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
                member = mixed(np.repeat(hashes, counts) + copy.astype(np.uint64) * GOLDEN)
                rows = pa.array(np.repeat(text, counts) + first)
                yield pa.RecordBatch.from_arrays(
                    [*(batch[c].take(rows) for c in ("node", "root", "weight")), pa.array(member.view(np.int64))], ["node", "root", "weight", "member"]
                )
                first += len(group)

    whole = texts.join(nodes.drop("keys"), "node").select("node", "root", "weight", "norm")
    listed = store(whole.mapInArrow(members, fields))
    often = listed.groupBy("member").agg(F.count("*").alias("n"), (F.min("root") != F.max("root")).alias("shared")).where("n > 1")
    met = store(listed.join(store(often), "member"))
    by_node = Window.partitionBy("node")
    place = F.row_number().over(by_node.orderBy("n", "member"))
    alone = F.col("weight") - F.count("*").over(by_node)
    counted = F.col("weight") - F.ceil(F.col("weight") * F.lit(similarity) - 1e-9) + 1
    rare = met.withColumn("place", place + alone).where(F.col("place") <= counted).where("shared").select("member", "node", "root", "weight", "place")
    return store(rare.join(nodes.select("node", "keys"), "node"))


def _across(rare: DataFrame, similarity: float, every: bool) -> DataFrame:
    """Pairs of nodes with different roots that may overlap enough, by a member they share.

    Of each member, the rows of its most frequent root never meet each other. All others, the strays, meet one
    of them, or, with `every`, all of them and each other. The first member that two texts share
    has few before it in either: with it, no more can be shared than are left in the one with fewer left. Pairs without a
    bucket in common are not asked for.
    """
    fields = ("node", "root", "weight", "place", "keys")
    by_root = rare.groupBy("member", "root").agg(F.count("*").alias("n"), F.min_by(F.struct(*fields), F.struct("place", "node")).alias("one"))
    top = F.max(F.struct("n", "root", "one")).alias("top")
    main = store(by_root.groupBy("member").agg(top, F.count("*").alias("roots")).where("roots > 1"))
    open_rows = store(rare.join(main.select("member", F.col("top.root").alias("main")), "member"))

    def side(name: str) -> list:
        return [F.col("node").alias(name), *(F.col(c).alias(f"{c}_{name}") for c in fields[1:])]

    strays = store(open_rows.where("root != main").select("member", *side("a")))
    if every:
        others = open_rows.select("member", *side("b"), "main")
    else:
        others = main.select("member", "top.one.*").select("member", *side("b"), F.col("root").alias("main"))
    once = (F.col("root_b") == F.col("main")) | (F.col("a") < F.col("b"))
    left = F.least(F.col("weight_a") - F.col("place_a"), F.col("weight_b") - F.col("place_b")) + 1
    needed = (F.col("weight_a") + F.col("weight_b")) * F.lit(similarity / (1 + similarity)) - 1e-9
    likely = (left >= needed) & F.arrays_overlap("keys_a", "keys_b")
    return strays.join(others, "member").where((F.col("root_a") != F.col("root_b")) & once & likely)


def _joined(roots: DataFrame, links: DataFrame) -> DataFrame:
    """Components of earlier components and further links."""
    return components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(links.select("a", "b")))


def near_classes(docs: DataFrame, similarity: float = SIMILARITY) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, digest) and nodes (digest, node, keep_id, size, weight, root) of all documents."""
    rows = store(signed(docs))
    order = F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id").alias("id"))
    folded = rows.groupBy("digest").agg(F.min(order).alias("first"), F.count("*").alias("size"), F.any_value("weight").alias("weight"), F.any_value("keys").alias("keys"))
    nodes = store(folded.withColumn("node", F.monotonically_increasing_id()))

    bands = store(nodes.select(F.explode("keys").alias("key"), "node", "weight"))
    buckets = store(bands.groupBy("key").agg(F.min("node").alias("rep"), F.count("*").alias("n")).where("n > 1"))
    members = store(bands.join(buckets, "key"))
    of_rep = store(members.where("node = rep").select("key", F.col("weight").alias("weight_a"), F.col("node").alias("a")))
    followers = members.where("node != rep").select("key", F.col("node").alias("b"), F.col("weight").alias("weight_b"))
    asked = store(_comparable(followers.join(of_rep, "key"), similarity))

    texts = _texts(docs, nodes, members)
    # a pair is (smaller, larger), and what stands for a bucket is its smallest node
    smallest = store(asked.groupBy("b").agg(F.min("a").alias("a")))
    roots = store(components(store(_verified(smallest, texts, similarity))))
    root_a = roots.select(F.col("node").alias("a"), F.col("root").alias("root_a"))
    root_b = roots.select(F.col("node").alias("b"), F.col("root").alias("root_b"))
    others = asked.join(smallest, ["a", "b"], "left_anti").join(root_a, "a", "left").join(root_b, "b", "left")
    apart_yet = F.coalesce("root_a", "a") != F.coalesce("root_b", "b")
    also = store(_verified(store(others.where(apart_yet).select("a", "b")), texts, similarity))
    if not also.isEmpty():
        roots = store(_joined(roots, also))

    # what shares a bucket and is not connected yet
    labelled = members.select("key", "node", "weight").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    labelled = store(labelled)
    divided = labelled.groupBy("key").agg(F.min("root").alias("least"), F.max("root").alias("most")).where("least != most")
    open_members = labelled.join(store(divided.select("key")), "key", "left_semi")
    apart = store(open_members.groupBy("node", "root", "weight").agg(F.collect_set("key").alias("keys")))
    rare = _rare(texts, apart, similarity)
    for every in (False, True):  # most strays that link at all link to the first they meet
        pairs = store(_comparable(_across(rare, similarity, every), similarity).join(asked, ["a", "b"], "left_anti"))
        more = store(_verified(pairs, texts, similarity))
        if not more.isEmpty():
            roots = store(_joined(roots, more))
            rare = rare.drop("root").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
            rare = store(rare.select("member", "node", "root", "weight", "place", "keys"))
    rooted = nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    return rows.select("doc_id", "digest"), store(rooted.select("digest", "node", F.col("first.id").alias("keep_id"), "size", "root"))


def _texts(docs: DataFrame, nodes: DataFrame, members: DataFrame) -> DataFrame:
    """Normalised text of each node that shares a bucket."""
    wanted = store(members.select("node").distinct().join(nodes.select("node", "digest"), "node"))
    bucket = F.pmod(F.xxhash64("digest"), F.lit(FILTER)).alias("bucket")
    norm = F.trim(one_space(text_of("text")))
    found = docs.select(F.unhex(F.md5(norm)).alias("digest"), norm.alias("norm")).withColumn("bucket", bucket)
    some = found.join(F.broadcast(wanted.select(bucket).distinct()), "bucket", "left_semi")
    return store(some.groupBy("digest").agg(F.any_value("norm").alias("norm")).join(wanted, "digest").select("node", "norm"))


def classes(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, class_id, class_size and kept of every document; one row of a class is kept."""
    rows, nodes = near_classes(docs, similarity)
    order = F.struct(F.col("keep_id").isNull().alias("last"), F.col("keep_id").alias("id"), F.col("node").alias("node"))
    whole = store(nodes.groupBy("root").agg(F.min(order).alias("first"), F.sum("size").alias("class_size")))
    by_node = nodes.join(whole, "root").select("digest", "node", "first", "class_size")
    numbered = store(rows.withColumn("row", F.monotonically_increasing_id()))
    same_id = F.min(F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id").alias("id"), "row")).alias("own")
    firsts = numbered.groupBy("digest").agg(same_id).select("digest", F.col("own.row").alias("own_row"))
    by_node = store(by_node.join(firsts, "digest"))
    met = numbered.join(by_node, "digest")
    kept = (F.col("row") == F.col("own_row")) & (F.col("node") == F.col("first.node"))
    return met.select("doc_id", F.col("first.id").alias("class_id"), "class_size", kept.alias("kept"))


def keep_one(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One document of each class, the one with the smallest id, with all its columns."""
    _, nodes = near_classes(docs, similarity)
    order = F.struct(F.col("keep_id").isNull().alias("last"), F.col("keep_id").alias("id"), F.col("node").alias("node"))
    whole = store(nodes.groupBy("root").agg(F.min(order).alias("first"), F.count("*").alias("n")).where("n > 1"))
    gone = nodes.join(whole, "root").where(F.col("node") != F.col("first.node")).select("digest")
    digest = F.unhex(F.md5(F.trim(one_space(text_of("text")))))
    whole_row = F.struct(*(F.col(c) for c in docs.columns))
    rows = docs.select(digest.alias("digest"), F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.xxhash64("text")).alias("order"), whole_row.alias("whole"))
    folded = rows.groupBy("digest").agg(F.min_by("whole", "order").alias("whole"))
    return folded.join(store(gone), "digest", "left_anti").select("whole.*")
