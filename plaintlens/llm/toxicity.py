"""Toxicity: subword bags averaged into a linear softmax, trained jointly in numpy.

A bag holds the character n-grams of one word and the word itself, hashed to BUCKETS vectors. Their
average goes through a linear two-class softmax, so an inflected or misspelt word shares most of its
vectors with the words it was learned from. A text is as toxic as its most toxic bag: an average over
all words would bury one slur among thousands of neutral words. Vectors and softmax are
learned together: first every word takes the label of its texts, then each text teaches besides through the
bag that decides it.

A gram that fitting never saw gives no evidence: it counts as what clean texts score.

Fitting reads at most SAMPLE labelled ids of each label (those with the smallest hash) and one whole text of
each, of several the one that sorts first. Scoring reads every whole text, batch by batch; a batch scores each distinct word once.

Defined cases: null, empty and wordless texts get the score of a text whose only bag is neutral. Labels that are null,
or of ids not in the documents, teach nothing; conflicting labels of one id count as toxic. Without
labels of both kinds every score is the share of toxic labels (0 without labels). Rows with a null id
are scored and never learned from. Repeated rows are scored alike. Extra columns take no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plaintlens.llm.common import in_fold, text_of
from plaintlens.llm.wordhash import GOLDEN, mixed

#: Labelled rows of each label used for fitting, at most.
SAMPLE = 1000
BUCKETS = 1 << 17
WIDTH = 4
GRAMS = (3, 4, 5)
THRESHOLD = 0.3
SEPARATOR = r"[^\p{L}\p{N}]+"
#: Texts scored together hold about so many bytes.
SLICE = 4 << 20


def words_of(texts: pa.Array) -> pa.ListArray:
    """Lower-case letter and digit runs of each text; separators at the ends leave empty strings."""
    return pc.split_pattern_regex(pc.utf8_lower(pc.fill_null(texts, "")), pattern=SEPARATOR)


def grams_of(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and word of every gram of the words, in no particular order. Every word has some."""
    marked = pc.binary_join_element_wise("<", words.cast(pa.string()), ">", "").cast(pa.large_binary())
    _, offsets, data = marked.buffers()
    ends = np.frombuffer(offsets, np.int64)[marked.offset : marked.offset + len(marked) + 1]
    raw = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]].astype(np.uint64) + np.uint64(1)
    ends = ends - ends[0]
    length = np.diff(ends)
    left = np.repeat(ends[1:], length) - np.arange(len(raw))  # bytes from here to the word's end
    word = np.repeat(np.arange(len(length)), length)
    prime, of_word, bucket = np.uint64(0x100000001B3), [], []
    rolling = np.zeros(len(raw), np.uint64)
    for n in range(1, max(GRAMS) + 1):
        rolling = rolling[: len(raw) - n + 1] * prime + raw[n - 1 :]
        if n in GRAMS:
            whole = np.flatnonzero(left[: len(rolling)] >= n)
            of_word.append(word[whole])
            bucket.append((mixed(rolling[whole] + np.uint64(n)) % np.uint64(BUCKETS)).astype(np.int32))
    place = np.arange(len(raw)) - np.repeat(ends[:-1], length)
    places = mixed(raw + place.astype(np.uint64) * GOLDEN)
    of_word.append(np.arange(len(length)))
    bucket.append((mixed(np.add.reduceat(places, ends[:-1]) if len(length) else places) % np.uint64(BUCKETS)).astype(np.int32))
    return np.concatenate(bucket), np.concatenate(of_word)


class Model:
    """The softmax's log odds for each bucket's vector, and those of a clean text.

    A bag's log odds are the average of its grams': the softmax is linear. A gram that no text taught says what a
    clean text says: it moves a bag's average towards `neutral`.
    """

    def __init__(self, per_bucket: np.ndarray, neutral: float) -> None:
        self.per_bucket, self.neutral = per_bucket, neutral

    def logits(self, words: pa.Array) -> np.ndarray:
        """Log odds of each word's bag."""
        if not len(words):
            return np.zeros(0, np.float32)
        buckets, word = grams_of(words)
        return np.bincount(word, self.per_bucket[buckets], len(words)) / np.bincount(word, minlength=len(words))

    def scores(self, texts: pa.Array) -> np.ndarray:
        """Probability of label 1 for each text."""
        lists = words_of(texts)
        coded = lists.values.dictionary_encode()
        known = coded.dictionary
        logits = np.where(pc.binary_length(known).to_numpy() > 0, self.logits(known), -np.inf)
        each = np.append(logits[coded.indices.to_numpy()], -np.inf)
        offsets = lists.offsets.to_numpy()
        most = np.maximum.reduceat(each, offsets[:-1]) if len(texts) else each[:0]
        most = np.where(np.diff(offsets) > 0, most, -np.inf)
        return 1 / (1 + np.exp(-np.clip(np.where(np.isfinite(most), most, self.neutral), -40, 40)))


class _Adam:
    def __init__(self, rate: float) -> None:
        self.rate, self.turn, self.first, self.second = rate, 0, 0.0, 0.0

    def step(self, gradient: np.ndarray) -> np.ndarray:
        self.turn += 1
        self.first = 0.9 * self.first + 0.1 * gradient
        self.second = 0.999 * self.second + 0.001 * gradient**2
        return self.rate * (self.first / (1 - 0.9**self.turn)) / (np.sqrt(self.second / (1 - 0.999**self.turn)) + 1e-8)


def fitted(lists: pa.ListArray, labels: np.ndarray, weights: np.ndarray, seed: int = 0) -> Model:
    """Fit on texts given as lists of distinct words, each text with a label and a weight."""
    coded = lists.values.dictionary_encode()
    words, ids = coded.dictionary, coded.indices.to_numpy()
    sizes = np.diff(lists.offsets.to_numpy())
    text = np.repeat(np.arange(len(sizes)), sizes)
    full = sizes > 0
    starts = (np.cumsum(sizes) - sizes)[full]
    buckets, of_gram = grams_of(words)
    grams = np.bincount(of_gram, minlength=len(words))
    toxic = np.bincount(ids, (labels * weights)[text], len(words))
    clean = np.bincount(ids, ((1 - labels) * weights)[text], len(words))

    random = np.random.default_rng(seed)
    vectors = random.normal(0, 0.05, (BUCKETS, WIDTH)).astype(np.float32)
    softmax = random.normal(0, 0.5, WIDTH)
    bias = float(np.log((labels @ weights + 0.5) / ((1 - labels) @ weights + 0.5)))
    for rounds, rate, by_text in ((60, 0.1, False), (90, 0.05, True)):
        steps = [_Adam(rate), _Adam(rate), _Adam(rate)]
        for _ in range(rounds):
            per_bucket = vectors @ softmax
            z = np.bincount(of_gram, per_bucket[buckets], len(words)) / grams + bias
            p = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
            error = (p * (toxic + clean) - toxic) / (toxic + clean).sum() * (0.3 if by_text else 1.0)
            if by_text:
                each = z[ids]
                most = np.maximum.reduceat(each, starts)
                decides = np.flatnonzero(each == np.repeat(most, sizes[full]))
                one = decides[np.unique(text[decides], return_index=True)[1]]
                error += np.bincount(ids[one], weights[text[one]] * (p[ids[one]] - labels[text[one]]), len(words)) / weights.sum()
            per_gram = np.bincount(buckets, (error / grams)[of_gram], BUCKETS)
            to_vectors = np.outer(per_gram, softmax).astype(np.float32) + 1e-5 * vectors
            to_softmax = vectors.T @ per_gram + 1e-5 * softmax
            vectors -= steps[0].step(to_vectors)
            softmax -= steps[1].step(to_softmax)
            bias -= float(steps[2].step(np.array([error.sum()]))[0])
    z = np.bincount(of_gram, (vectors @ softmax)[buckets], len(words)) / grams + bias
    of_text = np.maximum.reduceat(z[ids], starts)
    neutral = float(np.median(of_text[labels[full] == 0]))
    taught = np.zeros(BUCKETS, bool)
    taught[buckets] = True
    return Model(np.where(taught, vectors @ softmax + bias, neutral).astype(np.float32), neutral)


def _sampled(docs: DataFrame, labels: DataFrame, most: int) -> tuple[DataFrame, dict[int, int]]:
    """Distinct words of the sampled labelled texts, and the number of labelled rows of each label."""
    known = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("label"))
    there = known.join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
    counts = {r["label"]: r["count"] for r in there.groupBy("label").count().collect()}
    by_hash = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = [there.where(F.col("label") == label).orderBy(*by_hash).limit(most) for label in sorted(counts)]
    if not chosen:
        chosen = [there.limit(0)]
    mine = docs.join(F.broadcast(reduce(DataFrame.unionByName, chosen)), "doc_id")
    texts = mine.groupBy("doc_id", "label").agg(F.min("text").alias("text")).select("label", "text")

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                found = [sorted({w for w in words if w}) for words in words_of(batch["text"]).to_pylist()]
                yield pa.RecordBatch.from_arrays([batch["label"], pa.array(found, pa.list_(pa.string()))], ["label", "words"])

    return texts.mapInArrow(distinct, "label int, words array<string>"), counts


def train(docs: DataFrame, labels: DataFrame, most: int = SAMPLE) -> Model:
    """Fit on at most `most` ids of each label; docs and labels hold only rows one may learn from."""
    sample, counts = _sampled(docs, labels, most)
    share = counts.get(1, 0) / max(1, sum(counts.values()))
    if not 0 < share < 1:
        log_odds = 40.0 if share else -40.0
        return Model(np.full(BUCKETS, log_odds, np.float32), log_odds)

    def fit(rows: pa.Table) -> pa.Table:
        label = rows["label"].to_numpy().astype(float)
        # each label weighs as in all labelled rows
        weight = np.where(label == 1, share / label.sum(), (1 - share) / (1 - label).sum()) * len(label)
        model = fitted(rows["words"].combine_chunks(), label, weight)
        return pa.table({"buckets": [model.per_bucket.tobytes()], "neutral": [model.neutral]})

    # one bounded group, fitted in a task: the driver only gets the model
    row = sample.groupBy().applyInArrow(fit, "buckets binary, neutral double").first()
    return Model(np.frombuffer(row["buckets"], np.float32), row["neutral"])


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """docs with a column score; the column text is read whole."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = docs.select("*", F.lit(0.0).alias("score")).schema

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            step = max(1, batch.num_rows * SLICE // max(1, batch["text"].nbytes))
            for first in range(0, batch.num_rows, step):
                part = batch.slice(first, step)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(shared.value.scores(part["text"]))], [*part.schema.names, "score"])

    return docs.mapInArrow(score, schema)


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, most: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score and predicted of every document; one id in four is never learned from."""
    held = in_fold(F.col("doc_id"), 4, 2)
    model = train(docs.select("doc_id", "text").where(~held), labels.select("doc_id", "toxic").where(~held), most)
    whole = scored(docs.select("doc_id", text_of("text").alias("text")), model)
    return whole.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, most: int = SAMPLE) -> DataFrame:
    """The documents that the model doesn't reject, with their columns as they are."""
    held = in_fold(F.col("doc_id"), 4, 2)
    model = train(docs.select("doc_id", "text").where(~held), labels.select("doc_id", "toxic").where(~held), most)
    others = F.struct(F.lit(0).alias("none"), *(F.col(c) for c in docs.columns if c != "text"))
    kept = scored(docs.select(others.alias("others"), "text"), model).where(F.col("score") < threshold)
    return kept.select(*(F.col(c) if c == "text" else F.col(f"others.`{c}`") for c in docs.columns))
