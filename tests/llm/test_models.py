import binascii
import hashlib
import math
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken

from plaintlens.llm import bpe, langid, lm_score, queries, toxicity
from plaintlens.llm.eliasfano import EliasFano
from tests.llm.conftest import awkward_rows

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def fold(doc_id, parts: int) -> int:
    return -1 if doc_id is None else binascii.crc32(str(doc_id).encode()) % parts


# ---- language model


@pytest.mark.parametrize("size, top", [(1, 10), (5, 5), (1000, 2**40), (5000, 2**63), (3000, 4000), (20000, 2**64 - 1)])
def test_sequences_give_and_find_their_elements(size, top):
    random = np.random.default_rng(size)
    values = np.unique(random.integers(0, top, size, dtype=np.uint64, endpoint=True))
    sequence = EliasFano(EliasFano.parts(values))
    assert (sequence.get(np.arange(len(values))) == values).all()
    assert (sequence.find(values) == np.arange(len(values))).all()
    others = random.integers(0, top, 500, dtype=np.uint64, endpoint=True)
    assert [k >= 0 for k in sequence.find(others)] == [v in set(values.tolist()) for v in others.tolist()]


def expected_scores(rows, strength=lm_score.STRENGTH):
    tokens = [WORD.findall((t or "").translate(LOWER)) + ["</s>"] for _, t in rows]
    counts, pairs = Counter(), Counter()
    for (i, _), t in zip(rows, tokens, strict=True):
        if fold(i, 5) != 1:
            counts.update(t)
            pairs.update(zip(["<s>", *t[:-1]], t, strict=True))
    total, scale = sum(counts.values()), sum(counts.values()) + 0.5 * (len(counts) + 1)
    starts = counts["</s>"]
    for (i, _), t in zip(rows, tokens, strict=True):
        own = {w: (counts[w] + 0.5) / scale for w in t}
        smoothed = sum(
            math.log10((pairs[(b, w)] + strength * own[w]) / ((starts if b == "<s>" else counts[b]) + strength))
            for b, w in zip(["<s>", *t[:-1]], t, strict=True)
        )
        yield i, fold(i, 5) == 1, len(t), sum(counts[w] > 0 for w in t), total, sum(math.log10(own[w]) for w in t), smoothed


@pytest.mark.parametrize("which", ["corpus", "clashing"])
def test_scores_are_those_of_the_plain_model(which, request):
    docs = request.getfixturevalue(which)
    wanted = sorted(expected_scores([(r.doc_id, r.text) for r in docs.collect()]), key=str)
    found = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in lm_score.held_out_scores(docs).collect()), key=str)
    assert [r[:5] for r in found] == [r[:5] for r in wanted]
    for a, b in zip(found, wanted, strict=True):
        assert a[5] == pytest.approx(b[5], rel=1e-9)
        assert abs(a[6] - b[6]) / b[2] < 0.03  # weights are quantised


def test_scores_of_an_empty_table(nothing):
    assert lm_score.held_out_scores(nothing).count() == 0


def test_many_shards_score_like_one(corpus):
    from pyspark.sql import functions as F

    docs = corpus.select(F.col("doc_id").alias("id"), F.lit(True).alias("learn"), "text")
    one = {r.id: r.score for r in lm_score.scored(docs).collect()}
    many = {r.id: r.score for r in lm_score.scored(docs, shard=5000).collect()}
    assert many.keys() == one.keys()
    assert all(abs(many[k] - one[k]) <= 0.01 * abs(one[k]) for k in one)


def test_blocks_survive_packing():
    random = np.random.default_rng(0)
    word = np.sort(random.integers(1, 50, 300).astype(np.uint64))
    context = random.integers(0, 2**40, 300, dtype=np.uint64)
    words, lengths, contexts, docs = lm_score.unpack(lm_score.pack(word, context, np.arange(300)))
    assert (np.repeat(words, lengths) == word).all() and (contexts == context).all() and (docs == np.arange(300)).all()


# ---- language


def test_languages_of_held_out_documents(corpus):
    truth = {r.doc_id: r.lang for r in corpus.collect()}
    found = langid.languages(corpus).collect()
    assert len(found) == len(truth)
    assert all(r.held_out == (fold(r.doc_id, 5) == 0) and 0 <= r.score <= 1 for r in found)
    held = [r.lang_pred == truth[r.doc_id] for r in found if r.held_out]
    assert np.mean(held) > 0.95


def test_undetermined_and_awkward_texts(spark, clashing, nothing):
    assert langid.languages(clashing).count() == len(awkward_rows())
    rows = [(1, None, None), (2, "12 34 !?", None), (3, "", None), (4, "der die das", "de"), (6, "the of and", "en")]
    found = {r.doc_id: r for r in langid.languages(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert [found[k].lang_pred for k in (1, 2, 3)] == ["und"] * 3 and [found[k].score for k in (1, 2, 3)] == [0.0] * 3
    assert langid.languages(nothing).count() == 0
    unlearned = langid.languages(spark.createDataFrame([(1, "text", None)], "doc_id long, text string, lang string"))
    assert unlearned.first().lang_pred == "und"


def test_code_lengths_are_exact():
    texts = {"x": ["abracadabra", "abba"], "y": ["banana bandana"]}
    trees = {}
    for lang, own in texts.items():
        tree = trees[lang] = Counter()
        for t in own:
            raw = langid.PAD + t.encode()
            tree.update(raw[i - k : i + 1] for i in range(langid.ORDER, len(raw)) for k in range(langid.ORDER + 1))

    def bits(tree, context, symbol):
        below = {g: n for g, n in tree.items() if len(g) == len(context) + 1 and g[:-1] == context}
        shorter = (lambda: bits(tree, context[1:], symbol)) if context else (lambda: 8.0)
        if not below:
            return shorter()
        seen, distinct = sum(below.values()), len(below)
        if context + symbol in below:
            return -math.log2(below[context + symbol] / (seen + distinct))
        return -math.log2(distinct / (seen + distinct)) + shorter()

    counts = []
    for lang in sorted(texts):
        by = {}
        for order in range(langid.ORDER + 1):
            grams = sorted((int.from_bytes(g, "big"), n) for g, n in trees[lang].items() if len(g) == order + 1)
            by[order] = (np.array([g for g, _ in grams], np.uint32), np.array([n for _, n in grams], float))
        counts.append(by)
    model = langid.Model(sorted(texts), counts)
    for text in ("abrabanana", "zebra", "b"):
        raw = langid.PAD + text.encode()
        wanted = [sum(bits(trees[lang], raw[i - 3 : i], raw[i : i + 1]) for i in range(3, len(raw))) for lang in sorted(texts)]
        assert model.code_lengths([text.encode()])[0] == pytest.approx(wanted, rel=1e-5)
    both = model.code_lengths([b"abra" * 400_000, b""])
    assert both[1].sum() == 0 and both[0][0] > model.code_lengths([b"abra" * 200_000])[0][0] * 1.9


# ---- tokens


@pytest.fixture(scope="module")
def tokenizer():
    return queries.tokenizer()


@pytest.fixture(scope="module")
def reference(tokenizer):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=tokenizer.ranks, special_tokens={})


def test_tokens_are_those_of_the_library(spark, corpus, tokenizer, reference):
    odd = ["don't 'tis   x\n\n  y \t z  ", "日本語テキスト🙂 naïve café", "a" * 3000, "  x　 y", "x\x85y\x1c z", "1234567890123 ½ ² Ⅷ", "<|endoftext|>", " ", None, ""]
    docs = corpus.select("doc_id", "text").unionByName(spark.createDataFrame([(10_000 + k, t) for k, t in enumerate(odd)], "doc_id long, text string"))
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    plain = {r.doc_id: list(r.token_ids) for r in bpe.encode(docs.where("doc_id >= 9990"), tokenizer).collect()}
    assert plain == {k: reference.encode_ordinary(t) for k, t in texts.items() if k >= 9990}
    for r in bpe.tokenised(docs, tokenizer.with_cache(docs, 2000, 100)).collect():
        ids = reference.encode_ordinary(texts[r.doc_id])
        assert list(r.token_ids) == ids and r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in ids)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_tokens_of_empty_tables_and_other_columns(nothing, clashing, tokenizer):
    assert bpe.tokenised(nothing, tokenizer.with_cache(nothing)).count() == 0
    made = bpe.tokenised(clashing, tokenizer)
    assert set(made.columns) == {*clashing.columns, *bpe.MADE} - {"text"}
    assert made.count() == len(awkward_rows())


def test_the_maps_are_one_constant_outside_the_plan_text(spark, corpus, reference):
    own = queries.tokenizer().with_cache(corpus, 3000, 1000)
    plan = bpe.encode(corpus.select("doc_id", "text"), own)._jdf.queryExecution().executedPlan().toString()
    # the subquery stands in the expression itself: no row carries the maps
    assert "transform(array(Subquery" in plan and len(plan) < 100_000
    row = own.maps.first()
    held = {w: list(i) for w, i in zip(row.words, row.ids, strict=True) if w is not None}
    assert len(row.words) == own.slots and 2700 < len(held) <= 3000
    assert all(ids == reference.encode_ordinary(word) for word, ids in held.items())


def test_no_table_of_the_tokenizer_stands_in_the_plan(corpus):
    made = bpe.tokenised(corpus.select("doc_id", "text"), queries.tokenizer())
    plan = made._jdf.queryExecution().executedPlan().toString()
    # every map is read once, in one expression, and no row carries it
    assert "transform(array(Subquery" in plan and len(plan) < 100_000
    assert all("array<" not in f.dataType.simpleString() or f.name == "token_ids" for f in made.schema)


# ---- toxicity


def test_misspellings_share_vectors():
    toxic, clean = ["idiot", "stupid", "idiots"], [f"{a}{b}" for a in ("thing", "house", "water", "light", "stone") for b in ("", "s", "ly", "er")]
    lists, labels = [], []
    for k in range(120):
        some = [clean[(k * 7 + j) % len(clean)] for j in range(6)]
        lists.append(some + [toxic[k % 3]] * (k % 2))
        labels.append(float(k % 2))
    model = toxicity.fitted(pa.array(lists, pa.list_(pa.string())), np.array(labels), np.ones(len(labels)))
    scores = model.scores(pa.array(["you idiiot", "such idiotic water", "the light house", "", None, "..."]))
    assert scores[0] > 0.3 and scores[1] > 0.3 and scores[2] < 0.3
    assert len(set(scores[3:])) == 1 and scores[3] < 0.3


def test_held_out_toxicity(corpus, labels, spark):
    docs, marks = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    truth = {r.doc_id: r.toxic for r in marks.collect()}
    found = toxicity.toxicity(docs, marks, most=1000).collect()
    assert len(found) == docs.count()
    assert all(r.held_out == (fold(r.doc_id, 4) == 2) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in found)
    held = [(truth[r.doc_id], r.predicted) for r in found if r.held_out and r.doc_id in truth]
    hits = sum(a and b for a, b in held)
    assert hits >= 0.85 * sum(a for a, _ in held)
    assert sum(b and not a for a, b in held) <= 0.03 * len(held)


def test_awkward_toxicity(clashing, nothing, labels, spark):
    assert toxicity.toxicity(clashing, labels).count() == len(awkward_rows())
    assert toxicity.toxicity(nothing, labels).count() == 0
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.predicted for r in toxicity.toxicity(clashing, none).collect()} == {0}
    kept = toxicity.without_toxic(clashing, labels)
    assert kept.columns == clashing.columns and kept.count() == len(awkward_rows())
