import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from plaintlens.llm import dual_tree, queries
from tests.compare import connect, differences
from tests.llm.conftest import SF, awkward_rows, words

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
ITEMS = "item_id long, text string"


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def expected(docs, items, most=50):
    """Every item against every document."""
    lists = [(doc_id, terms(text)) for doc_id, text in docs if terms(text)]
    df = Counter(t for _, ts in lists for t in set(ts))
    n, length = len(lists), sum(len(ts) for _, ts in lists)
    wanted = {}
    for item, text in items:
        wanted.setdefault(item, set()).update(terms(text))
    out = []
    for item, ts in wanted.items():
        scored = []
        for doc_id, doc in lists:
            m, tf = 100 - 50 + 50 * len(doc) * n // length, Counter(doc)
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * tf[t] // (1000 * tf[t] + 20 * m)) for t in ts if tf[t])
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item, k + 1, s[3], -s[0]) for k, s in enumerate(sorted(scored, key=lambda s: s[:3])[:most])]
    return sorted(out, key=str)


def rows(frame):
    return sorted((tuple(r) for r in frame.select("item_id", "rank", "doc_id", "score").collect()), key=str)


@pytest.fixture(scope="module")
def random_case():
    pick = random.Random(5)
    letters = "abcdefghijklmnopqrstuvwxyz"
    common = ["".join(pick.choices(letters, k=3)) for _ in range(30)]
    rare = ["".join(pick.choices(letters, k=6)) for _ in range(400)]
    text = lambda n: " ".join(pick.choice(common if pick.random() < 0.7 else rare) for _ in range(n))
    docs = [(k, text(pick.randint(1, 60))) for k in range(900)]
    docs += [(5000 + k, docs[7][1]) for k in range(120)]  # ties beyond the number of results
    docs += [docs[3], (None, docs[7][1]), (None, docs[7][1])]
    pick.shuffle(docs)
    return docs, [(k, text(pick.randint(1, 25))) for k in range(40)] + [(41, docs[0][1]), (42, "nowhere"), (43, None), (None, "abc " + common[0]), (0, rare[0])]


def test_equals_every_pair(spark, random_case):
    docs, items = random_case
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    asked = spark.createDataFrame(items, ITEMS)
    assert rows(dual_tree.ranked(frame, asked)) == expected(docs, items)
    assert rows(dual_tree.ranked(frame, asked, most=3)) == expected(docs, items, 3)


def test_blocks_of_items_and_a_seed_change_nothing(spark, random_case, monkeypatch):
    docs, items = random_case
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(7)
    monkeypatch.setattr(dual_tree, "SEED", 300)
    assert rows(dual_tree.ranked(frame, spark.createDataFrame(items, ITEMS), block=150)) == expected(docs, items)


def test_pruned_batches_are_not_scored():
    """Documents of forty topics: an item's best are found without scoring the leaves of other topics."""
    rng = np.random.default_rng(0)
    n, per = 4000, 100
    topic = np.arange(n) // per
    term = np.stack([topic * 5 + k for k in range(5)], 1).ravel()
    value = rng.integers(10**6, 10**7, n * 5)
    slice_ = dual_tree.Slice(np.arange(n), np.zeros(n, bool), np.full(n, 5), term, value, 200)
    items = dual_tree.item_tree(list(range(40)), [np.arange(5 * t, 5 * t + 5) for t in range(40)])
    best = dual_tree.Best(np.ones(40, np.int64), 50)
    leaves = len(slice_.levels[0][0]) * sum(not node[3] for node in items.nodes)
    assert slice_.search(items, best) < leaves / 3
    sums = value.reshape(n, 5).sum(1)
    for item, (score, _, ids) in zip(items.ids, best.found):
        mine = np.flatnonzero(topic == item)
        assert score.tolist() == sorted(sums[mine].tolist(), reverse=True)[:50] and set(ids) <= set(mine)


def test_query_agrees_with_sql(spark):
    name = "op13_ranked_search"
    assert differences(spark, connect(SF), queries.QUERIES[name], queries.ORACLE[name], SF) == []


def test_awkward_rows(spark, clashing, nothing):
    items = [(1, words(1, 120)), (2, "ONE x"), (3, "日本語 naïve"), (4, ""), (None, "one repeat")]
    asked = spark.createDataFrame([(*i, 5) for i in items], ITEMS + ", rank int")
    docs = [(r[0], r[1]) for r in awkward_rows()]
    assert rows(dual_tree.ranked(clashing, asked)) == expected(docs, items)
    assert dual_tree.ranked(nothing, asked).count() == 0
    assert dual_tree.ranked(clashing, spark.createDataFrame([], ITEMS)).count() == 0


def test_terms_of_bytes_are_those_of_the_pattern(corpus):
    for row in corpus.limit(300).collect() + [("İstanbul ÀB-cd\x00e\x7ff_ 1²",)]:
        text = row[1] if len(row) > 1 else row[0]
        assert [t.decode() for t in (text or "").encode().translate(dual_tree.PLAIN).split()] == terms(text)
