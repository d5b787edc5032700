import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from plaintlens.llm import queries, runs
from tests.llm.conftest import SF, awkward_rows

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(words, least=runs.LEAST):
    """Every period against every place."""
    numbers = {}
    a = np.array([numbers.setdefault(w, len(numbers)) for w in words])
    found = {}
    for q in range(1, len(a) // 2 + 1):
        same = np.concatenate([[0], (a[:-q] == a[q:]).astype(int), [0]])
        begins, ends = np.flatnonzero(np.diff(same) == 1), np.flatnonzero(np.diff(same) == -1) + q
        for s, e in zip(begins.tolist(), ends.tolist()):
            if e - s >= max(least, 2 * q):
                found.setdefault((s, e), q)
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def planted(doc_id, words):
    if doc_id is None or not words:
        return words
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    g = h // 10
    if h % 10:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def expected(doc_id, text):
    words = planted(doc_id, WORD.findall(text or ""))
    all_runs = brute(words)
    dropped = {i for s, n, q in all_runs for i in range(s + q, s + n)}
    start, length, period = max(all_runs, key=lambda r: (r[1], -r[0], -r[2]), default=(None, None, None))
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return {
        "doc_id": doc_id, "n_runs": len(all_runs), "start": start, "length": length, "period": period,
        "exponent_milli": None if period is None else 1000 * length // period,
        "runs_sha256": sha("".join(f"{s},{n},{q}\n" for s, n, q in all_runs)),
        "collapsed_sha256": sha(" ".join(w for i, w in enumerate(words) if i not in dropped)),
    }


def of(lists, least=runs.LEAST):
    words = np.array([w for one in lists for w in one], np.int64)
    start, end, period = runs.find_runs(words, np.repeat(np.arange(len(lists)), [len(one) for one in lists]), least)
    return list(zip(start.tolist(), (end - start).tolist(), period.tolist()))


def all_brute(lists, least=runs.LEAST):
    out, before = [], 0
    for one in lists:
        out += [(s + before, n, q) for s, n, q in brute(one, least)]
        before += len(one)
    return out


def test_random_words_with_planted_periods():
    pick = random.Random(1)
    for _ in range(250):
        lists = []
        for _ in range(pick.randint(1, 6)):
            n, kinds = pick.choice([0, 3, 12, 13, 40, 150]), pick.choice([1, 2, 2, 3, 6, 50])
            one = [pick.randrange(kinds) for _ in range(n)]
            for _ in range(pick.randint(0, 3) if n > 13 else 0):
                a = pick.randrange(n)
                p, size = 1 + pick.randrange(max(1, (n - a) // 2)), pick.randrange(n - a) + 1
                for i in range(a, a + size):
                    one[i] = one[a + (i - a) % p]
            lists.append(one)
        least = pick.choice([12, 12, 12, 4, 7, 20])
        assert of(lists, least) == all_brute(lists, least)


def test_words_rich_in_runs():
    fibonacci, thue = [[0], [0, 1]], [0]
    while len(fibonacci[-1]) < 1500:
        fibonacci.append(fibonacci[-1] + fibonacci[-2])
    while len(thue) < 1024:
        thue += [1 - x for x in thue]
    stairs = [x for k in range(1, 40) for x in [0] * k + [1]]
    for words in (fibonacci[-1], thue, stairs, [7] * 999, [1, 2, 3] * 400 + [1, 2] + [4] * 30, list(range(500)) * 2):
        assert of([words]) == brute(words)


def test_equal_documents_do_not_meet():
    one = list(range(40))
    assert of([one, one, one, one]) == []
    assert of([one * 2, one, [5] * 11, [5] * 11]) == brute(one * 2)


def test_counts_and_quantiles_of_ranges():
    rng = np.random.default_rng(0)
    for n in (1, 2, 7, 64, 100):
        values = rng.permutation(n)
        tree = runs.Wavelet(values)
        left = rng.integers(0, n, 200)
        right = left + 1 + (rng.random(200) * (n - left)).astype(int)
        limit = rng.integers(0, n + 1, 200)
        parts = [np.sort(values[a:b]) for a, b in zip(left, right)]
        assert tree.below(left, right, limit).tolist() == [int((p < x).sum()) for p, x in zip(parts, limit)]
        nth = (rng.random(200) * (right - left)).astype(int)
        assert tree.quantile(left, right, nth).tolist() == [int(p[k]) for p, k in zip(parts, nth)]


def test_one_very_long_text():
    words = [f"w{k % 7919}" for k in range(60_000)]
    ((found, collapsed),) = runs.searched(pa.array([" ".join(words)]))
    assert found == [(0, 60_000, 7919)] and collapsed.decode().split() == words[:7919]


def test_query_equals_brute_force(spark, corpus):
    wanted = {r.doc_id: expected(r.doc_id, r.text) for r in corpus.collect()}
    rows = queries.op12_periodic_runs(spark, SF).collect()
    assert len(rows) == len(wanted) == corpus.count()
    for r in rows:
        assert r.asDict() == wanted[r.doc_id]
    assert sum(r.n_runs > 0 for r in rows) >= 0.08 * len(rows)


def test_awkward_rows(clashing, nothing, spark):
    made = runs.periodic_runs(clashing)
    assert set(made.columns) == {*clashing.columns, *runs.MADE} - {"text"}
    got = sorted((str(r.doc_id), [tuple(x) for x in r.runs], r.collapsed) for r in made.collect())
    wanted = []
    for row in awkward_rows():
        words = WORD.findall(row[1] or "")
        found = brute(words)
        dropped = {i for s, n, q in found for i in range(s + q, s + n)}
        wanted.append((str(row[0]), found, " ".join(w for i, w in enumerate(words) if i not in dropped)))
    assert got == sorted(wanted)
    assert runs.periodic_runs(nothing).count() == 0


def test_repeated_changes_one_text_in_ten(spark, awkward):
    from pyspark.sql import functions as F

    rows = [(k, " ".join(f"w{j}" for j in range(k % 50))) for k in range(300)] + [(None, "a b"), (0, None), (13, " \t ")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = frame.select("doc_id", runs.repeated(F.col("text"), F.col("doc_id")).alias("text")).collect()
    assert [WORD.findall(r.text) for r in got] == [planted(i, WORD.findall(t or "")) for i, t in rows]
