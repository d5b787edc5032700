import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from plaintlens.llm import bagminhash, order_minhash
from plaintlens.llm.wordhash import mixed, word_hashes
from tests.llm.conftest import awkward_rows, words

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def bag(text):
    found = WORD.findall(text or "")
    return Counter(tuple(found[k : k + 5]) for k in range(len(found) - 4)) if len(found) >= 5 else Counter([tuple(found)])


def classes(rows) -> list[list[int]]:
    """Connected components of all pairs that overlap by 0.8 or more, by comparing all of them."""
    bags = [bag(t) for _, t in rows]
    holds = defaultdict(list)
    for k, b in enumerate(bags):
        for s in b:
            holds[s].append(k)
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, b in enumerate(bags):
        shared = Counter()
        for s, n in b.items():
            for j in holds[s]:
                if j < k:
                    shared[j] += min(n, bags[j][s])
        for j, o in shared.items():
            if o >= 0.8 * (sum(b.values()) + sum(bags[j].values()) - o):
                parent[max(root(k), root(j))] = min(root(k), root(j))
    out = defaultdict(list)
    for k in range(len(rows)):
        out[root(k)].append(k)
    return list(out.values())


@pytest.mark.parametrize("which", ["corpus", "awkward"])
def test_classes_are_those_of_all_pairs(which, request):
    docs = request.getfixturevalue(which)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    wanted = Counter()
    groups = classes(rows)
    for group in groups:
        first = min((rows[k][0] for k in group if rows[k][0] is not None), default=None)
        for k in group:
            wanted[(rows[k][0], first, len(group))] += 1
    found = bagminhash.classes(docs).collect()
    assert Counter((r.doc_id, r.class_id, r.class_size) for r in found) == wanted
    assert sum(r.kept for r in found) == len(groups)
    assert all(r.doc_id == r.class_id for r in found if r.kept)


def test_across_finds_links_beyond_the_first_node(spark):
    base = words(7, 200).split()
    chain = []
    for step in range(12):  # each overlaps the one before, the ends don't
        row = list(base)
        row[: step * 9] = words(100, 200).split()[: step * 9]
        chain.append((step, " ".join(row)))
    chain += [(100 + k, " ".join(words(50 + k, 100).split() + base[:60])) for k in range(20)]  # a common passage
    docs = spark.createDataFrame(chain, "doc_id long, text string")
    wanted = {rows[0] for rows in ([chain[k][0] for k in g] for g in classes(chain))}
    assert {r.class_id for r in bagminhash.classes(docs).collect()} == wanted


def test_keep_one(clashing):
    kept = bagminhash.keep_one(clashing)
    assert kept.columns == clashing.columns
    assert kept.count() == len(classes([(r[0], r[1]) for r in awkward_rows()]))


def test_signatures_estimate_weighted_overlap():
    text, items, counts = np.repeat([0, 1], 3), np.array([1, 2, 3, 1, 2, 4], np.uint64), np.array([5, 1, 9, 3, 1, 2])
    agree = []
    for seed in range(200):
        signed = bagminhash.signatures(text, mixed(items + np.uint64(1000 * seed)), counts, 2)
        agree.append((signed[0] == signed[1]).mean())
    assert np.mean(agree) == pytest.approx(4 / 17, abs=0.01)


def test_word_hashes_know_words_and_places():
    text, hashes = word_hashes([b"a b", b"", b" B\tA\n", b"ab"], lower=True)
    assert text.tolist() == [0, 0, 2, 2, 3]
    assert hashes[0] == hashes[3] and hashes[1] == hashes[2] and len(set(hashes.tolist())) == 3


# ---- order minhash, by its definition


def h64(data: bytes, seed: int) -> int:
    return xxhash.xxh64_intdigest(data, seed=seed)


def chain(*numbers, first=42) -> int:
    for number in numbers:
        first = h64((number % (1 << 64)).to_bytes(8, "little"), first)
    return first


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprint(text: str) -> str:
    """For each of 64 turns of the hash order, the two first numbered runs in text order."""
    pieces = re.findall(r"[^\x20\x09-\x0D]{1,16}", text)
    hashes = [h64(p.encode(), 42) for p in pieces]
    runs = [chain(chain(*hashes[k : k + 2]), hashes[k + 2]) for k in range(len(hashes) - 2)] if len(hashes) >= 3 else ([chain(*hashes)] if hashes else [])
    seen, found = Counter(), []
    for place, run in enumerate(runs):
        found.append((signed(h64(seen[run].to_bytes(4, "little"), chain(run))) >> 24, place))
        seen[run] += 1
    out = ""
    for b in range(-32, 32) if found else ():
        smallest = sorted(found, key=lambda x: ((x[0] - (b << 34)) % (1 << 40), x[1]))[:2]
        out += f"{chain(*(v for v, _ in sorted(smallest, key=lambda x: x[1]))) & 0xFFF:03X}"
    return out


def likeness(one: str, other: str) -> float:
    agree = sum(one[k : k + 3] == other[k : k + 3] for k in range(0, min(len(one), len(other)), 3))
    return 1.0 if not one and not other else agree / 64


def test_fingerprints_follow_their_definition(awkward):
    rows = sorted(((r.doc_id, r.text or "") for r in awkward.collect()), key=lambda r: (r[0] is not None, r[0] or 0))
    found = order_minhash.fingerprints(awkward).collect()
    assert Counter((r.doc_id, r.n_chars, r.fingerprint) for r in found) == Counter((i, len(t), fingerprint(t)) for i, t in rows)
    single = {i: k for k, (i, _) in enumerate(rows) if sum(j == i for j, _ in rows) == 1}
    for r in found:
        k = single.get(r.doc_id)
        if k is None or rows[(k + 1) % len(rows)][0] == 8:  # the order of equal ids is by content hash
            continue
        text, following = rows[k][1], rows[(k + 1) % len(rows)][1]
        if following is None:
            continue
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.edited_fingerprint == fingerprint(edited)
        assert r.near_edited == pytest.approx(likeness(fingerprint(text), fingerprint(edited)))
        assert r.near_next == pytest.approx(likeness(fingerprint(text), fingerprint(following)))
    assert all(len(r.fingerprint) in (0, 3 * order_minhash.BINS) for r in found)


def test_likeness_follows_edits(corpus):
    found = order_minhash.fingerprints(corpus).collect()
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in found)
    assert np.mean([r.near_edited for r in found]) > np.mean([r.near_next for r in found]) + 0.03


def test_order_counts(spark):
    a, b = words(20, 60), words(21, 60)
    f = {k: fingerprint(t) for k, t in {"ab": f"{a} {b}", "ba": f"{b} {a}", "ab2": f"{a} {b} end"}.items()}
    assert likeness(f["ab"], f["ba"]) < likeness(f["ab"], f["ab2"])


def test_short_texts_in_another_order_are_less_alike(spark):
    halves = [(words(2 * k + 100, 11), words(2 * k + 101, 11)) for k in range(40)]
    rows = [(2 * k + n, t) for k, (a, b) in enumerate(halves) for n, t in enumerate((f"{a} {b}", f"{b} {a}"))]
    found = {r.doc_id: r.near_next for r in order_minhash.fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    # 18 of 22 runs are shared; two of them keep their order if both are of one half
    assert np.mean([found[2 * k] for k in range(len(halves))]) == pytest.approx(18 / 22 * 17 / 21 * 8 / 17, abs=0.1)


def test_empty_tables(nothing):
    assert bagminhash.classes(nothing).count() == bagminhash.keep_one(nothing).count() == 0
    assert order_minhash.fingerprints(nothing).count() == 0


def test_texts_that_share_much_and_link_to_none_are_not_paired(spark):
    """Similarity 0.70 to 0.79 among all of them, in one bucket: no pair of theirs is made; links among others are."""
    pick = random.Random(4)
    common = words(21, 200).split()
    texts = []
    for k in range(1200):
        own = words(1000 + k, pick.randint(26, 40)).split()
        texts.append(" ".join(common + own))
    linked = words(50, 150).split()
    texts += [" ".join(linked), " ".join(linked[:-4] + ["some", "other", "last", "words"])]
    frame = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "node long, norm string")
    weight = F.size(F.split("norm", " ")) - (bagminhash.WORDS - 1)
    nodes = frame.select("node", F.col("node").alias("root"), weight.cast("long").alias("weight"), F.array(F.lit(7).cast("long")).alias("keys"))
    for every in (False, True):
        found = bagminhash._across(bagminhash._rare(frame, nodes, 0.8), 0.8, every)
        assert {tuple(sorted((r.a, r.b))) for r in found.select("a", "b").collect()} == {(1200, 1201)}
    elsewhere = nodes.withColumn("keys", F.array((F.col("node") + 10).cast("long")))
    assert bagminhash._across(bagminhash._rare(frame, elsewhere, 0.8), 0.8, True).count() == 0
