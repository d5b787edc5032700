import hashlib
import re
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from plaintlens.llm import mixing, queries, toxicity
from tests.llm.conftest import SF
from tests.llm.test_exact_and_mixing import SPACE, WORD, targets
from tests.llm.test_near_and_fingerprints import classes


@pytest.fixture(scope="module")
def outputs(spark, tmp_path_factory):
    """The rows of documents and of every stage's result."""
    folder = tmp_path_factory.mktemp("pipeline")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = [docs.collect()]
    for name, stage in corpus_pipeline.STAGES:
        made = stage(spark, docs, SF)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert made.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        made.write.parquet(str(folder / name))
        docs = spark.read.parquet(str(folder / name))
        found.append(docs.collect())
    return found


def test_toxic_documents_go(spark, outputs):
    docs, marks = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    kept = {r.doc_id for r in toxicity.toxicity(docs, marks).where("predicted = 0").collect()}
    assert {r.doc_id for r in outputs[1]} == kept and set(outputs[1]) <= set(outputs[0])


def test_one_of_equal_documents_stays(outputs):
    first = {}
    for r in sorted(outputs[1]):
        first.setdefault(SPACE.sub(" ", r.text or ""), r)
    assert Counter(outputs[2]) == Counter(first.values())


def test_one_of_near_documents_stays(outputs):
    rows = sorted(outputs[2])
    groups = classes([(r.doc_id, r.text) for r in rows])
    assert {r.doc_id for r in outputs[3]} == {rows[min(g)].doc_id for g in groups}


def test_mix_meets_its_targets(outputs):
    size = lambda r: len(WORD.findall(r.text or ""))
    sizes, taken = defaultdict(int), defaultdict(int)
    before = {r.doc_id: r for r in outputs[3]}
    for r in outputs[3]:
        sizes[r.source] += size(r)
    by_doc = Counter()
    for r in outputs[4]:
        taken[r.source] += size(r)
        by_doc[r.doc_id] += size(r)
        assert set(WORD.findall(r.text)) <= set(WORD.findall(before[r.doc_id].text))
    for source, target in targets(sizes).items():
        assert abs(taken[source] - target) <= 2 * mixing.BLOCK
    assert all(n <= 2 * size(before[d]) for d, n in by_doc.items())


def test_tokens_decode_to_the_texts(outputs):
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=queries.tokenizer().ranks, special_tokens={})
    wanted = Counter((r.doc_id, tuple(library.encode_ordinary(r.text)), hashlib.sha256(r.text.encode()).hexdigest()) for r in outputs[4])
    assert Counter((r.doc_id, tuple(r.token_ids), r.decoded_sha256) for r in outputs[5]) == wanted


def test_run_is_the_stages_in_turn(spark, outputs):
    assert Counter((r.doc_id, r.ids_sha256) for r in corpus_pipeline.run(spark, SF).collect()) == Counter((r.doc_id, r.ids_sha256) for r in outputs[5])


def test_registered():
    import __spark_entry__ as entry_point

    names = entry_point.queries()
    assert "pipeline" in names and all(any(re.match(rf"op{n}_", q) for q in names) for n in range(1, 11))
    assert "pipeline" not in entry_point.oracle_sql()
