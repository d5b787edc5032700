import hashlib
import json
import random
import unicodedata

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from plaintlens.llm import queries, word_bpe
from tests.llm.conftest import SF, awkward_rows

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "Hello  World's 12 a\tb <|endoftext|> x", "naïve Ünïcode 日本語 \U0001f642 ΣΑΣ İ <|ENDOFTEXT|>",
    "don't I'LL <|startoftext|>A<|endoftext|>", "a\x0bb\x1cc\x85d é é Å ", "<|<|endoftext|>|>", "e<|endoftext|>́",
    "\x00\x01 \n\r", "ǅ ŉ ẞ", "x" * 5000, "aaab" * 999, " ", "ﬁ ½ ² Ⅷ १", "", None,
]


@pytest.fixture(scope="module")
def own():
    return word_bpe.read_tokenizer(PATH)


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(PATH)


def expected(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    return ids, library.decode(ids, skip_special_tokens=False)


def compare(own, library, texts):
    ids = own.encoded(pa.array(texts, pa.string()))
    assert list(zip(ids.to_pylist(), own.decoded(ids).to_pylist())) == [expected(library, t) for t in texts]


def test_odd_texts(own, library):
    compare(own, library, ODD)
    compare(own, library, [])
    compare(own, library, [None, ""])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.one_of(
    st.characters(exclude_categories=("Cs", "Cn", "Co", "Mn", "Me")), st.sampled_from("aAbBiI \n'<|>Σ́")), max_size=40), max_size=6))
def test_any_text(own, library, texts):
    compare(own, library, texts)


def test_every_assigned_character(own, library):
    # the combining classes of the three left out differ between the two libraries' Unicode tables
    chars = [chr(c) for c in range(0x110000) if unicodedata.category(chr(c)) not in ("Cn", "Cs", "Co")]
    texts = [f"A{c}b {c}\u0301" for c in chars if ord(c) not in (0x1DF6, 0x1E4EC, 0x1E4ED)]
    wanted = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert own.encoded(pa.array(texts)).to_pylist() == wanted


def test_long_word_of_many_merges(own, library):
    pick = random.Random(1)
    compare(own, library, ["".join(pick.choice("etaoinshrdlu") for _ in range(20_000)), "ab" * 10_001])


def test_merging_many_words_is_merging_each(own):
    words = [w.encode() for w in "the thing in inning a banana ananas aaaaaaa".split()]
    flat, sizes = own.merged(words)
    each = [own.merged([w])[0].tolist() for w in words]
    assert [part.tolist() for part in np.split(flat, np.cumsum(sizes)[:-1])] == each


def test_unknown_ids_decode_to_nothing(own):
    ids = pa.array([[0, 10**6, 1], [-1], [], [10**6, 2]], pa.list_(pa.int32()))
    assert own.decoded(ids).to_pylist() == ["! \"", "", "", "#"]


def test_query(spark, library):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries.op11_word_bpe(spark, SF).collect()
    assert {r.doc_id for r in rows} == set(texts) and len(rows) == len(texts)
    for r in rows:
        ids, text = expected(library, texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_awkward_rows_and_the_way_back(clashing, nothing, own, library):
    made = word_bpe.tokenised(clashing, own)
    assert set(made.columns) == {*clashing.columns, *word_bpe.MADE} - {"text"}
    back = word_bpe.detokenised(made.select("doc_id", "token_ids"), own)
    wanted = sorted(expected(library, row[1])[1] for row in awkward_rows())
    assert sorted(r.text for r in back.collect()) == wanted
    assert word_bpe.tokenised(nothing, own).count() == 0 and word_bpe.detokenised(word_bpe.tokenised(nothing, own), own).count() == 0


def test_a_file_whose_merges_are_out_of_order_is_refused(tmp_path):
    told = json.load(open(PATH, encoding="utf-8"))
    told["model"]["merges"] = told["model"]["merges"][::-1]
    (tmp_path / "t.json").write_text(json.dumps(told), encoding="utf-8")
    with pytest.raises(ValueError):
        word_bpe.read_tokenizer(str(tmp_path / "t.json"))
