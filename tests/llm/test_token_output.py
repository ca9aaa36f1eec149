import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

import __spark_entry__ as driver
from crosstally.llm import token_output
from llm_rows import ODD, SF, rows_of
from llm_rows import empty, odd  # noqa: F401  (fixtures)

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
KNOWN = token_output.PieceIds(PATH)


@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300)))
def test_ranks_come_back(ranks):
    control, data = token_output.encode_ranks(np.array(ranks, "<u4"))
    assert len(control) == -(-len(ranks) // 4)
    assert token_output.decode_ranks(control, data, len(ranks)).tolist() == ranks


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text() | st.text("aZé ßÖ.,'s<|>endoftext \t\n\x1c\x85\xa0　İΣς1²́")))
def test_ids_are_those_of_the_library(texts):
    ids, at = KNOWN.texts(pa.array(texts, pa.string()))
    for k, text in enumerate(texts):
        assert ids[at[k] : at[k + 1]].tolist() == LIBRARY.encode(text, add_special_tokens=False).ids


def expected(rows):
    start = 0
    for doc_id, text in rows:
        ids = [*LIBRARY.encode(text or "", add_special_tokens=False).ids, 1]
        yield doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)


def test_query_equals_brute_force(spark):
    docs = sorted(rows_of(spark, SF, "doc_id", "text"))
    got = driver.queries()["op2_token_output"](spark, SF).collect()
    assert sorted(map(tuple, got)) == list(expected(docs))


def test_odd_rows(spark, odd):
    rows = token_output.token_output(spark, odd, PATH).collect()
    # Without an id first; of one id, the shorter first.
    size = lambda r: len(LIBRARY.encode(r[1] or "", add_special_tokens=False).ids)
    order = sorted(ODD, key=lambda r: (r[0] is not None, r[0] or 0, size(r)))
    key = lambda r: (r[0] is not None, r[0] or 0, r[1])
    assert sorted(map(tuple, rows), key=key) == list(expected([r[:2] for r in order]))


def test_empty(spark, empty):
    assert token_output.token_output(spark, empty, PATH).collect() == []


@pytest.mark.parametrize("remembered", [1, 1000])
def test_forgetting_changes_nothing(monkeypatch, remembered):
    monkeypatch.setattr(token_output, "REMEMBERED", remembered)
    known = token_output.PieceIds(PATH)
    texts = ["the cat", "a cat, the dog", "the cat", "The dog."]
    for text in texts:
        ids, _ = known.texts(pa.array([text]))
        assert ids.tolist() == LIBRARY.encode(text, add_special_tokens=False).ids


class Given:
    """Stands for a tokenizer and notes the words it is given."""

    def __init__(self, tokenizer):
        self.tokenizer, self.words = tokenizer, []

    def encode(self, words, **options):
        self.words += words
        return self.tokenizer.encode(words, **options)


def test_a_word_is_looked_up_once_whatever_its_case_and_marks():
    known = token_output.PieceIds(PATH)
    known.words = Given(known.words)
    for text in ["Vellumcraft, zorbins!", "(vellumcraft) VELLUMCRAFT zorbins Vellumcraft."]:
        ids, _ = known.texts(pa.array([text]))
        assert ids.tolist() == LIBRARY.encode(text, add_special_tokens=False).ids
    assert sorted(known.words.words) == ["vellumcraft", "zorbins"]


def test_the_most_used_parts_stay():
    known = token_output.PieceIds(PATH)
    known.texts(pa.array(["one two three four", "one two three", "one two"]))
    known.texts(pa.array(["one two"]))
    known.forget(2)
    assert sorted(known.parts.to_pylist()) == ["one", "two"]
    ids, _ = known.texts(pa.array(["four two"]))
    assert ids.tolist() == LIBRARY.encode("four two", add_special_tokens=False).ids


def test_ids_are_listed(spark, odd):
    files, by_rank = token_output.write_tokens(odd, PATH)
    lists = {r.doc_id: r.ids for r in token_output.decoded(files, by_rank).collect()}
    assert lists[1] == [*LIBRARY.encode(ODD[0][1], add_special_tokens=False).ids, 1]
    assert lists[4] == [1]
