import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

import __spark_entry__ as driver
from crosstally.llm import token_counts
from llm_rows import ODD, SF, rows_of
from llm_rows import empty, odd  # noqa: F401  (fixtures)

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)


def size(text):
    return len(LIBRARY.encode(text or "", add_special_tokens=False).ids)


def expected(rows, limit=512):
    return sorted(
        ((i, len((t or "").encode()), size(t), size(t) > limit) for i, t in rows),
        key=repr,
    )


@settings(max_examples=500, deadline=None)
@given(st.text() | st.text("aé 's\t\n\r\x0b\x1c\x1f\x85\xa0\u1680\u180e\u2003\u2028\u200b\u3000<|endoftext|>1.!"))
def test_pre_tokens_add_up(text):
    parts = token_counts.pre_tokens(text)
    assert "".join(parts) == text
    assert sum(map(size, parts)) == size(text)


def test_query_equals_brute_force(spark):
    got = driver.queries()["op10_token_counts"](spark, SF).collect()
    assert sorted(map(tuple, got), key=repr) == expected(rows_of(spark, SF, "doc_id", "text"))


@pytest.mark.parametrize("common", [0, 5, 1 << 18])
def test_odd_rows(spark, odd, common):
    got = token_counts.token_counts(odd, PATH, limit=20, common=common).collect()
    assert sorted(map(tuple, got), key=repr) == expected([r[:2] for r in ODD], 20)


def test_empty(spark, empty):
    assert token_counts.token_counts(empty, PATH).collect() == []
