import zlib

import numpy as np
import pytest

import __spark_entry__ as driver
from crosstally.llm import language_id
from llm_rows import ODD, SF, rows_of
from llm_rows import empty, odd  # noqa: F401  (fixtures)


def test_query_on_held_out_documents(spark):
    got = driver.queries()["op3_language_id"](spark, SF).collect()
    docs = {r[0]: r for r in rows_of(spark, SF, "doc_id", "text", "lang")}
    assert sorted(r.doc_id for r in got) == sorted(docs)
    right = []
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1
        if r.held_out:
            right.append(r.lang_pred == docs[r.doc_id][2])
    assert np.mean(right) >= 0.97


def test_labels_of_held_out_documents_are_not_looked_at(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    wrong = docs.selectExpr("doc_id", "text", "if(crc32(string(doc_id)) % 5 = 0, 'xx', lang) AS lang")
    order = lambda frame: sorted(map(tuple, frame.collect()))
    assert order(language_id.identify(docs)) == order(language_id.identify(wrong))


def test_odd_rows(spark, odd):
    got = sorted((tuple(r) for r in language_id.identify(odd).collect()), key=repr)
    assert sorted((r[0] for r in got), key=repr) == sorted((r[0] for r in ODD), key=repr)
    letters = {i: any(c.isalpha() for c in t or "") for i, t, *_ in ODD if i != 5}
    for doc_id, _, lang, score in got:
        if doc_id != 5:
            assert (lang == "und") == (not letters[doc_id]), doc_id
            assert 0 <= score <= 1 and (score > 0) == (lang != "und")
    assert {r[2] for r in got} <= {"en", "de", "fr", "und"}


def test_nothing_to_learn_from(spark, empty):
    assert language_id.identify(empty).collect() == []
    docs = spark.createDataFrame([(1, "some text", None), (2, None, "en")], "doc_id long, text string, lang string")
    assert sorted(map(tuple, language_id.identify(docs).collect())) == [
        (1, False, "und", 0.0),
        (2, False, "und", 0.0),
    ]


def test_penalties_leave_weights_at_zero(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language_id.fitted(docs)
    used = np.count_nonzero(model.weights.any(axis=1))
    assert 0 < used < language_id.FEATURES / 4
    assert model.temperature > 0


def test_features_are_counts_of_folded_ngrams():
    at, times = language_id.features("Ab, AB")
    # " ab ab " folded: blanks stay, so 8 + 7 + 6 n-grams and the padding's.
    assert times.sum() == sum(len("  Ab, AB  ") - 2 - n + 1 for n in (1, 2, 3))
    assert language_id.features("AB, ab")[0].tolist() == at.tolist()
    assert language_id.features("12 ?!") is None
    assert language_id.features("") is None


def test_document_frequencies_cover_all_rows(spark):
    texts = spark.createDataFrame([("ab",), ("AB ab",), ("?",)], "_text string")
    n = {r.feature: r.n for r in language_id.document_frequencies(texts).collect()}
    assert n.pop(-1) == 3
    assert max(n.values()) == 2 and set(language_id.features("ab")[0]) <= {f for f, times in n.items() if times == 2}


def test_temperature_is_that_of_least_loss():
    rng = np.random.default_rng(0)
    logits = rng.normal(size=(4000, 3)) * 2
    p = np.exp(logits / 2.5)
    p /= p.sum(axis=1, keepdims=True)
    labels = (rng.random(4000)[:, None] > p.cumsum(axis=1)).sum(axis=1)
    assert language_id.calibrated(logits, labels) == pytest.approx(2.5, rel=0.15)
    assert language_id.calibrated(np.zeros((0, 3)), np.zeros(0, int)) == 1.0


def test_a_rare_language_is_learned_however_many_rows_the_others_have(spark):
    """A uniform sample of 100 of these rows holds none, or hardly one, of the rare language."""
    rng = np.random.default_rng(5)
    make = lambda letters: " ".join("".join(rng.choice(list(letters), 5)) for _ in range(12))
    rows = [(k, make("abcdefg" if k % 2 else "hijklmn"), "aa" if k % 2 else "hh") for k in range(3000)]
    rows += [(5000 + k, make("стувфхц"), "rare") for k in range(12)] + [(6000, make("αβγδεζη"), "once")]
    labelled = spark.createDataFrame(rows, "_id long, _text string, _lang string")
    assert language_id.language_sizes(labelled) == {"aa": 1500, "hh": 1500, "rare": 12, "once": 1}
    model = language_id.train(labelled, sample=100)
    assert model.languages == ["aa", "hh", "once", "rare"]
    assert [model.predict(make("стувфхц"))[0] for _ in range(20)] == ["rare"] * 20
    assert model.predict(make("abcdefg"))[0] == "aa" and model.predict(make("hijklmn"))[0] == "hh"
    assert model.weights[:, model.languages.index("once")].any()
