import math
import random
import zlib

import numpy as np
import pytest

import __spark_entry__ as driver
from crosstally.llm import toxicity
from llm_rows import LONG, ODD, SF, rows_of
from llm_rows import empty, odd  # noqa: F401  (fixtures)


def accuracy(rows, labels):
    told = [(row, labels[row.doc_id]) for row in rows if row.held_out and row.doc_id in labels]
    return sum(row.predicted == label for row, label in told) / len(told), len(told)


def held_out(number):
    return number is not None and zlib.crc32(str(number).encode()) % 5 == 0


def test_query_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    rows = driver.queries()["op12_toxicity"](spark, sf).collect()
    labels = dict(rows_of(spark, sf, "doc_id", "toxic", table="labels"))
    assert sorted(row.doc_id for row in rows) == sorted(i for (i,) in rows_of(spark, sf, "doc_id"))
    assert all(row.held_out == held_out(row.doc_id) and 0 <= row.score <= 1 for row in rows)
    assert all(row.predicted == int(row.score >= 0.5) for row in rows)
    share, n = accuracy(rows, labels)
    # 330 labelled documents to learn from, 70 held out, of which 64 have label 0.
    assert n == 70 and share >= 0.94


def pairs(rng, n):
    """Texts that are toxic where two terms belong together; apart each occurs in both kinds alike."""
    for number in range(n):
        insult, group = rng.choice(["dolt", "oaf"]), rng.choice(["redcaps", "blueshirts"])
        words = [f"w{rng.randrange(40)}" for _ in range(6)] + [insult, group]
        rng.shuffle(words)
        yield number, " ".join(words), int((insult == "dolt") == (group == "redcaps"))


def test_pairs_that_no_sum_of_weights_tells_apart(spark):
    rows = list(pairs(random.Random(3), 3000))
    docs = spark.createDataFrame([row[:2] for row in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, label) for i, _, label in rows], "doc_id long, toxic int")
    share, n = accuracy(toxicity.toxicity(docs, labels).collect(), {i: label for i, _, label in rows})
    assert n > 500 and share > 0.97
    # Without vectors it is no better than a coin toss.
    machine = toxicity.Machine()
    machine.vectors[:] = 0
    known = [(toxicity.features(text), label) for _, text, label in rows]
    flat = np.ones(toxicity.FEATURES)
    for (at, times), label in known[:2000]:
        machine.learn(at, toxicity.weighted(at, times, flat), label)
        machine.vectors[:] = 0
    model = toxicity.Model(flat, machine.weights(slice(None)), machine.vectors, machine.bias)
    right = [(model.sum_of(at, toxicity.weighted(at, n, flat)) > 0) == label for (at, n), label in known[2000:]]
    assert np.mean(right) < 0.6


def test_labels_of_held_out_rows_are_not_learned(spark):
    rows = list(pairs(random.Random(4), 400))
    docs = spark.createDataFrame([row[:2] for row in rows], "doc_id long, text string")
    scores = []
    for turned in (False, True):
        labels = [(i, 1 - y if turned and held_out(i) else y) for i, _, y in rows]
        frame = spark.createDataFrame(labels, "doc_id long, toxic int")
        scores.append(sorted(map(tuple, toxicity.toxicity(docs, frame).collect())))
    assert scores[0] == scores[1]


def test_pairwise_sum_and_step_equal_the_plain_formulas():
    rng = np.random.default_rng(5)
    machine = toxicity.Machine(l1=0.0, l2=0.0)
    at, x = np.array([3, 9, 200, 77_000]), rng.normal(size=4)
    machine.z[at] = rng.normal(size=4)
    w, v = machine.weights(at), machine.vectors[at].copy()

    def total(vectors):
        plain = sum(x[i] * x[j] * float(vectors[i] @ vectors[j]) for i in range(4) for j in range(i))
        return machine.bias + float(x @ w) + plain

    assert total(v) == pytest.approx(machine.bias + float(x @ w) + toxicity.together(x, v)[0])
    error, small = 1 / (1 + math.exp(-total(v))) - 1, 1e-6
    z, squares = machine.z[at].copy(), machine.squares[at].copy()
    machine.learn(at, x, 1)
    assert machine.n[at] == pytest.approx((error * x) ** 2)
    assert machine.z[at] == pytest.approx(z + error * x - np.abs(error * x) / machine.alpha * w)
    for i in range(4):
        for f in range(toxicity.FACTORS):
            moved = v.copy()
            moved[i, f] += small
            g = error * (total(moved) - total(v)) / small
            step = machine.step * g / math.sqrt(squares[i, f] + g * g)
            assert machine.vectors[at][i, f] == pytest.approx(v[i, f] - step, abs=1e-5)


def test_calibration_is_of_greatest_likelihood():
    rng = np.random.default_rng(6)
    sums = rng.normal(size=4000) * 3
    labels = (rng.random(4000) < 1 / (1 + np.exp(-(0.5 * sums - 1)))).astype(int)
    slope, shift = toxicity.calibrated(sums, labels, np.ones(4000))
    assert slope == pytest.approx(0.5, abs=0.05) and shift == pytest.approx(-1, abs=0.15)
    assert toxicity.calibrated(sums, np.ones(4000, int), np.ones(4000)) == (1.0, 0.0)


def test_odd_rows(spark, odd):
    labels = [(1, 0), (2, 1), (2, 0), (7, 1), (8, 0), (9, None), (None, 1), (10, 7), (99, 1), (12, 1), (3, 0)]
    frame = spark.createDataFrame([(*row, "x") for row in labels], "doc_id long, toxic int, text string")
    got = toxicity.toxicity(odd, frame).collect()
    assert sorted((row.doc_id is None, row.doc_id or 0) for row in got) == sorted((r[0] is None, r[0] or 0) for r in ODD)
    assert all(0 <= row.score <= 1 and row.held_out == held_out(row.doc_id) for row in got)
    of_text = {}
    for row, (_, text, *_) in zip(sorted(got, key=repr), sorted(ODD, key=repr), strict=True):
        of_text.setdefault(text or "", set()).add(row.doc_id)
    none = {row.score for row in got if row.doc_id in (3, 4, 6)}
    assert len(none) == 1  # NULL, empty and without a word
    assert len({row.score for row in got if row.doc_id in (9, 11)}) == 1 and LONG


@pytest.mark.parametrize("kind, score", [([], 0.0), ([0], 0.0), ([1], 1.0)])
def test_labels_of_one_kind(spark, odd, kind, score):
    labels = spark.createDataFrame([(i, y) for i in (1, 2, 7) for y in kind], "doc_id long, toxic int")
    assert {round(row.score, 6) for row in toxicity.toxicity(odd, labels).collect()} == {score}


def test_empty(spark, empty):
    labels = spark.createDataFrame([(1, 1)], "doc_id long, toxic int")
    assert toxicity.toxicity(empty, labels).collect() == []
