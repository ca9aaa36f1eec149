import math
import random

import pytest

import __spark_entry__ as driver
from crosstally.llm import topk_search
from llm_rows import SF, rows_of

SCHEMA = "vec_id long, embedding array<float>, label int, score string, low string, k string"


def expected(rows, k=20, every=20, scale=64):
    whole = [
        (i, [math.floor(scale * x) for x in v])
        for i, v in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for q, a in whole:
        if q % every == 0:
            scored = [(-sum(x * y for x, y in zip(a, b, strict=True)), i) for i, b in whole if i != q and len(a) == len(b)]
            out += [(q, rank, i, -s) for rank, (s, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out)


def search(frame, k=20, every=20):
    vectors = topk_search.quantised(frame)
    return sorted(map(tuple, topk_search.top_k(vectors.where(f"vec_id % {every} = 0"), vectors, k).collect()))


def frame_of(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x", "x", "x") for i, v in rows], SCHEMA)


def test_query_equals_brute_force(spark):
    got = driver.queries()["op8_topk_search"](spark, SF)
    assert sorted(map(tuple, got.collect())) == expected(rows_of(spark, SF, "vec_id", "embedding", table="embeddings"))


@pytest.mark.parametrize("bins", [2, 7, 1024])
@pytest.mark.parametrize("blocks", [(2048, 8192, 48), (3, 10, 2)])
def test_ties_and_vectors_that_take_no_part(spark, monkeypatch, bins, blocks):
    monkeypatch.setattr(topk_search, "BINS", bins)
    for name, value in zip(("QUERY_BLOCK", "CANDIDATE_BLOCK", "CANDIDATE_BLOCKS"), blocks, strict=True):
        monkeypatch.setattr(topk_search, name, value)
    rng = random.Random(bins)
    rows = [(k, [rng.uniform(-1, 1) for _ in range(4)]) for k in range(60)]
    rows += [(k, [0.5, 0.5, 0.5, 0.5]) for k in range(60, 110)]  # one vector, many times
    rows += [(k, [rng.choice([-0.01, 0.0, 0.01]) for _ in range(4)]) for k in range(110, 140)]
    rows += [(140, None), (141, []), (142, [None, 1.0, 1.0, 1.0]), (143, [math.nan] * 4), (144, [math.inf] * 4)]
    rows += [(None, [1.0] * 4), (160, [1.0, 2.0]), (161, [3.0, 4.0]), (180, [0.0] * 4), (200, [1000.0] * 4), (220, [])]
    rng.shuffle(rows)
    rows = [(i, None if v is None else [None if x is None else float(f"{x:.3f}") for x in v]) for i, v in rows]
    frame = frame_of(spark, rows)
    as_stored = [(r.vec_id, r.embedding) for r in frame.collect()]
    assert search(frame, 7) == expected(as_stored, 7)
    assert search(frame, 200) == expected(as_stored, 200)  # more than there are


def test_repeated_rows(spark):
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [0.5, 0.0]), (1, [0.5, 0.0]), (2, [0.25, 0.0])]
    assert search(frame_of(spark, rows), 2) == [(0, 1, 1, 2048), (0, 2, 1, 2048)]


def test_large_components_stay_exact(spark):
    rows = [(0, [3e5, 1e-2]), (1, [3e5 + 1 / 64, 0.0]), (2, [3e5, 0.0]), (20, [3e6, 3e6])]
    frame = frame_of(spark, rows)
    assert search(frame) == expected([(r.vec_id, r.embedding) for r in frame.collect()])


def test_scores_beyond_a_long_are_refused(spark):
    with pytest.raises(ValueError, match="long"):
        search(frame_of(spark, [(0, [1e12]), (1, [1e12])]))


def test_empty(spark):
    assert search(frame_of(spark, [])) == []
    assert search(frame_of(spark, [(0, [1.0])])) == []
    assert search(frame_of(spark, [(1, [1.0]), (2, [1.0])])) == []
