import random
from collections import defaultdict

import pytest

import __spark_entry__ as driver
from crosstally.llm import components as component_steps
from crosstally.llm import minhash_dedup
from crosstally.llm.components import connected_components
from llm_rows import FILLER, ODD, SCHEMA, SF, rows_of, sentence, words
from llm_rows import empty, odd  # noqa: F401  (fixtures)


def shingle_set(text, width):
    own = words(text)
    if len(own) < width:
        return frozenset([tuple(own)] if own else [])
    return frozenset(zip(*(own[k:] for k in range(width)), strict=False))


def components(links, nodes):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            parent[n] = parent[parent[n]]
            n = parent[n]
        return n

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return {n: root(n) for n in nodes}


def expected(docs, width, percent=80):
    sets = [shingle_set(text, width) for _, text in docs]
    holders = defaultdict(list)
    for k, own in enumerate(sets):
        for shingle in own:
            holders[shingle].append(k)
    links = set()
    for k, own in enumerate(sets):
        for j in {j for shingle in own for j in holders[shingle] if j < k}:
            both = len(own & sets[j])
            if 100 * both >= percent * (len(own) + len(sets[j]) - both):
                links.add((j, k))
    of = components(links, range(len(docs)))
    least = {}
    for k, (doc_id, _) in enumerate(docs):
        if doc_id is not None:
            least[of[k]] = min(least.get(of[k], doc_id), doc_id)
    return sorted(
        ((i, len(sets[k]), least.get(of[k]), i == least.get(of[k])) for k, (i, _) in enumerate(docs)), key=repr
    )


def found(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


def test_query_equals_brute_force(spark):
    got = driver.queries()["op5_minhash_dedup"](spark, SF)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    wanted = expected(rows_of(spark, SF, "doc_id", "text"), 2)
    assert found(got) == wanted
    assert any(not row[-1] for row in wanted)


def near_copies(rng, n, edits, size=120):
    base = sentence(rng, size)
    for _ in range(n):
        own = list(base)
        for _ in range(rng.randrange(edits + 1)):
            own[rng.randrange(len(own))] = f"x{rng.randrange(10**6)}"
        yield " ".join(own)


@pytest.mark.parametrize("width", [2, 5])
def test_groups_around_the_threshold(spark, width):
    """Copies that differ so much that some of a group are linked through others only, or not at all."""
    rng = random.Random(width)
    texts = [t for edits in (1, 3, 6, 12) for t in near_copies(rng, 40, edits)]
    texts += [" ".join(sentence(rng, 80)) for _ in range(20)] + [texts[3]] * 30 + [None, "", " ", "one", "one"]
    rng.shuffle(texts)
    docs = list(enumerate(texts))
    frame = spark.createDataFrame([(i, t, "x", "x", 1, *FILLER) for i, t in docs], SCHEMA)
    assert found(minhash_dedup.near_duplicates(frame, width=width)) == expected(docs, width)
    stays = {r.doc_id for r in minhash_dedup.deduplicated(frame, width=width).collect()}
    assert stays == {row[0] for row in expected(docs, width) if row[-1]}


def test_buckets_without_links_end(spark, monkeypatch):
    """Nodes that share buckets but are not linked leave them, a few in each turn."""
    monkeypatch.setattr(minhash_dedup, "PIVOTS", 2)
    rng = random.Random(3)
    docs = list(enumerate(near_copies(rng, 60, 14, 60)))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    assert found(minhash_dedup.near_duplicates(frame, width=2)) == expected(docs, 2)


def test_fetching_sets_by_a_shuffle(spark, monkeypatch, odd):
    monkeypatch.setattr(minhash_dedup, "FETCHED", 0)
    assert found(minhash_dedup.near_duplicates(odd, width=2)) == expected([r[:2] for r in ODD], 2)


def test_odd_rows(spark, odd):
    assert found(minhash_dedup.near_duplicates(odd)) == expected([r[:2] for r in ODD], 5)
    rows = minhash_dedup.deduplicated(odd)
    assert rows.columns == odd.columns
    # One of each group; documents without words all stay.
    assert sorted((r.doc_id, r.text or "") for r in rows.collect() if r.doc_id is not None) == sorted(
        {(i, t or "") for i, t, *_ in ODD if i is not None and i not in (2, 11)}
    )


def test_empty(spark, empty):
    assert minhash_dedup.near_duplicates(empty).collect() == []
    assert minhash_dedup.deduplicated(empty).collect() == []


def test_components(spark):
    rng = random.Random(1)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)]
    links += [(k, k + 1) for k in range(1000, 1100)] + [(2000, k) for k in range(2001, 2400)]
    links += [(5, 5), (None, 3), (3, None)]
    frame = spark.createDataFrame(links, "a long, b long")
    nodes = {n for a, b in links if a is not None and b is not None and a != b for n in (a, b)}
    wanted = components([x for x in links if None not in x], nodes)
    assert {r.node: r.component for r in connected_components(frame).collect()} == wanted
    assert connected_components(frame.limit(0)).collect() == []


def test_stars_take_no_round(spark, monkeypatch):
    """Links that all lead to a least node are components as they are; a chain has to become one."""
    written = []
    keep = component_steps.kept
    monkeypatch.setattr(component_steps, "kept", lambda rows, name: written.append(name) or keep(rows, name))
    links = spark.createDataFrame([(1, 2), (3, 1), (3, 1), (4, 1), (7, 6), (5, 5)], "a long, b long")
    found = connected_components(links)
    assert sorted(map(tuple, found.collect())) == [(1, 1), (2, 1), (3, 1), (4, 1), (6, 6), (7, 6)]
    assert written == ["edges"]

    chain = spark.createDataFrame([(k, k + 1) for k in range(9)] + [(20, 22), (21, 22)], "a long, b long")
    found = connected_components(chain)
    assert sorted(map(tuple, found.collect())) == [(k, 0) for k in range(10)] + [(k, 20) for k in (20, 21, 22)]
    assert connected_components(links.limit(0)).collect() == []
