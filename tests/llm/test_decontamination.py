import hashlib
import random

import pytest

import __spark_entry__ as driver
from crosstally.llm import decontamination
from llm_rows import FILLER, ODD, SCHEMA, SF, rows_of, sentence, words
from llm_rows import empty, odd  # noqa: F401  (fixtures)

PATTERN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def expected(docs, benchmark, width=13):
    windows = {}
    for item, text in benchmark:
        own = words(text, PATTERN)
        for k in range(max(1, len(own) - width + 1) if own else 0):
            windows.setdefault(tuple(own[k : k + width]), set()).add(str(item))
    sizes = {len(w) for w in windows}
    out = []
    for doc_id, text in docs:
        own, hit, items = words(text, PATTERN), set(), set()
        for n in sizes:
            for k in range(len(own) - n + 1):
                found = windows.get(tuple(own[k : k + n]))
                if found:
                    hit.update(range(k, k + n))
                    items |= found
        bad = len(hit) > 0 and 20 * len(hit) >= len(own)
        out.append((doc_id, len(own), len(hit), sorted(items), bad))
    return sorted(out, key=repr)


def found(frame):
    columns = ("doc_id", "n_words", "n_hit", "items", "contaminated")
    return sorted((tuple(row[c] for c in columns) for row in frame.collect()), key=repr)


def test_query_equals_brute_force(spark):
    docs = rows_of(spark, SF, "doc_id", "text")
    wanted = expected(docs, rows_of(spark, SF, "item_id", "text", table="benchmark"))
    got = driver.queries()["op6_decontamination"](spark, SF).collect()
    digest = lambda items: hashlib.sha256(",".join(items).encode()).hexdigest()
    assert sorted(map(tuple, got), key=repr) == sorted(
        ((i, n, h, len(items), digest(items), bad) for i, n, h, items, bad in wanted), key=repr
    )
    assert any(row[-1] for row in wanted)


@pytest.mark.parametrize("block_bytes", [30, 8_000_000])
def test_planted_passages(spark, block_bytes):
    rng = random.Random(5)
    items = [(k, " ".join(sentence(rng, n))) for k, n in enumerate([5, 13, 14, 40, 1, 60])]
    items += [(7, None), (8, ""), (9, "... --"), (3, "w1 w2 w3"), (10, items[3][1])]
    docs = []
    for k in range(60):
        own = sentence(rng, rng.randrange(0, 400))
        if k % 2:
            item = words(items[rng.randrange(6)][1])
            cut = item[: rng.randrange(1, len(item) + 1)]
            at = rng.randrange(len(own) + 1)
            own[at:at] = [w.upper() if rng.random() < 0.3 else w for w in cut]
        docs.append((k, rng.choice([" ", ", ", "\n"]).join(own)))
    docs += [(60, items[3][1] + " " + items[3][1]), (60, items[3][1] + " " + items[3][1]), (61, None)]
    frame = spark.createDataFrame([(i, t, *["x"] * 2, 1, *FILLER) for i, t in docs], SCHEMA)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = decontamination.contamination(frame, benchmark, block_bytes=block_bytes)
    assert found(got) == expected(docs, items)
    for row in got.where("n_hit > 0").collect():
        text = dict(docs)[row.doc_id]
        inside = [words(text[s.start : s.end], PATTERN) for s in row.spans]
        assert sum(map(len, inside)) == row.n_hit


def test_odd_rows(spark, odd):
    benchmark = spark.createDataFrame([(1, "ONE"), (2, "no id at all")], "item_id long, text string")
    got = decontamination.contamination(odd, benchmark)
    assert found(got) == expected([r[:2] for r in ODD], [(1, "ONE"), (2, "no id at all")])


def test_spans_are_offsets_in_the_text_as_it_was(spark):
    text = "Été -- the FIRST, second! third \U0001f600"
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    benchmark = spark.createDataFrame([(1, "first second")], "item_id long, text string")
    (row,) = decontamination.contamination(docs, benchmark).collect()
    assert [text[s.start : s.end] for s in row.spans] == ["FIRST, second"]


def test_empty(spark, empty, odd):
    nothing = spark.createDataFrame([], "item_id long, text string")
    assert decontamination.contamination(empty, nothing).collect() == []
    got = decontamination.contamination(odd, nothing)
    assert found(got) == expected([r[:2] for r in ODD], [])
