from collections import Counter

import public_tokenizers

import __spark_entry__ as driver
import corpus_pipeline
from llm_rows import FILLER, SCHEMA, SF, rows_of, sentence
from llm_rows import empty, odd  # noqa: F401  (fixtures)
from test_decontamination import expected as contamination
from test_minhash_dedup import expected as duplicates
from test_source_mixing import targets
from test_token_output import expected as tokens


def stage(spark, name, docs, sf_dir=SF):
    return dict(corpus_pipeline.STAGES)[name](spark, docs, sf_dir)


def test_each_stage_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    rows = {r.doc_id: r for r in docs.collect()}

    kept = stage(spark, "language ID", docs)
    assert kept.columns == columns
    assert {r.doc_id for r in kept.collect()} == {i for i, r in rows.items() if any(map(str.isalpha, r.text or ""))}

    docs = kept
    kept = stage(spark, "MinHash near-dedup", docs)
    assert kept.columns == columns
    before = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r[0] for r in duplicates(before, 5) if r[-1])

    docs = kept
    kept = stage(spark, "benchmark decontamination", docs)
    assert kept.columns == columns
    items = rows_of(spark, SF, "item_id", "text", table="benchmark")
    before = [(r.doc_id, r.text) for r in docs.collect()]
    bad = {r[0] for r in contamination(before, items) if r[-1]}
    assert bad and {r.doc_id for r in kept.collect()} == {i for i, _ in before} - bad

    docs = kept
    mixed = stage(spark, "mixing sources to target weights", docs)
    assert mixed.columns == columns
    sizes, taken, longest = Counter(), Counter(), Counter()
    for r in docs.collect():
        sizes[r.source] += len(r.text.split())
        longest[r.source] = max(longest[r.source], len(r.text.split()))
    for r in mixed.collect():
        taken[r.source] += len(r.text.split())
        assert rows[r.doc_id] == r
    for source, target in targets(sizes).items():
        assert abs(taken[source] - target) <= 2 * longest[source] + 1
    assert max(Counter(r.doc_id for r in mixed.collect()).values()) <= 2

    got = stage(spark, "token-ID output", mixed)
    order = sorted((r.doc_id, r.text) for r in mixed.collect())
    assert sorted(map(tuple, got.collect())) == list(tokens(order))


def test_run_is_all_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, function in corpus_pipeline.STAGES:
        docs = function(spark, docs, SF)
    got = driver.queries()["pipeline"](spark, SF)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, docs.collect()))
    assert public_tokenizers.path("word_bpe_49k.json")


def test_odd_rows_and_extra_columns(spark, odd, empty):
    for docs in (odd, empty):
        for _, function in corpus_pipeline.STAGES[:-1]:
            docs = function(spark, docs, SF)
            assert docs.columns == odd.columns
        rows = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
        assert len(rows) == docs.count()


def test_clean_documents_stay(spark):
    import random

    rng = random.Random(11)
    clean = [(k, " ".join(sentence(rng, 60)), "en", "a", 1, *FILLER) for k in range(50)]
    docs = spark.createDataFrame(clean, SCHEMA)
    for _, function in corpus_pipeline.STAGES[:3]:
        docs = function(spark, docs, SF)
    assert docs.count() == 50


def test_clean_documents_without_labels_stay(spark):
    texts = [*(f"A clean text number {k}." for k in range(20)), None, "", "12 ?!"]
    docs = spark.createDataFrame([(k, t, None, "a", 1, *FILLER) for k, t in enumerate(texts)], SCHEMA)
    kept = stage(spark, "language ID", docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == list(range(20))
