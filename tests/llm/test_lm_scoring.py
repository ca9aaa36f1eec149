import random

import numpy as np
import pyarrow as pa
import pytest

from crosstally.llm import lm_scoring as lm
from llm_rows import FILLER, ODD, SCHEMA, SF, rows_of, words
from llm_rows import empty, odd  # noqa: F401  (fixtures)


def naive(p, ids):
    """The score of one text, position by position, with one softmax over the whole vocabulary."""
    padded = [lm.EDGE, lm.EDGE, *ids, lm.EDGE, lm.EDGE]
    total = 0.0
    for k, target in enumerate(ids):
        x = np.concatenate([p["embedding"][padded[k + 2 + o]] for o in lm.OFFSETS]).astype(float)
        h = np.tanh(x @ p["hidden"] + p["hidden_bias"])
        of_class = np.exp(h @ p["class"] + p["class_bias"])
        of_class /= of_class.sum()
        chance = []
        for c in range(lm.CLASSES):
            within = np.exp(h @ p["word"][c] + p["word_bias"][c])
            chance.append(of_class[c] * within / within.sum())
        chance = np.concatenate(chance)
        assert chance.sum() == pytest.approx(1, abs=1e-5)
        total += np.log(chance[target])
    return total


def test_scores_are_sums_of_conditional_log_probabilities(spark, monkeypatch):
    rng = np.random.default_rng(3)
    model = lm.shaped(rng.normal(size=len(lm.flat(lm.initial()))) * 0.3)
    monkeypatch.setattr(lm, "train", lambda *_: model)
    monkeypatch.setattr(lm, "CHUNK", 7)
    frame = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").limit(12)
    docs = [(r.doc_id, r.text) for r in frame.collect()]
    known = lm.Ids(lm.frequent_words(frame.selectExpr("text AS _text")))
    got = {r.doc_id: r for r in lm.score(frame).collect()}
    split = lambda t: __import__("re").findall(r"[^\x20\x09-\x0D]+", t)
    for doc_id, text in docs:
        ids = [known.of(w) for w in split(text)]
        assert got[doc_id].n_words == len(ids)
        assert got[doc_id].log_likelihood == pytest.approx(naive(model, ids), rel=1e-4)
        assert got[doc_id].mean_log_probability == pytest.approx(got[doc_id].log_likelihood / len(ids))


def test_gradients_are_those_of_the_loss():
    rng = np.random.default_rng(0)
    p = {k: v.astype(np.float64) for k, v in lm.initial().items()}
    context, targets = rng.integers(0, lm.VOCABULARY + 1, (50, 4)), rng.integers(0, lm.VOCABULARY, 50)
    g = lm.gradients(p, context, targets)
    loss = lambda: -lm.log_probabilities(p, context, targets).mean()
    for name in lm.SHAPES:
        at = np.unravel_index(np.abs(g[name]).argmax(), g[name].shape)
        before = p[name][at]
        p[name][at] = before + 1e-5
        more = loss()
        p[name][at] = before - 1e-5
        less = loss()
        p[name][at] = before
        assert g[name][at] == pytest.approx((more - less) / 2e-5, rel=1e-3), name


def test_laid_out():
    known = lm.Ids(["a", "b"])
    ids, starts = known.laid_out(pa.array(["a b", "", " \n", " b\ta ", "a"]))
    edge = [lm.EDGE] * 2
    assert ids.tolist() == [*edge, 0, 1, *edge, *edge, *edge, 1, 0, *edge, 0, *edge]
    assert starts.tolist() == [2, 6, 8, 10, 14, 17]
    assert lm.FREQUENT <= known.of("zzz") < lm.VOCABULARY


def test_text_in_order_scores_above_the_same_words_shuffled(spark):
    """Trained on sentences of a small grammar, the network knows which word belongs where."""
    rng = random.Random(0)
    parts = [["the", "a", "this"], ["dog", "cat", "bird", "man"], ["sees", "likes", "hears"], ["the", "a"], ["tree", "road"]]
    make = lambda: " ".join(" ".join(rng.choice(p) for p in parts) for _ in range(20))
    docs = [(k, make()) for k in range(400)]
    for k in range(0, 100, 2):
        own = docs[k][1].split()
        rng.shuffle(own)
        docs.append((1000 + k, " ".join(own)))
    frame = spark.createDataFrame([(i, t, "x", "x", 1, *FILLER) for i, t in docs], SCHEMA)
    got = {r.doc_id: r.mean_log_probability for r in lm.score(frame.repartition(2)).collect()}
    assert np.mean([got[k] > got[1000 + k] for k in range(0, 100, 2)]) > 0.95


def test_odd_rows(spark, odd, empty):
    rows = lm.score(odd).collect()
    key = lambda r: (str(r[0]), r[1])
    assert sorted(((r.doc_id, r.n_words) for r in rows), key=key) == sorted(
        ((i, len(words(t))) for i, t, *_ in ODD), key=key
    )
    for r in rows:
        assert (r.log_likelihood < 0) == (r.n_words > 0)
        assert (r.mean_log_probability is None) == (r.n_words == 0)
    assert lm.score(empty).collect() == []


def test_all_documents_are_counted(spark):
    docs = rows_of(spark, SF, "text")
    counted = {}
    for (text,) in docs:
        for w in __import__("re").findall(r"[^\x20\x09-\x0D]+", text or ""):
            counted[w] = counted.get(w, 0) + 1
    wanted = sorted(counted, key=lambda w: (-counted[w], w.encode()))[: lm.FREQUENT]
    assert lm.frequent_words(spark.read.parquet(f"{SF}/documents.parquet").selectExpr("text AS _text")) == wanted


def test_each_rare_word_has_its_own_probability(spark, monkeypatch):
    """Words beyond the network's vocabulary: the bucket's probability times the share from all counts."""
    monkeypatch.setattr(lm, "train", lambda *_: lm.initial())
    common = " ".join(f"c{k} c{k}" for k in range(lm.FREQUENT)) + " c0"
    by_bucket = {}
    for k in range(2000):
        by_bucket.setdefault(lm.Ids([]).of(f"r{k}"), []).append(f"r{k}")
    one, two = next(found[:2] for found in by_bucket.values() if len(found) > 1)
    once, often = "zz1", "zz2"
    docs = [(1, common), (2, f"c0 {one} c0"), (3, f"c0 {two} c0"), (None, f"c0 {two} c0")]
    # ``one`` and ``two`` must not get into the vocabulary by their counts: each common word occurs more often.
    docs = [(i, f"{t} {t} {t}" if i == 1 else t) for i, t in docs] + [(4, once), (5, f"{often} {often}"), (5, "")]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = sorted((tuple(r) for r in lm.score(frame).collect()), key=repr)
    assert len(got) == len(docs)
    counted = {one: 1, two: 2, once: 1, often: 2}
    sizes = {}
    for w, n in counted.items():
        sizes[lm.Ids([]).of(w)] = sizes.get(lm.Ids([]).of(w), 0) + n
    known = lm.Ids(lm.frequent_words(frame.selectExpr("text AS _text")))
    of = {i: t for i, t in docs if t}
    for doc_id, n_words, log_likelihood, _ in got:
        text = of[doc_id] if n_words else ""
        if doc_id == 1:
            continue
        wanted = naive(lm.initial(), [known.of(w) for w in text.split()]) if text else 0
        wanted += sum(np.log(counted[w] / sizes[known.of(w)]) for w in text.split() if w in counted)
        assert log_likelihood == pytest.approx(wanted, rel=1e-4), doc_id
    by_id = {r[0]: r[2] for r in got if r[1]}
    assert by_id[3] - by_id[2] == pytest.approx(np.log(2), rel=1e-3)
    assert by_id[None] == pytest.approx(by_id[3])


def test_every_position_is_learned_from_once(spark, monkeypatch):
    """Over the rounds, whatever a text's length and however rows fall into slices."""
    texts = ["a", "a b", "", "a b c d e f g h " * 9, " a\tb c ", "b"]
    frame = spark.createDataFrame([(t,) for t in texts], "_text string").coalesce(1)
    known = ["a", "b", "c", "d", "e", "f", "g", "h"]
    wanted = sorted(known.index(w) for t in texts for w in t.split())
    for rounds in (1, 2, 3):
        places = []
        for turn in range(rounds):
            ids, starts = lm.Ids(known).laid_out(pa.array(texts))
            at = np.flatnonzero((ids != lm.EDGE) & lm.masked(starts, len(ids), turn, rounds))
            alone = []
            for t in texts:
                own, begin = lm.Ids(known).laid_out(pa.array([t]))
                alone += own[(own != lm.EDGE) & lm.masked(begin, len(own), turn, rounds)].tolist()
            assert ids[at].tolist() == alone
            places += at.tolist()
        assert len(set(places)) == len(places) and sorted(ids[places].tolist()) == wanted


def test_words_at_skipped_places_are_learned(spark):
    """In a list of eight words a line, words that never stood at the first two places were no targets."""
    line = " ".join(f"k{k}" for k in range(8))
    frame = spark.createDataFrame([(" ".join([line] * 200),)] * 8, "_text string").coalesce(1)
    words = lm.frequent_words(frame)
    model = lm.train(frame, spark.sparkContext.broadcast(words))
    ids, _ = lm.Ids(words).laid_out(pa.array([" ".join([line] * 20)]))
    at = np.flatnonzero(ids != lm.EDGE)
    found = lm.log_probabilities(model, lm._context(ids, at), ids[at])
    by_word = [found[ids[at] == k].mean() for k in range(8)]
    assert min(by_word) > np.log(0.05)


def test_texts_are_split_once(spark, monkeypatch):
    """The rounds and the scores read ids, from which each text's places come back whatever a batch begins with."""
    texts = ["a", "", "b a zz\t", None, " \n", "zz " * 40]
    seen = []
    monkeypatch.setattr(lm, "train", lambda rows, *_: seen.append(rows) or lm.initial())
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    assert {r.doc_id: r.n_words for r in lm.score(frame).collect()} == {k: len(words(t)) for k, t in enumerate(texts)}
    (rows,) = seen
    assert "_text" not in rows.columns and "_ids" in rows.columns

    ids, starts = lm.Ids(["a", "b"]).laid_out(pa.array([t or "" for t in texts]))
    stored = lm.packed(ids, starts)
    for first in range(len(texts) + 1):
        own, begin = lm.unpacked(stored[first:])
        assert own.tolist() == [lm.EDGE] * 2 + ids[starts[first] :].tolist()
        assert (begin - 2).tolist() == (starts[first:] - starts[first]).tolist()


def test_steps_are_those_of_the_formula(monkeypatch):
    """Arrays that steps share keep nothing of the step before, also where classes don't occur in one."""
    monkeypatch.setattr(lm, "BATCH", 50)
    rng = np.random.default_rng(1)
    context, targets = rng.integers(0, lm.VOCABULARY + 1, (170, 4)), rng.integers(0, lm.VOCABULARY, 170)
    targets[50:100] //= 8
    learner, p = lm.Learner(lm.initial()), lm.initial()
    learner.learn(context, targets)
    seen = {name: np.full(shape, 1e-6, np.float32) for name, shape in lm.SHAPES.items()}
    for start in range(0, 170, 50):
        for name, g in lm.gradients(p, context[start : start + 50], targets[start : start + 50]).items():
            seen[name] += g * g
            p[name] = p[name] - lm.RATE * g / np.sqrt(seen[name])
    assert lm.flat(learner.p) == pytest.approx(lm.flat(p), abs=1e-5)


@pytest.mark.parametrize("scale", [1, 100])
def test_large_logits(scale):
    """Parameters whose exponentials would be too large."""
    rng = np.random.default_rng(3)
    p = lm.shaped(rng.normal(size=len(lm.flat(lm.initial()))) * 0.3)
    p["word"], p["class"] = p["word"] * scale, p["class"] * scale
    ids = rng.integers(0, lm.VOCABULARY, 30)
    at = np.arange(2, 32)
    laid_out = np.concatenate([[lm.EDGE] * 2, ids, [lm.EDGE] * 2])
    found = lm.log_probabilities(p, lm._context(laid_out, at), ids).sum()
    assert found == pytest.approx(naive(p, ids.tolist()), rel=1e-4)
