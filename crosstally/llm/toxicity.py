"""Toxicity: a factorization machine over hashed terms.

Terms are the lower-case words of a text and their beginnings, hashed to a fixed number of features with
TF-IDF values of length one. Beside a weight for each feature the machine has a vector for each, and the
product of two features' vectors is the weight of their occurring together: two terms may be harmless
apart and not together, or the other way round, which no sum of weights expresses. The sum over all pairs
takes time in proportion to the features only.

Document frequencies are counted over all texts that aren't held out. The machine is trained on a sample of
labelled texts that is bounded for each label: weights by follow-the-regularised-leader, vectors by
AdaGrad. Its sums are turned into probabilities by a slope and a shift, fitted on another part of the
sample, whose labels are weighed by their shares of all labelled texts.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crosstally.llm.common import text_of, tidy

#: A power of two.
FEATURES = 1 << 17
#: Beginnings of words that are terms, in letters.
BEGINNINGS = (4, 5, 6, 7)
#: Words that a worker remembers the features of.
REMEMBERED = 1 << 18
#: Labelled texts, about, that are learned from.
SAMPLE = 6000
#: Of a label with fewer in a sample of that size, so many texts, about, or all that there are.
LEAST = 2000
#: One in so many of a label's sample is left to the probabilities.
CALIBRATE = 5
#: Numbers in a feature's vector.
FACTORS = 4
EPOCHS = 5

_WORD = re.compile(r"[^\W\d_]+")
_SPACE = 1 << 40


class _Terms(dict):
    """The features of words: the word, and its beginnings where they are shorter than it.

    Words are remembered, up to a number of them, as most of a text's words are those of other texts.
    """

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) >= REMEMBERED:
            self.clear()
        crc, last = zlib.crc32, FEATURES - 1
        whole, size = word.encode(), len(word)
        if len(whole) == size:
            found = (crc(whole) & last, *[crc(whole[:n], 1) & last for n in BEGINNINGS if n < size])
        else:
            found = (crc(whole) & last, *[crc(word[:n].encode(), 1) & last for n in BEGINNINGS if n < size])
        self[word] = found
        return found


_terms = _Terms()


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The features of a text, ascending, and how often each occurs."""
    words = Counter(_WORD.findall(text.lower()))
    terms = list(map(_terms.__getitem__, words))
    at = np.fromiter(chain.from_iterable(terms), np.int64)
    times = np.repeat(np.fromiter(words.values(), np.int64), np.fromiter(map(len, terms), np.int64))
    order = at.argsort(kind="stable")
    at = at[order]
    first = np.flatnonzero(np.diff(at, prepend=-1))
    return at[first], np.add.reduceat(times[order], first) if len(first) else times


def weighted(at: np.ndarray, times: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """TF-IDF values of length one."""
    values = (1 + np.log(times)) * idf[at]
    return values / np.sqrt((values**2).sum()) if len(values) else values


def together(values: np.ndarray, vectors: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """The sum of value times value times the vectors' product over all pairs; what it is made of."""
    own = values[:, None] * vectors
    total = own.sum(axis=0)
    return 0.5 * float((total**2).sum() - (own**2).sum()), own, total


class Machine:
    """The factorization machine while it learns: one example at a time, a step size for each number."""

    def __init__(self, alpha: float = 10.0, l1: float = 0.1, l2: float = 1e-4, step: float = 0.2, start: float = 0.1):
        self.alpha, self.l1, self.l2, self.step = alpha, l1, l2, step
        self.z, self.n = np.zeros(FEATURES), np.zeros(FEATURES)
        self.vectors = np.random.default_rng(0).normal(0, start, (FEATURES, FACTORS))
        self.squares = np.full((FEATURES, FACTORS), 1e-2)
        self.bias, self.bias_squares = 0.0, 1.0
        self.seen = np.zeros(FEATURES, bool)

    def weights(self, at: np.ndarray | slice) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - self.l1, 0)
        return -shrunk / ((1 + np.sqrt(n)) / self.alpha + self.l2)

    def learn(self, at: np.ndarray, values: np.ndarray, label: int) -> None:
        w, v, n = self.weights(at), self.vectors[at], self.n[at]
        pairs, own, total = together(values, v)
        error = _sigmoid(self.bias + float(values @ w) + pairs) - label
        g = error * values
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[at] = n + g * g
        gv = g[:, None] * (total - own) + self.l2 * v
        self.squares[at] += gv * gv
        self.vectors[at] = v - self.step * gv / np.sqrt(self.squares[at])
        self.bias_squares += error * error
        self.bias -= self.step * error / math.sqrt(self.bias_squares)
        self.seen[at] = True


def _sigmoid(x: float) -> float:
    return 1 / (1 + math.exp(-min(max(x, -40.0), 40.0)))


@dataclass
class Model:
    """What scores need; features that weren't learned from have no weight and an empty vector."""

    idf: np.ndarray
    weights: np.ndarray
    vectors: np.ndarray
    bias: float
    slope: float = 1.0
    shift: float = 0.0

    def sum_of(self, at: np.ndarray, values: np.ndarray) -> float:
        return self.bias + float(values @ self.weights[at]) + together(values, self.vectors[at])[0]

    def score(self, text: str | None) -> float:
        at, times = features(text or "")
        return _sigmoid(self.slope * self.sum_of(at, weighted(at, times, self.idf)) + self.shift)


def calibrated(sums: np.ndarray, labels: np.ndarray, shares: np.ndarray) -> tuple[float, float]:
    """Slope and shift of greatest likelihood, by Newton's method; each label is doubted a little.

    ``shares`` are the weights of the examples. A slope that would turn the order round is not taken.
    """
    if len(set(labels.tolist())) < 2:
        return 1.0, 0.0
    n = np.bincount(labels)
    wanted = np.where(labels == 1, (n[1] + 1) / (n[1] + 2), 1 / (n[0] + 2))
    x = np.stack([sums, np.ones(len(sums))], axis=1)

    def loss(at: np.ndarray) -> float:
        y = x @ at
        return float((shares * (np.logaddexp(0, y) - wanted * y)).sum() + 1e-3 * (at[0] - 1) ** 2)

    found = np.array([1.0, 0.0])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ found, -40, 40)))
        gradient = x.T @ (shares * (p - wanted)) + [2e-3 * (found[0] - 1), 0]
        curve = (x * (shares * p * (1 - p))[:, None]).T @ x + np.diag([2e-3, 1e-9])
        move, size = np.linalg.solve(curve, gradient), 1.0
        while loss(found - size * move) > loss(found) and size > 1e-6:
            size /= 2
        found = found - size * move
        if np.abs(size * move).max() < 1e-9:
            break
    return (float(found[0]), float(found[1])) if found[0] > 0 else (1.0, 0.0)


def held_out(id_column: str = "doc_id") -> Column:
    """Whether a document is kept from training: CRC-32 of its id as text is divisible by 5."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def document_frequencies(texts: DataFrame) -> DataFrame:
    """In how many texts (column ``_text``) each feature occurs: feature, n; feature -1 counts them."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = np.zeros(FEATURES, np.int64), 0
        for rows in batches:
            total += rows.num_rows
            for text in rows["_text"].to_pylist():
                n[features(text)[0]] += 1
        seen = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(seen, -1)), pa.array(np.append(n[seen], total))], ["feature", "n"]
        )

    counted = texts.select("_text").mapInArrow(tidy(count), "feature long, n long")
    return counted.groupBy("feature").agg(F.sum("n").alias("n"))


def label_sizes(texts: DataFrame, labels: DataFrame) -> dict[int, int]:
    """How many labelled texts each label has."""
    counted = texts.select("_id").join(labels, "_id").groupBy("_label").agg(F.count(F.lit(1)).alias("n"))
    return {row["_label"]: row.n for row in counted.collect()}  # two rows


def _sample(texts: DataFrame, labels: DataFrame, sizes: dict[int, int], sample: int) -> list:
    """Label and features of labelled texts, chosen by a hash of id and text; copies of a row count once.

    Of each label about its part of ``sample``, but not less than ``LEAST``: all where it has no more.
    """
    total = sum(sizes.values())
    wanted = {label: max(-(-sample * n // total), LEAST) for label, n in sizes.items()}
    share = {label: min(_SPACE, -(-wanted[label] * _SPACE // n)) for label, n in sizes.items()}
    number = F.pmod(F.xxhash64("_id", "_text"), F.lit(_SPACE))
    some = texts.withColumn("_number", number).where(F.col("_number") < max(share.values()))
    own = F.when(F.col("_label") == 1, share.get(1, 0)).otherwise(share.get(0, 0))
    chosen = some.join(labels, "_id").where(F.col("_number") < own)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            found = [features(text) for text in rows["_text"].to_pylist()]
            packed = [pa.array([x.astype("<u4").tobytes() for x in side], pa.binary()) for side in zip(*found, strict=True)]
            packed = packed or [pa.array([], pa.binary())] * 2
            yield pa.RecordBatch.from_arrays(
                [rows["_order"], rows["_label"], *packed], ["order", "label", "at", "times"]
            )

    order = F.xxhash64("_text", "_id", F.lit(1)).alias("_order")
    rows = chosen.select("_text", F.col("_label").cast("int").alias("_label"), order)
    found = rows.mapInArrow(tidy(extract), "order long, label int, at binary, times binary")
    return sorted(found.distinct().collect(), key=lambda row: (row.order, row.label))  # bounded by the sample


def train(texts: DataFrame, labels: DataFrame, *, sample: int = SAMPLE, epochs: int = EPOCHS) -> Model:
    """A model from ``texts`` (_id, _text, neither NULL) and ``labels`` (_id, _label 0 or 1).

    Without labelled texts of both labels there is nothing to tell apart: all texts then get a score near
    0, or near 1 where all labels are 1.
    """
    n = {row.feature: row.n for row in document_frequencies(texts).collect()}  # one row a feature
    total = n.pop(-1, 0)
    idf = np.full(FEATURES, math.log(1 + total) + 1)
    idf[list(n)] = np.log((1 + total) / (1 + np.array(list(n.values()), float))) + 1

    sizes = label_sizes(texts, labels)
    if len(sizes) < 2:
        none = np.zeros((FEATURES, FACTORS), np.float32)
        return Model(idf, none[:, 0], none, 40.0 if 1 in sizes else -40.0)
    learned, rest, seen = [], [], [0, 0]
    for row in _sample(texts, labels, sizes, sample):
        at = np.frombuffer(row["at"], "<u4").astype(np.int64)
        example = (at, weighted(at, np.frombuffer(row.times, "<u4"), idf), row.label)
        seen[row.label] += 1
        (learned if seen[row.label] % CALIBRATE else rest).append(example)

    machine, order = Machine(), np.random.default_rng(1)
    for _ in range(epochs):
        for k in order.permutation(len(learned)).tolist():
            machine.learn(*learned[k])
    vectors = np.where(machine.seen[:, None], machine.vectors, 0)
    model = Model(
        idf.astype(np.float32),
        machine.weights(slice(None)).astype(np.float32),
        vectors.astype(np.float32),
        machine.bias,
    )
    of_rest = np.array([label for _, _, label in rest], int)
    shares = np.array([sizes[k] / seen[k] for k in (0, 1)])
    weights = shares[of_rest] / shares[of_rest].mean() if rest else shares
    model.slope, model.shift = calibrated(
        np.array([model.sum_of(at, values) for at, values, _ in rest]), of_rest, weights
    )
    return model


def scored(docs: DataFrame, model: Model, *, text_column: str = "text", row: str = "_row") -> DataFrame:
    """The column ``row`` with the score of each text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            found = [shared.value.score(text) for text in rows["_text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([rows["_row"], pa.array(found, pa.float64())], ["_row", "score"])

    texts = docs.select(F.col(row).alias("_row"), F.col(text_column).alias("_text"))
    kind = texts.schema["_row"].dataType.simpleString()
    return texts.mapInArrow(tidy(score), f"_row {kind}, score double")


def toxicity(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "toxic",
    sample: int = SAMPLE,
) -> DataFrame:
    """doc_id, held_out, score and predicted of each row of ``docs``.

    Learns from texts that aren't held out and the labels, 0 or 1, that ``labels`` has for their ids; rows
    of NULL ids or labels are left out, several labels of an id are all learned from. A score is between 0
    and 1 and has the text as its only input. NULL and empty texts, and texts without a word, get the score
    of no terms at all. Texts are taken whole, repeated rows get a row each, further columns are not looked
    at; an empty table gives no rows.
    """
    seen = ~held_out(id_column) & F.col(id_column).isNotNull()
    texts = docs.where(seen).select(F.col(id_column).alias("_id"), text_of(text_column).alias("_text"))
    known = labels.where(seen & F.col(label_column).isin(0, 1)).select(
        F.col(id_column).alias("_id"), F.col(label_column).alias("_label")
    )
    model = train(texts, known, sample=sample)
    row = F.struct(F.col(id_column).alias("doc_id"), held_out(id_column).alias("held_out"))
    found = scored(docs.select(row.alias("_row"), F.col(text_column).alias("_text")), model, text_column="_text")
    return found.select(
        "_row.doc_id", "_row.held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
