"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Texts are folded to lower-case letters with everything else as a blank; n-grams of one to three
characters are hashed to a fixed number of features. Document frequencies are counted over all labelled
texts. The regression is trained by follow-the-regularised-leader with an L1 and an L2 penalty on a
sample of them that is bounded for each language, and its scores are calibrated by a temperature on
another part of the sample. Rare languages are a larger part of the sample than of the labelled texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crosstally.llm.common import text_of, tidy

FEATURE_BITS = 16
FEATURES = 1 << FEATURE_BITS
#: Labelled documents, about, that the regression and the temperature are fitted on.
SAMPLE = 4000
#: Of a language with fewer in a sample of that size, so many documents, about, or all that there are.
LEAST = 50
#: One in so many of a language's sample is left to the temperature.
CALIBRATE = 5
UNDETERMINED = "und"

#: Odd multipliers of the hash, one for each place of an n-gram.
_FACTORS = tuple(np.uint32(x) for x in (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D))
_SALTS = tuple(np.uint32(x) for x in (0x27D4EB2F, 0x165667B1, 0x2545F491))


@cache
def _folding() -> np.ndarray:
    """For each code point its lower-case form, or a blank where it is no letter."""
    table = np.full(0x110000, 32, np.uint32)
    for point in range(0x110000):
        char = chr(point)
        if char.isalpha():
            lower = char.lower()
            table[point] = ord(lower) if len(lower) == 1 else point
    return table


def features(text: str) -> tuple[np.ndarray, np.ndarray] | None:
    """The features of a text and how often each occurs; None if it has no letter."""
    points = _folding()[np.frombuffer(text.encode("utf-32-le"), "<u4")]
    if not (points != 32).any():
        return None
    points = np.concatenate([[np.uint32(32)], points, [np.uint32(32)]])
    hashed = []
    for n in (1, 2, 3):
        h = np.full(len(points) - n + 1, _SALTS[n - 1], np.uint32)
        for k in range(n):
            h += points[k : len(points) - n + 1 + k] * _FACTORS[k]
        h ^= h >> np.uint32(15)
        h *= _FACTORS[1]
        hashed.append(h >> np.uint32(32 - FEATURE_BITS))
    times = np.bincount(np.concatenate(hashed), minlength=FEATURES)
    at = np.flatnonzero(times)
    return at, times[at]


def weighted(at: np.ndarray, times: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """TF-IDF values of length one."""
    values = (1 + np.log(times)) * idf[at]
    return values / np.sqrt((values**2).sum())


@dataclass
class Model:
    """What predictions need. ``rows`` are the features with a weight other than zero."""

    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0

    def logits(self, at: np.ndarray, values: np.ndarray) -> np.ndarray:
        return values @ self.weights[at] + self.bias

    def predict(self, text: str | None) -> tuple[str, float]:
        found = features(text) if text and self.languages else None
        if found is None:
            return UNDETERMINED, 0.0
        at, times = found
        logits = self.logits(at, weighted(at, times, self.idf)) / self.temperature
        p = np.exp(logits - logits.max())
        k = int(p.argmax())
        return self.languages[k], float(p[k] / p.sum())


class Ftrl:
    """Follow the regularised leader for a softmax, with a step size for each weight."""

    def __init__(self, classes: int, alpha: float = 1.0, beta: float = 1.0, l1: float = 0.02, l2: float = 0.01):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z = np.zeros((FEATURES + 1, classes))  # the last row is the bias
        self.n = np.zeros((FEATURES + 1, classes))

    def weights(self, at: np.ndarray | slice) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - self.l1, 0)
        return -shrunk / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)

    def learn(self, at: np.ndarray, values: np.ndarray, label: int) -> None:
        at, values = np.append(at, FEATURES), np.append(values, 1.0)
        w = self.weights(at)
        logits = values @ w
        p = np.exp(logits - logits.max())
        p /= p.sum()
        p[label] -= 1
        g = values[:, None] * p
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[at] = n + g * g


def calibrated(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature of least negative log-likelihood, by narrowing in on it.

    A label counts as right with probability (n + 1) / (n + 2), n being the number of labels. Without
    that doubt, a sample on which the model makes no mistake would have no best temperature.
    """
    if not len(labels) or logits.shape[1] < 2:
        return 1.0
    sure = (len(labels) + 1) / (len(labels) + 2)
    wanted = np.full(logits.shape, (1 - sure) / (logits.shape[1] - 1))
    wanted[np.arange(len(labels)), labels] = sure

    def loss(log_t: float) -> float:
        x = logits / np.exp(log_t)
        x = x - x.max(axis=1, keepdims=True)
        return float((wanted * (np.log(np.exp(x).sum(axis=1, keepdims=True)) - x)).sum(axis=1).mean())

    low, high = np.log(0.05), np.log(20)
    for _ in range(50):
        a, b = low + (high - low) / 3, high - (high - low) / 3
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def document_frequencies(texts: DataFrame) -> DataFrame:
    """In how many texts each feature occurs (column ``_text``): feature, n; feature -1 counts them."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, texts = np.zeros(FEATURES, np.int64), 0
        for rows in batches:
            texts += rows.num_rows
            for text in rows["_text"]:
                found = features(text.as_py())
                if found:
                    n[found[0]] += 1
        seen = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(seen, -1)), pa.array(np.append(n[seen], texts))], ["feature", "n"]
        )

    counted = texts.select("_text").mapInArrow(tidy(count), "feature long, n long")
    return counted.groupBy("feature").agg(F.sum("n").alias("n"))


def language_sizes(labelled: DataFrame) -> dict[str, int]:
    """How many labelled texts with a letter each language has."""
    counted = _with_letter(labelled).groupBy("_lang").agg(F.count(F.lit(1)).alias("n"))
    return {row["_lang"]: row.n for row in counted.collect()}  # one row a language


def _with_letter(labelled: DataFrame) -> DataFrame:
    return labelled.where(F.col("_text").rlike(r"\p{L}"))


def _sample(labelled: DataFrame, sizes: dict[str, int], size: int) -> list:
    """Language and features of labelled texts, chosen by a hash of id and text.

    Of each language about its part of ``size``, but not less than ``LEAST``: all where it has no more.
    """
    if not sizes:
        return []
    spaces, total = 1 << 40, sum(sizes.values())
    wanted = {lang: max(-(-size * n // total), LEAST) for lang, n in sizes.items()}
    shares = [x for lang, n in sizes.items() for x in (lang, min(spaces, -(-wanted[lang] * spaces // n)))]
    share = F.try_element_at(F.create_map(*map(F.lit, shares)), F.col("_lang"))
    chosen = _with_letter(labelled).where(F.pmod(F.xxhash64("_id", "_text"), F.lit(spaces)) < share)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            out = {"order": [], "lang": [], "at": [], "times": []}
            for text, lang, order in zip(rows["_text"], rows["_lang"], rows["_order"], strict=True):
                found = features(text.as_py())
                if found:
                    out["order"].append(order.as_py())
                    out["lang"].append(lang.as_py())
                    out["at"].append(found[0].astype("<u2").tobytes())
                    out["times"].append(found[1].astype("<u4").tobytes())
            types = {"order": pa.int64(), "lang": pa.string(), "at": pa.binary(), "times": pa.binary()}
            yield pa.RecordBatch.from_arrays([pa.array(out[c], t) for c, t in types.items()], list(types))

    rows = chosen.select("_text", "_lang", F.xxhash64("_text", "_id", F.lit(1)).alias("_order"))
    found = rows.mapInArrow(tidy(extract), "order long, lang string, at binary, times binary").collect()
    return sorted(found, key=lambda row: (row.order, row.lang, row["at"]))


def train(labelled: DataFrame, *, sample: int = SAMPLE, epochs: int = 3) -> Model:
    """A model from the columns ``_id``, ``_text`` and ``_lang`` (none of the latter two NULL)."""
    n = {row.feature: row.n for row in document_frequencies(labelled).collect()}  # one row a feature
    total = n.pop(-1, 0)
    idf = np.full(FEATURES, np.log(1 + total) + 1)
    idf[list(n)] = np.log((1 + total) / (1 + np.array(list(n.values()), float))) + 1

    sizes = language_sizes(labelled)
    rows = _sample(labelled, sizes, sample)
    languages = sorted({row.lang for row in rows})
    label = {lang: k for k, lang in enumerate(languages)}
    learned, rest, seen = [], [], [0] * len(languages)
    for row in rows:
        at = np.frombuffer(row["at"], "<u2").astype(np.int64)
        values = weighted(at, np.frombuffer(row.times, "<u4"), idf).astype(np.float32)
        k = label[row.lang]
        seen[k] += 1
        (learned if seen[k] % CALIBRATE else rest).append((at, values, k))

    ftrl = Ftrl(len(languages))
    for _ in range(epochs):
        for at, values, k in learned:
            ftrl.learn(at, values, k)
    w = ftrl.weights(slice(None))
    model = Model(languages, idf, w[:-1], w[-1])
    if rest:
        logits = np.array([model.logits(at, values) for at, values, _ in rest])
        model.temperature = calibrated(logits, np.array([k for _, _, k in rest]))
    return model


def predict(docs: DataFrame, model: Model, *, text_column: str = "text", row: str = "_row") -> DataFrame:
    """The column ``row`` with lang_pred, score and whether there is a letter, of each text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            texts = rows["_text"].to_pylist()
            found = [shared.value.predict(text) for text in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    rows["_row"],
                    pa.array([lang for lang, _ in found], pa.string()),
                    pa.array([p for _, p in found], pa.float64()),
                    pa.array([any(map(str.isalpha, text or "")) for text in texts], pa.bool_()),
                ],
                ["_row", "lang_pred", "score", "has_letter"],
            )

    texts = docs.select(F.col(row).alias("_row"), F.col(text_column).alias("_text"))
    kind = texts.schema["_row"].dataType.simpleString()
    return texts.mapInArrow(tidy(score), f"_row {kind}, lang_pred string, score double, has_letter boolean")


def held_out(id_column: str = "doc_id") -> F.Column:
    """Whether a document is kept from training: CRC-32 of its id as text is divisible by 5."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string")) % 5 == 0, F.lit(False))


def fitted(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang") -> Model:
    """A model of the labelled documents that are not held out."""
    labelled = docs.where(~held_out(id_column) & F.col(id_column).isNotNull() & F.col(lang_column).isNotNull())
    return train(
        labelled.select(
            F.col(id_column).alias("_id"), text_of(text_column).alias("_text"), F.col(lang_column).alias("_lang")
        )
    )


def identify(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang") -> DataFrame:
    """doc_id, held_out, lang_pred and score of each row of ``docs``.

    Learns from text and language of rows that are not held out and have an id and a language. NULL
    texts, empty ones and those without a letter are ``und`` with score 0; so is every text where
    nothing could be learned. Texts are taken whole. Repeated rows get a row each. Further columns are
    not looked at.
    """
    model = fitted(docs, id_column=id_column, text_column=text_column, lang_column=lang_column)
    row = F.struct(F.col(id_column).alias("doc_id"), held_out(id_column).alias("held_out"))
    found = predict(docs.select(row.alias("_row"), F.col(text_column).alias("_text")), model, text_column="_text")
    return found.select("_row.doc_id", "_row.held_out", "lang_pred", "score")
