"""Language-model scores by masked pseudo-likelihood.

A small network sees the two words before and the two words behind a position and predicts the word at
it. The score of a document is the sum, over all its positions, of the log-probability that the network
gives the word that is there: each word is predicted from both sides.

The network's vocabulary is the most frequent words of all documents; other words share a fixed number of
buckets. A word's probability is that of its class times that within its class, so that one position
costs two small softmaxes. For a word in a bucket it is times the word's share of the bucket's occurrences
in all documents, from a table of the counts of all words; so each word has a probability of its own, and all
of them sum to one.

The network is trained on all positions of all documents, each in one of the rounds: each task starts from
the shared parameters, learns from its documents, and the results are averaged by the number of positions
learned from. The average is a sum over Spark rows; what is broadcast has a fixed size.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from crosstally.llm.common import WORDS, kept, text_of, tidy

CLASSES, CLASS_SIZE = 64, 128
VOCABULARY = CLASSES * CLASS_SIZE
#: Ids from here on are buckets for words that are not among the most frequent.
BUCKETS = 256
FREQUENT = VOCABULARY - BUCKETS
#: What stands before the first and behind the last word.
EDGE = VOCABULARY
OFFSETS = (-2, -1, 1, 2)
EMBEDDING, HIDDEN = 8, 16
#: A round masks, and learns from, one in so many positions of each text; each round masks others.
ROUNDS = 2
BATCH, RATE = 2048, 0.1
#: Bytes of text or of ids that are looked at in one go, and positions that are scored in one go.
SLICE, ID_SLICE, CHUNK = 4_000_000, 1_200_000, 1 << 15
#: e to the power of this and of its negative is far within what single precision holds.
SAFE = 60

SHAPES = {
    "embedding": (VOCABULARY + 1, EMBEDDING),
    "hidden": (len(OFFSETS) * EMBEDDING, HIDDEN),
    "hidden_bias": (HIDDEN,),
    "class": (HIDDEN, CLASSES),
    "class_bias": (CLASSES,),
    "word": (CLASSES, HIDDEN, CLASS_SIZE),
    "word_bias": (CLASSES, CLASS_SIZE),
}
Parameters = dict[str, np.ndarray]


# -- network ------------------------------------------------------------------------------------


def initial() -> Parameters:
    rng = np.random.Generator(np.random.PCG64(7))
    return {
        name: (rng.standard_normal(shape) * (0.0 if name.endswith("bias") else 0.2)).astype(np.float32)
        for name, shape in SHAPES.items()
    }


def flat(parameters: Parameters) -> np.ndarray:
    return np.concatenate([parameters[name].ravel() for name in SHAPES])


def shaped(values: np.ndarray) -> Parameters:
    out, at = {}, 0
    for name, shape in SHAPES.items():
        size = int(np.prod(shape))
        out[name] = values[at : at + size].reshape(shape).astype(np.float32)
        at += size
    return out


def _by_class(targets: np.ndarray) -> tuple[np.ndarray, list[tuple[int, slice]]]:
    """An order of ``targets`` by class, and where in it each class is that has any."""
    classes = (targets // CLASS_SIZE).astype(np.uint8)
    ends = np.cumsum(np.bincount(classes, minlength=CLASSES)).tolist()
    parts = [(k, slice(start, stop)) for k, (start, stop) in enumerate(zip([0, *ends], ends, strict=False)) if start < stop]
    return np.argsort(classes, kind="stable"), parts


def _inputs(p: Parameters, context: np.ndarray) -> np.ndarray:
    return p["embedding"].take(context.ravel(), axis=0).reshape(len(context), len(OFFSETS) * EMBEDDING)


def _joined(weights: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """Weights with the bias as a last row: what they give for a hidden layer with a column of ones."""
    return np.concatenate([weights, bias[..., None, :]], axis=-2)


def _hidden(p: Parameters, x: np.ndarray) -> np.ndarray:
    """The hidden layer with a last column of ones, products with which add biases, or sum up their gradients."""
    z = x @ p["hidden"]
    z += p["hidden_bias"]
    out = np.ones((len(x), HIDDEN + 1), z.dtype)
    np.tanh(z, out=out[:, :HIDDEN])
    return out


def _bounded(joined: np.ndarray) -> bool:
    """Whether no logit that these give for a hidden layer, of values from -1 to 1, is too large for an exponential."""
    return bool(np.abs(joined).sum(axis=-2).max() < SAFE)


def _exponentials(logits: np.ndarray, bounded: bool) -> tuple[np.ndarray, np.ndarray]:
    """``logits`` becomes e to the power of them, less each row's greatest one unless they are bounded.

    Gives what was taken off, and the sums of rows.
    """
    top = np.zeros(len(logits), logits.dtype) if bounded else logits.max(axis=1)
    if not bounded:
        logits -= top[:, None]
    np.exp(logits, out=logits)
    return top, logits @ np.ones(logits.shape[1], logits.dtype)


def _log_chances(logits: np.ndarray, chosen: np.ndarray, bounded: bool) -> np.ndarray:
    """Log-probability of one column of each row; ``logits`` is used up."""
    own = logits[np.arange(len(logits)), chosen]
    top, total = _exponentials(logits, bounded)
    return own - top - np.log(total)


def _errors(logits: np.ndarray, chosen: np.ndarray, bounded: bool) -> np.ndarray:
    """The gradient of the mean negative log-probability by ``logits``, in their place."""
    _, total = _exponentials(logits, bounded)
    total *= len(logits)
    logits /= total[:, None]
    logits[np.arange(len(logits)), chosen] -= 1 / len(logits)
    return logits


def log_probabilities(p: Parameters, context: np.ndarray, targets: np.ndarray) -> np.ndarray:
    """Log-probability of each target, given the ids around it (a row of ``context``)."""
    order, parts = _by_class(targets)
    targets = targets[order]
    h = _hidden(p, _inputs(p, context[order]))
    joined = _joined(p["class"], p["class_bias"])
    sums = _log_chances(h @ joined, targets // CLASS_SIZE, _bounded(joined))
    joined = _joined(p["word"], p["word_bias"])
    bounded = _bounded(joined)
    for k, rows in parts:
        sums[rows] += _log_chances(h[rows] @ joined[k], targets[rows] % CLASS_SIZE, bounded)
    found = np.empty_like(sums)
    found[order] = sums
    return found


class Room:
    """The large arrays of a step, which steps share, and the words' parameters joined with their biases."""

    def __init__(self, p: Parameters):
        self.joined = _joined(p["word"], p["word_bias"])
        self.g_joined = np.zeros_like(self.joined)
        self.g_embedding = np.empty_like(p["embedding"])
        self.of_rows: dict[int, np.ndarray] = {}

    def of(self, n: int, columns: int) -> np.ndarray:
        if columns not in self.of_rows or len(self.of_rows[columns]) < n:
            self.of_rows[columns] = np.empty((n, columns), self.joined.dtype)
        return self.of_rows[columns][:n]


def gradients(p: Parameters, context: np.ndarray, targets: np.ndarray, room: Room | None = None) -> Parameters:
    """Of the mean negative log-probability. Rows are put in order of class, so that a class is a slice.

    Some of the arrays are those of ``room``, which the next step fills again.
    """
    room = room or Room(p)
    order, parts = _by_class(targets)
    context, targets = context[order], targets[order]
    x = _inputs(p, context)
    h = _hidden(p, x)
    g = {"word": room.g_joined[:, :HIDDEN], "word_bias": room.g_joined[:, HIDDEN], "embedding": room.g_embedding}

    joined = _joined(p["class"], p["class_bias"])
    d = _errors(h @ joined, targets // CLASS_SIZE, _bounded(joined))
    both = h.T @ d
    g["class"], g["class_bias"] = both[:HIDDEN], both[HIDDEN]
    dh = d @ joined.T
    d, of_words = room.of(len(targets), CLASS_SIZE), room.of(len(targets), HIDDEN + 1)
    for k, rows in parts:
        np.matmul(h[rows], room.joined[k], out=d[rows])
    _errors(d, targets % CLASS_SIZE, _bounded(room.joined))
    if len(parts) < CLASSES:
        room.g_joined[:] = 0
    for k, rows in parts:
        np.matmul(h[rows].T, d[rows], out=room.g_joined[k])
        np.matmul(d[rows], room.joined[k].T, out=of_words[rows])
    dh += of_words
    dz = dh[:, :HIDDEN] * (1 - h[:, :HIDDEN] ** 2)
    g["hidden"], g["hidden_bias"] = x.T @ dz, dz.sum(axis=0)
    dx = (dz @ p["hidden"].T).reshape(-1, EMBEDDING)
    at = context.ravel()
    for k in range(EMBEDDING):
        room.g_embedding[:, k] = np.bincount(at, weights=dx[:, k], minlength=VOCABULARY + 1)
    return g


class Learner:
    """Gradient steps whose size shrinks with what a parameter has moved (AdaGrad)."""

    def __init__(self, parameters: Parameters):
        self.p = {name: value.copy() for name, value in parameters.items()}
        self.seen = {name: np.full(shape, 1e-6, np.float32) for name, shape in SHAPES.items()}
        self.room = Room(self.p)
        # A step changes the joined ones by these.
        self.p["word"], self.p["word_bias"] = self.room.joined[:, :HIDDEN], self.room.joined[:, HIDDEN]
        self.free = {name: np.empty(shape, np.float32) for name, shape in SHAPES.items()}
        self.positions = 0

    def learn(self, context: np.ndarray, targets: np.ndarray) -> None:
        for start in range(0, len(targets), BATCH):
            part = slice(start, start + BATCH)
            for name, g in gradients(self.p, context[part], targets[part], self.room).items():
                free, seen = self.free[name], self.seen[name]
                np.multiply(g, g, out=free)
                seen += free
                np.sqrt(seen, out=free)
                g *= RATE
                g /= free
                self.p[name] -= g
        self.positions += len(targets)


# -- words --------------------------------------------------------------------------------------


def word_counts(texts: DataFrame) -> DataFrame:
    """How often each word occurs in the column ``_text``: word, n."""
    words = texts.select(F.explode(F.regexp_extract_all("_text", F.lit(WORDS), F.lit(0))).alias("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def _most_frequent(counts: DataFrame) -> list[Row]:
    return counts.orderBy(F.desc("n"), "word").limit(FREQUENT).collect()


def frequent_words(texts: DataFrame) -> list[str]:
    """The most frequent words of the column ``_text``, ties by code point."""
    return [row.word for row in _most_frequent(word_counts(texts))]


def _bucket(word: str) -> int:
    return zlib.crc32(word.encode()) % BUCKETS


def bucket_sizes(counts: DataFrame, frequent: list[Row]) -> np.ndarray:
    """How often the words of each bucket occur, those aside that are not in buckets."""
    sizes = np.zeros(BUCKETS, np.int64)
    buckets = counts.groupBy((F.crc32(F.encode("word", "utf-8")) % BUCKETS).alias("bucket"))
    for row in buckets.agg(F.sum("n").alias("n")).collect():  # a row a bucket
        sizes[row.bucket] = row.n
    for row in frequent:
        sizes[_bucket(row.word)] -= row.n
    return sizes


class Ids:
    """Ids of words: the place among the frequent ones, or a bucket."""

    def __init__(self, words: list[str]):
        self.known = {word: k for k, word in enumerate(words)}

    def of(self, word: str) -> int:
        found = self.known.get(word)
        return FREQUENT + _bucket(word) if found is None else found

    def laid_out(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, edges before and behind each, and where each text's words begin.

        There is one more beginning than texts; between two of them are the words and the edges behind.
        """
        return self._laid_out(texts, False)[:2]

    def with_rare(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
        """As ``laid_out``, and for each text its words that are in buckets, each with how often it occurs."""
        return self._laid_out(texts, True)

    def _laid_out(self, texts: pa.Array, rare_too: bool) -> tuple[np.ndarray, np.ndarray, pa.Array | None]:
        split = pc.ascii_split_whitespace(texts)
        coded = split.flatten().dictionary_encode()
        words = coded.dictionary.to_pylist()
        number = np.fromiter(map(self.of, words), np.int32, len(words))
        number[[k for k, word in enumerate(words) if not word]] = -1  # before or behind white space
        ids = number[coded.indices.to_numpy(zero_copy_only=False)]
        text = np.repeat(np.arange(len(texts)), pc.list_value_length(split).to_numpy(zero_copy_only=False))
        found = None
        if rare_too:
            codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            rare, times = np.unique((text * len(words) + codes)[ids >= FREQUENT], return_counts=True)
            of, rare = np.divmod(rare, max(len(words), 1))
            ends = np.searchsorted(of, np.arange(len(texts) + 1)).astype(np.int32)
            pairs = [coded.dictionary.take(pa.array(rare)), pa.array(times)]
            found = pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays(pairs, ["word", "times"]))
        text, ids = text[ids >= 0], ids[ids >= 0]
        sizes = np.bincount(text, minlength=len(texts))
        edges = len(OFFSETS) // 2
        starts = np.concatenate([[0], np.cumsum(sizes + edges)]) + edges
        out = np.full(starts[-1], EDGE, np.int32)
        within = np.arange(len(ids)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        out[starts[text] + within] = ids
        return out, starts, found


def masked(starts: np.ndarray, n: int, turn: int, rounds: int) -> np.ndarray:
    """Which of ``n`` places a round learns from, by their place in their text, whatever it is batched with."""
    within = np.arange(n) - np.repeat(np.concatenate([[0], starts]), np.diff(starts, prepend=0, append=n))
    return within % rounds == turn


def packed(ids: np.ndarray, starts: np.ndarray) -> pa.Array:
    """What ``laid_out`` gives as a binary for each text: its ids and the edges behind, two bytes each."""
    values, ends = ids[starts[0] :].astype("<i2"), ((starts - starts[0]) * 2).astype(np.int64)
    found = [None, pa.py_buffer(ends), pa.py_buffer(values)]
    return pa.Array.from_buffers(pa.large_binary(), len(starts) - 1, found).cast(pa.binary())


def unpacked(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The opposite of :func:`packed`."""
    texts = texts.cast(pa.large_binary())
    _, ends, values = texts.buffers()
    ends = np.frombuffer(ends, np.int64)[texts.offset : texts.offset + len(texts) + 1] // 2
    edges = len(OFFSETS) // 2
    own = np.frombuffer(values, "<i2", ends[-1])[ends[0] :]
    return np.concatenate([np.full(edges, EDGE, np.int32), own]), ends - ends[0] + edges


def _context(ids: np.ndarray, at: np.ndarray) -> np.ndarray:
    return ids[at[:, None] + np.array(OFFSETS)]


def _slices(rows: pa.RecordBatch, column: str = "_text", size: int = SLICE) -> Iterator[pa.RecordBatch]:
    ends = np.cumsum(pc.binary_length(rows[column]).to_numpy(zero_copy_only=False))
    cuts = sorted({0, *(np.flatnonzero(np.diff(ends // size)) + 1).tolist(), rows.num_rows})
    for start, stop in zip(cuts, cuts[1:], strict=False):
        yield rows.slice(start, stop - start)


# -- jobs ---------------------------------------------------------------------------------------


def encoded(texts: DataFrame, words: Broadcast) -> DataFrame:
    """``texts`` with ``_ids``, their :func:`packed` ids, and ``rare``, their words in buckets, for ``_text``."""
    others = [name for name in texts.columns if name != "_text"]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Ids(words.value)
        for rows in batches:
            for part in _slices(rows):
                ids, starts, rare = known.with_rare(part["_text"])
                columns = [*(part[name] for name in others), packed(ids, starts), rare]
                yield pa.RecordBatch.from_arrays(columns, [*others, "_ids", "rare"])

    kinds = [f"`{name}` {texts.schema[name].dataType.simpleString()}" for name in others]
    columns = ", ".join([*kinds, "_ids binary", "rare array<struct<word: string, times: long>>"])
    return texts.mapInArrow(tidy(encode), columns)


def train(texts: DataFrame, words: Broadcast, rounds: int = ROUNDS) -> Parameters:
    """Parameters learned from all rows, from each position once.

    The texts are in a column ``_text``, or in ``_ids`` as :func:`encoded` gives them.
    """
    spark = texts.sparkSession
    texts = texts if "_ids" in texts.columns else encoded(texts, words)
    parameters = initial()
    for turn in range(rounds):
        shared = spark.sparkContext.broadcast(parameters)

        def learn(batches: Iterator[pa.RecordBatch], turn=turn, shared=shared) -> Iterator[pa.RecordBatch]:
            learner = Learner(shared.value)
            for rows in batches:
                for part in _slices(rows, "_ids", ID_SLICE):
                    ids, starts = unpacked(part["_ids"])
                    at = np.flatnonzero((ids != EDGE) & masked(starts, len(ids), turn, rounds))
                    learner.learn(_context(ids, at), ids[at])
            if learner.positions:
                values = flat(learner.p).astype(np.float64) * learner.positions
                values = np.append(values, learner.positions)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(len(values), dtype=np.int32)), pa.array(values)], ["place", "value"]
                )

        learned = texts.select("_ids").mapInArrow(tidy(learn), "place int, value double")
        rows = learned.groupBy("place").agg(F.sum("value").alias("value")).collect()  # a row a parameter
        if not rows:
            continue  # where every text is shorter than this turn's places
        total = np.zeros(len(rows))
        for row in rows:
            total[row.place] = row.value
        parameters = shaped(total[:-1] / total[-1])
    return parameters


def score(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """doc_id, n_words, log_likelihood and mean_log_probability of each row of ``docs``.

    The log-likelihood is the sum over all words of a whole text; a text without words (NULL, empty or
    blank) has 0 and the mean NULL. Equal texts have equal scores to within rounding; repeated rows get
    a row each. Further columns are not looked at. An empty table gives an empty result.
    """
    texts = docs.select(F.col(id_column).alias("doc_id"), text_of(text_column).alias("_text"))
    counts = kept(word_counts(texts), "word-counts")
    frequent = _most_frequent(counts)
    words = docs.sparkSession.sparkContext.broadcast([row.word for row in frequent])
    # A number for each row, which stays once it is written: ids may be NULL or repeated.
    ids = kept(encoded(texts, words).withColumn("_row", F.monotonically_increasing_id()), "word-ids")
    model = docs.sparkSession.sparkContext.broadcast(train(ids, words, rounds))
    # A word that is known has no bucket to share.
    log_sizes = np.zeros(VOCABULARY)
    log_sizes[FREQUENT:] = np.log(np.maximum(bucket_sizes(counts, frequent), 1))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for part in _slices(rows, "_ids", ID_SLICE):
                ids, starts = unpacked(part["_ids"])
                at = np.flatnonzero(ids != EDGE)
                upto = np.zeros(len(at) + 1)
                for start in range(0, len(at), CHUNK):
                    own = at[start : start + CHUNK]
                    found = log_probabilities(model.value, _context(ids, own), ids[own]) - log_sizes[ids[own]]
                    upto[1 + start : 1 + start + len(own)] = found
                np.cumsum(upto, out=upto)
                bounds = np.searchsorted(at, starts)
                yield pa.RecordBatch.from_arrays(
                    [part["_row"], part["doc_id"], pa.array(np.diff(bounds)), pa.array(np.diff(upto[bounds]))],
                    ["_row", "doc_id", "n_words", "of_ids"],
                )

    kind = texts.schema["doc_id"].dataType.simpleString()
    columns = f"_row long, doc_id {kind}, n_words long, of_ids double"
    found = kept(ids.select("_row", "doc_id", "_ids").mapInArrow(tidy(scored), columns), "scores")
    # A word that occurs once adds the logarithm of 1, which is nothing.
    pairs = ids.select("_row", F.inline("rare")).join(counts.where("n > 1"), "word")
    shares = pairs.groupBy("_row").agg(F.sum(F.col("times") * F.ln("n")).alias("_shares"))
    log_likelihood = F.col("of_ids") + F.coalesce("_shares", F.lit(0.0))
    mean = F.col("log_likelihood") / F.nullif("n_words", F.lit(0).cast("long"))
    sums = found.join(shares, "_row", "left").select("doc_id", "n_words", log_likelihood.alias("log_likelihood"))
    return sums.withColumn("mean_log_probability", mean)
