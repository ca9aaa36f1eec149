"""Token ids as binary files: frequency-ranked ids, byte-aligned variable-length coding.

Ids are replaced by their rank of frequency over the whole corpus, so that the common ones fit in one
byte. A rank takes one to four bytes. The number of bytes of each is kept apart from them, as two bits
in a run of *control* bytes, so that decoding is a table lookup on the control bytes and a few array
operations on the data bytes, without a branch per id.

One Parquet row holds one document::

    shard, doc_id, start_in_shard, n_tokens, control, data

Shards are ranges of ``doc_id``; within one, rows ascend by ``doc_id``. The rank table (one row for
each id of the vocabulary) lies beside them.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.normalizers import Sequence
from tokenizers.pre_tokenizers import ByteLevel

from crosstally.llm.common import kept, text_of, tidy, tokenizer

#: Parts of pieces that a worker remembers (some 30 bytes each), and bytes of text it looks at in one go. Results
#: depend on neither.
REMEMBERED = 400_000
SLICE = 4_000_000
#: Ids in a shard on average, where that makes more shards than the session's shuffle partitions.
IDS_PER_SHARD = 64_000_000

#: Letters of Latin-1, and the marks behind them that neither an elision nor a special string begins with.
WORD = "^[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+$"
LETTERS = f"^(?P<letters>{WORD[1:-1]})(?P<marks>[.,;:!?$&%*#()-]*)$"

#: Number of bytes of each of the four ids that a control byte stands for.
LENGTHS = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3).astype(np.uint8) + 1


# -- coding -------------------------------------------------------------------------------------


def encode_many(ranks: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Code runs of ``ranks`` of the given ``sizes``, which follow each other.

    Returns all control bytes and where those of each run begin and the last end, then the same of the
    data bytes. A run's last control byte is filled up with zeros.
    """
    ranks = ranks.astype("<u4", copy=False)
    extra = (ranks > 0xFF).astype(np.uint8)
    extra += ranks > 0xFFFF
    extra += ranks > 0xFFFFFF
    control_at, place = _places(sizes)
    codes = np.zeros(4 * control_at[-1], np.uint8)
    codes[place] = extra
    quads = codes.reshape(-1, 4)
    control = quads[:, 0] | quads[:, 1] << 2 | quads[:, 2] << 4 | quads[:, 3] << 6
    data = ranks.view(np.uint8).reshape(-1, 4)[np.arange(4, dtype=np.uint8) <= extra[:, None]]
    upto = np.concatenate([[0], np.cumsum(extra, dtype=np.int64) + np.arange(1, len(extra) + 1)])
    return control, control_at, data, upto[np.concatenate([[0], np.cumsum(sizes)])]


def decode_many(control: np.ndarray, data: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The ranks that :func:`encode_many` made these bytes of."""
    _, place = _places(sizes)
    lengths = LENGTHS[control].reshape(-1)[place]
    starts = np.cumsum(lengths, dtype=np.int64) - lengths
    ranks = data[starts].astype("<u4")
    for k in (1, 2, 3):
        longer = np.flatnonzero(lengths > k)
        if not len(longer):
            break
        ranks[longer] |= data[starts[longer] + k].astype("<u4") << np.uint32(8 * k)
    return ranks


def _places(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the control bytes of each run begin, and the place of each rank's two bits in all of them."""
    control_at = np.concatenate([[0], np.cumsum(-(-sizes // 4))])
    first = np.repeat(4 * control_at[:-1] - (np.cumsum(sizes) - sizes), sizes)
    return control_at, first + np.arange(len(first))


def encode_ranks(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of one run of ranks."""
    control, _, data, _ = encode_many(ranks, np.array([len(ranks)]))
    return control.tobytes(), data.tobytes()


def decode_ranks(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ``n`` ranks that :func:`encode_ranks` made these bytes of."""
    return decode_many(np.frombuffer(control, np.uint8), np.frombuffer(data, np.uint8), np.array([n]))


def _flat(column: pa.Array, kind: np.dtype | type = np.uint8) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a binary column as one array of ``kind``, and the size of each row's in it."""
    kind = np.dtype(kind)
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    whole = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data and len(column) else np.zeros(0, np.uint8)
    return whole.view(kind), np.diff(offsets).astype(np.int64) // kind.itemsize


def _binary(values: np.ndarray, at: np.ndarray) -> pa.Array:
    """A binary column of ``values``, whose rows begin at ``at``."""
    offsets = pa.array((at * values.itemsize).astype(np.int64)).buffers()[1]
    data = pa.py_buffer(np.ascontiguousarray(values))
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at) - 1, [None, offsets, data]).cast(pa.binary())


# -- ids of texts -------------------------------------------------------------------------------


class PieceIds:
    """Ids of the pieces between blanks and line ends, as little-endian integers of ``kind``.

    The word tokenizer drops white space before it looks at anything else, so that ids of a text are
    those of its pieces, one after the other; special strings hold no white space.

    A piece of Latin letters, with marks or none behind them, needs no normalisation but lower case, and is
    cut before the marks. Its letters go to the library as a word that is cut already, without the
    tokenizer's patterns, which take most of the time otherwise. All other pieces, and marks, go to it as
    they are. The library is given each of these parts once. Parts and ids are remembered in arrays, the
    most used of them when they get many.
    """

    def __init__(self, path: str):
        self.tokenizer = tokenizer(path)
        self.words = Tokenizer.from_file(path)
        self.words.normalizer = Sequence([])
        self.words.pre_tokenizer = ByteLevel(add_prefix_space=False, use_regex=False)
        self.kind = id_kind(path)
        self.parts = pa.array([], pa.string())
        self.ids = pa.LargeListArray.from_arrays(pa.array([0]), pa.array([], pa.from_numpy_dtype(self.kind)))
        self.used = np.zeros(0, np.float32)

    def texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and where each text's begin and the last ends."""
        split = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        pieces = np.concatenate([[0], np.cumsum(pc.list_value_length(split).to_numpy(zero_copy_only=False))])
        coded = split.flatten().dictionary_encode()
        del split
        own = self._of_pieces(coded.dictionary)
        sizes = np.diff(own.offsets.to_numpy()).astype(np.int32)[coded.indices.to_numpy(zero_copy_only=False)]
        upto = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])[pieces]
        return own.take(coded.indices).flatten().to_numpy(), upto

    def _of_pieces(self, pieces: pa.Array) -> pa.Array:
        """The ids of each of ``pieces``: those of its letters or of all of it, then those of the marks cut off."""
        cut = pc.extract_regex(pieces, LETTERS)
        found = cut.is_valid()
        heads = pc.if_else(found, pc.utf8_lower(pc.struct_field(cut, "letters")), pieces)
        tails = pc.if_else(found, pc.struct_field(cut, "marks"), "")
        parts = pa.concat_arrays([heads, tails]).dictionary_encode()
        place = self._places(parts.dictionary)[parts.indices.to_numpy(zero_copy_only=False)]
        own = self.ids.take(pa.array(place.reshape(2, -1).T.ravel()))
        return pa.LargeListArray.from_arrays(own.offsets[::2], own.flatten())

    def _places(self, parts: pa.Array) -> np.ndarray:
        """Where the ids of each of ``parts``, which differ, are found in ``self.ids``."""
        if len(self.parts) > REMEMBERED:
            self.forget(REMEMBERED // 2)
        place = pc.index_in(parts, self.parts)
        missing = parts.filter(place.is_null())
        is_word = pc.match_substring_regex(missing, WORD)
        new = [missing.filter(is_word), missing.filter(pc.invert(is_word))]
        place = place.fill_null(-1).to_numpy().astype(np.int64)
        order = np.argsort(~is_word.to_numpy(zero_copy_only=False), kind="stable")
        place[np.flatnonzero(place < 0)[order]] = len(self.parts) + np.arange(len(missing))
        self.ids = pa.concat_arrays([self.ids, *self._of_words(new[0]), *self._of_others(new[1])])
        self.parts = pa.concat_arrays([self.parts, *new])
        self.used = np.concatenate([self.used, np.zeros(len(missing), np.float32)])
        self.used[place] += 1
        return place

    def forget(self, stay: int) -> None:
        """Remember no more than the ``stay`` most used parts."""
        if len(self.parts) > stay:
            most = pa.array(np.argsort(-self.used, kind="stable")[:stay])
            self.parts, self.ids, self.used = self.parts.take(most), self.ids.take(most), self.used[most] / 2

    def _of_words(self, words: pa.Array) -> Iterator[pa.Array]:
        for start in range(0, len(words), 20_000):
            part = words[start : start + 20_000].to_pylist()
            found = self.words.encode(part, is_pretokenized=True, add_special_tokens=False)
            yield self._lists(np.array(found.ids, self.kind), np.bincount(np.array(found.word_ids), minlength=len(part)))

    def _of_others(self, pieces: pa.Array) -> Iterator[pa.Array]:
        for start in range(0, len(pieces), 20_000):
            part = pieces[start : start + 20_000].to_pylist()
            found = [whole.ids for whole in self.tokenizer.encode_batch_fast(part, add_special_tokens=False)]
            yield self._lists(np.fromiter(chain.from_iterable(found), self.kind), np.array(list(map(len, found))))

    def _lists(self, ids: np.ndarray, sizes: np.ndarray) -> pa.Array:
        ends = np.concatenate([[0], np.cumsum(sizes)])
        return pa.LargeListArray.from_arrays(pa.array(ends), pa.array(ids))


_piece_ids: dict[str, PieceIds] = {}


@cache
def id_kind(path: str) -> np.dtype:
    """The narrowest type that holds every id of the vocabulary."""
    return np.dtype("<u2" if tokenizer(path).get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4")


def token_ids(texts: DataFrame, path: str) -> DataFrame:
    """doc_id and the ids of the column ``_text``, as bytes of the vocabulary's :func:`id_kind`."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _piece_ids.get(path) or _piece_ids.setdefault(path, PieceIds(path))
        for rows in batches:
            # A few megabytes at a time, so that the pieces of very long texts don't pile up.
            ends = np.cumsum(pc.binary_length(rows["_text"]).to_numpy(zero_copy_only=False))
            cuts = [0, *(np.flatnonzero(np.diff(ends // SLICE)) + 1), rows.num_rows]
            for start, stop in zip(cuts, cuts[1:], strict=False):
                if start == stop:
                    continue
                ids, at = known.texts(rows["_text"].slice(start, stop - start))
                yield pa.RecordBatch.from_arrays(
                    [rows["doc_id"].slice(start, stop - start), _binary(ids, at)], ["doc_id", "ids"]
                )

    return texts.select("doc_id", "_text").mapInArrow(tidy(encode), "doc_id long, ids binary")


def id_counts(ids: DataFrame, kind: np.dtype, end_id: int) -> DataFrame:
    """How often each id occurs in what :func:`token_ids` gives, end ids included: id, n."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(end_id + 1, np.int64)
        for rows in batches:
            total[end_id] += rows.num_rows
            more = np.bincount(_flat(rows["ids"], kind)[0])
            total = np.pad(total, (0, max(0, len(more) - len(total))))
            total[: len(more)] += more
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["id", "n"])

    counted = ids.select("ids").mapInArrow(tidy(count), "id long, n long")
    return counted.groupBy("id").agg(F.sum("n").alias("n"))


def ranked_ids(counts: list[tuple[int, int]], size: int) -> np.ndarray:
    """All ids below ``size``, the most frequent first, ties and unused ones by id."""
    n = np.zeros(size, np.int64)
    for k, times in counts:
        n[k] = times
    return np.lexsort((np.arange(size), -n)).astype("<u4")


# -- files --------------------------------------------------------------------------------------

FILE = "shard int, doc_id long, start_in_shard long, n_tokens long, control binary, data binary"
CODED = "shard int, doc_id long, n_tokens long, control binary, data binary"


def write_tokens(
    docs: DataFrame,
    path: str,
    *,
    end_id: int = 1,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> tuple[DataFrame, np.ndarray]:
    """Encode whole texts with the tokenizer at ``path`` and write them in ascending ``doc_id`` order.

    Returns the files' rows, as read from the shared folder, and the ids by rank.

    NULL and empty texts hold the end id alone. Rows without an id come first; repeated ids are each
    kept, in the order of their number of tokens and bytes. Further columns are not looked at. An
    empty table gives empty files.

    The library reads each text once; the ids are written down, counted, and then coded by rank. What is
    brought to the driver is a count for each id of the vocabulary. Only the coded bytes are shuffled.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), text_of(text_column).alias("_text"))
    kind = id_kind(path)
    ids = kept(token_ids(texts, path), "token-ids")
    counts = [(row.id, row.n) for row in id_counts(ids, kind, end_id).collect()]
    size = max(tokenizer(path).get_vocab_size(with_added_tokens=True), end_id + 1)
    by_rank = ranked_ids(counts, size)
    rank_of = np.empty(size, "<u4")
    rank_of[by_rank] = np.arange(size, dtype="<u4")
    shared = spark.sparkContext.broadcast(rank_of)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = shared.value
        for rows in batches:
            ids, sizes = _flat(rows["ids"], kind)
            ids = np.insert(ids, np.cumsum(sizes), kind.type(end_id))
            sizes += 1
            control, control_at, data, data_at = encode_many(ranks[ids], sizes)
            at = rows["doc_id"]
            shard = np.searchsorted(bounds, at.fill_null(0).to_numpy()).astype(np.int32)
            shard[at.is_null().to_numpy(zero_copy_only=False)] = 0
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(shard),
                    at,
                    pa.array(sizes, pa.int64()),
                    _binary(control, control_at),
                    _binary(data, data_at),
                ],
                ["shard", "doc_id", "n_tokens", "control", "data"],
            )

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, at = TaskContext.get().partitionId(), 0
        for rows in batches:
            n = rows["n_tokens"].to_numpy()
            ends = at + np.cumsum(n)
            columns = {name: rows[name] for name in ("doc_id", "n_tokens", "control", "data")}
            columns["shard"] = pa.array(np.full(len(n), shard, np.int32))
            columns["start_in_shard"] = pa.array(ends - n)
            at = int(ends[-1]) if len(ends) else at
            names = ["shard", "doc_id", "start_in_shard", "n_tokens", "control", "data"]
            yield pa.RecordBatch.from_arrays([columns[name] for name in names], names)

    total = sum(n for _, n in counts)
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), total // IDS_PER_SHARD)
    bounds = np.array(_bounds(ids, shards), np.int64)
    coded = ids.mapInArrow(tidy(code), CODED)
    in_order = coded.repartitionById(shards, F.col("shard")).sortWithinPartitions(
        "doc_id", "n_tokens", "control", "data"
    )
    return kept(in_order.mapInArrow(tidy(placed), FILE), "tokens"), by_rank


def _bounds(ids: DataFrame, shards: int) -> list[int]:
    """Last ids of all shards but the last, from a sketch of the id column alone.

    They decide where files are cut, not what is in them.
    """
    cuts = [k / shards for k in range(1, shards)]
    if not cuts:
        return []
    (row,) = ids.select(F.percentile_approx("doc_id", cuts, 10 * shards).alias("at")).collect()
    return sorted(set(row.at or []))


def read_tokens(files: DataFrame, by_rank: np.ndarray) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of each document, from the bytes in the files.

    ``start`` is the number of ids of all documents before it, ``ids_crc32`` the checksum of its ids
    as little-endian 32-bit integers. ``ids`` themselves are what :func:`decoded` gives.
    """
    per_shard = files.groupBy("shard").agg(F.sum("n_tokens").alias("_n"))
    before = W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1)  # one row for each shard
    bases = per_shard.select(
        F.col("shard").alias("_shard"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base")
    )
    shared = files.sparkSession.sparkContext.broadcast(by_rank)

    def checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            sums = [zlib.crc32(ids) for ids in _decoded_rows(rows, shared.value)]
            yield pa.RecordBatch.from_arrays(
                [rows["shard"], rows["doc_id"], rows["start_in_shard"], rows["n_tokens"], pa.array(sums, pa.int64())],
                ["shard", "doc_id", "start_in_shard", "n_tokens", "ids_crc32"],
            )

    schema = "shard int, doc_id long, start_in_shard long, n_tokens long, ids_crc32 long"
    rows = files.mapInArrow(tidy(checked), schema)
    return rows.join(bases, F.col("shard") == F.col("_shard")).select(
        "doc_id", (F.col("_base") + F.col("start_in_shard")).alias("start"), "n_tokens", "ids_crc32"
    )


def _decoded_rows(rows: pa.RecordBatch, by_rank: np.ndarray) -> list[np.ndarray]:
    """The ids of each document, as little-endian 32-bit integers."""
    sizes = rows["n_tokens"].to_numpy()
    if not len(sizes):
        return []
    ids = by_rank[decode_many(_flat(rows["control"])[0], _flat(rows["data"])[0], sizes)]
    return np.split(ids, np.cumsum(sizes)[:-1])


def decoded(files: DataFrame, by_rank: np.ndarray) -> DataFrame:
    """doc_id and the list of its ids."""
    shared = files.sparkSession.sparkContext.broadcast(by_rank)

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            ids = [ids.astype(np.int32) for ids in _decoded_rows(rows, shared.value)]
            yield pa.RecordBatch.from_arrays(
                [rows["doc_id"], pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"]
            )

    return files.mapInArrow(tidy(listed), "doc_id long, ids array<int>")


def token_output(spark: SparkSession, docs: DataFrame, path: str) -> DataFrame:
    """Write the token files of ``docs`` and return what they hold, read back."""
    files, by_rank = write_tokens(docs, path)
    return read_tokens(files, by_rank)
