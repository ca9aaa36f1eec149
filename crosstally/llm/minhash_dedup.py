"""Near-duplicate documents by MinHash: many universal hash minima, banding, verification, components.

Documents with the same set of shingles are one *node* from the start, so that copies cost nothing
further, however many there are. Nodes whose signatures agree in all rows of a band share a bucket.

In a bucket, not all pairs are looked at. One node is compared with the others first; nodes that turn
out to be linked are one component, and only nodes of different components are compared further. A node
that was compared with all others of a bucket leaves it. This goes on until no bucket holds nodes of
different components that were not compared, so that no link is lost, and a group of near copies costs
about as many comparisons as it has members.

Pairs have to pass three tests: a bound on their differences that no similar pair fails, taken from
sketches where nodes meet in a bucket, then agreement of their signatures, then that of their full sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crosstally.llm.common import kept, release, text_of, tidy
from crosstally.llm.components import connected_components

#: At a similarity of 0.8 a pair shares no bucket with probability (1 - 0.8 ** ROWS) ** BANDS = 1.3e-7.
BANDS, ROWS = 40, 5
HASHES = BANDS * ROWS
#: A pair whose signatures agree less is not checked further. At a similarity of 0.8 this is more than
#: six standard deviations below what is expected.
LEAST_AGREEMENT = 0.62
#: 64-bit words of a sketch.
WORDS = 16
#: Nodes that others of a bucket are compared with in one turn, after the first two.
PIVOTS = 4096
#: Documents fetched by a broadcast of their ids (16 bytes each); more are fetched by a shuffled join.
FETCHED = 1_000_000

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_numbers = np.random.Generator(np.random.PCG64(20240229))
_A = _numbers.integers(0, 1 << 32, HASHES, dtype=np.uint32) | np.uint32(1)
_B = _numbers.integers(0, 1 << 32, HASHES, dtype=np.uint32)
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93))


def words_of(text: str) -> list[bytes]:
    """Words as UTF-8, with A-Z in lower case."""
    return text.encode().translate(_LOWER).split()


def shingles(text: str, width: int) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct runs of ``width`` words, or of all words if they are fewer."""
    words = words_of(text)
    if not words:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    width = min(width, len(words))
    found = np.full(len(words) - width + 1, np.uint64(width))
    for k in range(width):
        found = (found ^ hashes[k : len(words) - width + 1 + k]) * _MIX[0]
        found ^= found >> np.uint64(29)
        found *= _MIX[1]
    return np.unique(found)


def signature(found: np.ndarray) -> np.ndarray:
    """16 bits of the minimum of each hash function over a set."""
    values = (found >> np.uint64(32)).astype(np.uint32)
    least = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for start in range(0, len(values), 512):
        hashed = _A[:, None] * values[None, start : start + 512]
        hashed += _B[:, None]
        np.minimum(least, hashed.min(axis=1), out=least)
    return ((least * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype("<u2")


def sketch(found: np.ndarray) -> np.ndarray:
    """For each of a number of bits, whether an odd number of shingles falls on it, in 64-bit words."""
    odd = np.bincount((found & np.uint64(64 * WORDS - 1)).astype(np.int64), minlength=64 * WORDS) & 1
    return np.packbits(odd.astype(np.uint8)).view("<i8")


SKETCH = ", ".join(f"s{k}:bigint" for k in range(WORDS))
SIGNED = (
    "doc_id {kind}, _key long, n_shingles long, digest binary, signature binary, sketch struct<" + SKETCH + ">"
)


def _not_too_far(percent: int) -> F.Column:
    """Whether two nodes (``n_shingles`` and ``sketch``, ``_n`` and ``_sketch``) may be similar enough.

    Each shingle that only one of them has changes one bit of the sketch, so at least as many shingles
    differ as bits do. No similar pair fails this, however the shingles fall.
    """
    bits = [F.bit_count(F.col(f"sketch.s{k}").bitwiseXOR(F.col(f"_sketch.s{k}"))) for k in range(WORDS)]
    return (100 + percent) * sum(bits[1:], bits[0]) <= (100 - percent) * (F.col("n_shingles") + F.col("_n"))


def signed(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, n_shingles, digest of the set and signature of each row; the latter two NULL without words."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            sizes, digests, signatures = [], [], []
            sketches = np.zeros((rows.num_rows, WORDS), np.int64)
            for k, text in enumerate(rows["_text"]):
                found = shingles(text.as_py(), width)
                sketches[k] = sketch(found)
                sizes.append(len(found))
                digests.append(xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None)
                signatures.append(signature(found).tobytes() if len(found) else None)
            yield pa.RecordBatch.from_arrays(
                [
                    rows["doc_id"],
                    rows["_key"],
                    pa.array(sizes, pa.int64()),
                    pa.array(digests, pa.binary()),
                    pa.array(signatures, pa.binary()),
                    pa.StructArray.from_arrays(
                        [pa.array(np.ascontiguousarray(sketches[:, k])) for k in range(WORDS)],
                        [f"s{k}" for k in range(WORDS)],
                    ),
                ],
                ["doc_id", "_key", "n_shingles", "digest", "signature", "sketch"],
            )

    return docs.mapInArrow(tidy(sign), SIGNED.format(kind=docs.schema["doc_id"].dataType.simpleString()))


def in_buckets(nodes: DataFrame) -> DataFrame:
    """key and node of each bucket with more than one node."""
    size = 2 * ROWS
    keys = F.transform(
        F.sequence(F.lit(0), F.lit(BANDS - 1)),
        lambda band: F.xxhash64(band, F.substring("signature", band * size + 1, F.lit(size))),
    )
    members = nodes.select("node", F.explode(keys).alias("key"))
    shared = members.groupBy(F.col("key").alias("_key")).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    return members.join(shared, F.col("key").eqNullSafe(F.col("_key"))).select("key", "node")


def _alike(pairs: DataFrame, of_nodes: DataFrame, column: str, test) -> DataFrame:
    """The pairs (a, b) for which ``test`` holds of the two nodes' ``column``."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            held = [test(x.as_buffer(), y.as_buffer()) for x, y in zip(rows["_x"], rows["_y"], strict=True)]
            yield rows.select(["a", "b"]).filter(pa.array(held, pa.bool_()))

    x = of_nodes.select(F.col("node").alias("a"), F.col(column).alias("_x"))
    y = of_nodes.select(F.col("node").alias("b"), F.col(column).alias("_y"))
    return pairs.join(y, "b").join(x, "a").select("a", "b", "_x", "_y").mapInArrow(tidy(keep), "a long, b long")


def _signatures_agree(x: pa.Buffer, y: pa.Buffer) -> bool:
    same = np.count_nonzero(np.frombuffer(x, "<u2") == np.frombuffer(y, "<u2"))
    return same >= LEAST_AGREEMENT * HASHES


def _sets_agree(percent: int):
    def agree(x: pa.Buffer, y: pa.Buffer) -> bool:
        a, b = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
        if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
            return False
        both = len(np.intersect1d(a, b, assume_unique=True))
        return 100 * both >= percent * (len(a) + len(b) - both)

    return agree


def sets_of(docs: DataFrame, nodes: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """node and its set (64-bit hashes) for the nodes in ``wanted``, from the text of one of their documents."""
    places = nodes.join(wanted, "node").select("node", "digest", F.col("least").alias("_least"))
    places = kept(places, "set-places")
    near = F.broadcast(places) if places.count() <= FETCHED else places
    texts = docs.join(near, F.col("doc_id").eqNullSafe(F.col("_least"))).select("node", "digest", "_text")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            out = {"node": [], "members": []}
            for node, digest, text in zip(rows["node"], rows["digest"], rows["_text"], strict=True):
                found = shingles(text.as_py(), width).tobytes()
                if xxhash.xxh3_128_digest(found) == digest.as_py():  # else another row with this id
                    out["node"].append(node.as_py())
                    out["members"].append(found)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out["node"], pa.int64()), pa.array(out["members"], pa.binary())], ["node", "members"]
            )

    # Rows that repeat an id and its text would give a node twice.
    return texts.mapInArrow(tidy(extract), "node long, members binary").groupBy("node").agg(
        F.any_value("members").alias("members")
    )


def _mixed(members: DataFrame, labels: DataFrame) -> DataFrame:
    """The buckets that hold nodes of several components, with each node's and the largest one's label."""
    known = members.join(labels, "node", "left").select(
        "key", "node", F.coalesce("component", "node").alias("component")
    )
    sizes = known.groupBy("key", "component").agg(F.count(F.lit(1)).alias("n"))
    mixed = (
        sizes.groupBy(F.col("key").alias("_key"))
        .agg(F.count(F.lit(1)).alias("_components"), F.max(F.struct("n", -F.col("component"))).alias("_largest"))
        .where("_components > 1")
        .select("_key", (-F.col("_largest.col2")).alias("_largest"))
    )
    return kept(known.join(mixed, F.col("key").eqNullSafe(F.col("_key"))).drop("_key"), "mixed-buckets")


def _to_compare(known: DataFrame, nodes: DataFrame, turn: int, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Pairs to look at in this turn, what is left of the buckets, and the nodes that others are compared with."""
    # First the least node, then some of the largest component, then those outside it.
    chosen = [F.lit(True), F.col("component") == F.col("_largest"), F.col("component") != F.col("_largest")][min(turn, 2)]
    groups = [1, 4, PIVOTS][min(turn, 2)]
    pivots = (
        known.where(chosen)
        .groupBy(F.col("key").alias("_key"), F.pmod(F.xxhash64("node"), F.lit(groups)).alias("_group"))
        .agg(F.min(F.struct("node", "component")).alias("_pivot"))
        .select("_key", F.col("_pivot.node").alias("_node"), F.col("_pivot.component").alias("_component"))
    )
    pivots = kept(pivots, "pivots")
    sketches = nodes.select("node", "n_shingles", "sketch")
    theirs = sketches.select(F.col("node").alias("_node"), F.col("n_shingles").alias("_n"), F.col("sketch").alias("_sketch"))
    may_be_linked = (
        F.col("key").eqNullSafe(F.col("_key")) & (F.col("component") != F.col("_component")) & _not_too_far(percent)
    )
    pairs = (
        known.join(sketches, "node")
        .join(pivots.join(theirs, "_node"), may_be_linked)
        .select(F.least("node", "_node").alias("a"), F.greatest("node", "_node").alias("b"))
        .distinct()
    )
    done = (F.col("key") == F.col("_key")) & (F.col("node") == F.col("_node"))
    return pairs, kept(known.join(pivots, done, "left_anti").select("key", "node"), "left-to-compare"), pivots


def near_duplicates(
    docs: DataFrame,
    *,
    width: int = 5,
    percent: int = 80,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of each row of ``docs``.

    Two documents are linked if their sets of shingles (runs of ``width`` words, or all words if they
    are fewer) have at least ``percent`` percent of their union in common. ``component_id`` is the
    smallest id that is reached over links, the row's own included; ``kept`` says that it is its own.

    NULL, empty and blank texts have no shingles and are linked with nothing. Rows that repeat an id are
    rows like any other; equal ones are copies. A NULL id is no id to be reached: its row gets that of
    another document of its component, or NULL if there is none. Further columns are not looked at. An
    empty table gives an empty result.
    """
    texts = docs.select(
        F.col(id_column).alias("doc_id"), text_of(text_column).alias("_text"), F.lit(0).cast("long").alias("_key")
    )
    return _resolved(texts, width, percent)[0].drop("_key")


def _resolved(texts: DataFrame, width: int, percent: int) -> tuple[DataFrame, list[DataFrame]]:
    """:func:`near_duplicates` of the columns doc_id and _text, with the column _key carried along.

    With it come the kept tables that it is read from. All others are removed as soon as they are used up.
    """
    signed_rows = kept(signed(texts, width), "signed")
    nodes = kept(
        signed_rows.where("n_shingles > 0")
        .groupBy("digest")
        .agg(
            F.min("doc_id").alias("least"),
            F.any_value("n_shingles").alias("n_shingles"),
            F.any_value("signature").alias("signature"),
            F.any_value("sketch").alias("sketch"),
        )
        .withColumn("node", F.monotonically_increasing_id()),
        "nodes",
    )
    rows = kept(signed_rows.drop("signature", "sketch"), "rows")
    release(signed_rows)
    labels = _labels(texts, nodes, width, percent)

    # The least id of each component, and with it that of each node.
    of_nodes = kept(
        nodes.join(labels, "node", "left").select("digest", "least", F.coalesce("component", "node").alias("component")),
        "components",
    )
    release(nodes, labels)
    least = of_nodes.groupBy(F.col("component").alias("_component")).agg(F.min("least").alias("component_id"))
    reached = of_nodes.join(least, F.col("component").eqNullSafe(F.col("_component"))).select(
        F.col("digest").alias("_digest"), "component_id"
    )
    component = F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    resolved = (
        # Rows without a set look for something that isn't there, each elsewhere.
        rows.withColumn("_look", F.coalesce("digest", F.encode(F.concat(F.lit("-"), F.col("doc_id")), "utf-8")))
        .join(reached, F.col("_look").eqNullSafe(F.col("_digest")), "left")
        .select("doc_id", "_key", "n_shingles", component.alias("component_id"))
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )
    return resolved, [rows, of_nodes]


def _labels(texts: DataFrame, nodes: DataFrame, width: int, percent: int) -> DataFrame:
    """node and component of the nodes that are linked with others."""
    members = kept(in_buckets(nodes), "buckets")
    signatures = nodes.select("node", "signature")
    labels = nodes.select("node", F.col("node").alias("component")).limit(0)
    compared, sets, turn, linked = None, None, 0, False
    all_sets: list[DataFrame] = []
    while not members.isEmpty():
        known = _mixed(members, labels)
        release(members)
        pairs, members, pivots = _to_compare(known, nodes, turn, percent)
        turn += 1
        if compared is not None:
            pairs = pairs.join(compared, ["a", "b"], "left_anti")
        pairs = kept(pairs, "pairs")
        release(known, pivots)
        if pairs.isEmpty():
            release(pairs)
            continue
        before, compared = compared, pairs if compared is None else kept(compared.unionByName(pairs), "compared")
        release(before)
        alike = kept(_alike(pairs, signatures, "signature", _signatures_agree), "alike")
        if pairs is not compared:
            release(pairs)
        if alike.isEmpty():
            release(alike)
            continue
        wanted = alike.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        if sets is not None:
            wanted = wanted.join(sets.select("node"), "node", "left_anti")
        wanted = kept(wanted, "wanted")
        if not wanted.isEmpty():
            more = kept(sets_of(texts, nodes, wanted, width), "sets")
            sets, all_sets = more if sets is None else sets.unionByName(more), [*all_sets, more]
        found = kept(_alike(alike, sets, "members", _sets_agree(percent)), "links")
        release(alike, wanted)
        if found.isEmpty():
            release(found)
            continue
        # What is known of the components stands for the links that they were made of.
        known_links = labels.select(F.col("node").alias("a"), F.col("component").alias("b"))
        old, labels = labels, connected_components(found.unionByName(known_links) if linked else found)
        linked = True
        release(old, found)
    release(members, compared, *all_sets)
    return labels


def deduplicated(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` of which one stays of each group of near duplicates: the one with the least id.

    Documents without shingles all stay. Rows are told apart by id and text; of several rows with the
    least id one stays.
    """
    row = F.struct("*").alias("_row")
    keyed = docs.select(row, F.col(id_column).alias("doc_id"), F.xxhash64(text_of(text_column)).alias("_key"))
    texts = docs.select(
        F.col(id_column).alias("doc_id"),
        text_of(text_column).alias("_text"),
        F.xxhash64(text_of(text_column)).alias("_key"),
    )
    resolved, read = _resolved(texts, options.get("width", 5), options.get("percent", 80))
    found = kept(resolved, "near-duplicates")
    release(*read)
    first = found.where(F.col("kept") & (F.col("n_shingles") > 0)).groupBy("component_id").agg(
        F.count(F.lit(1)).alias("n"), F.min("_key").alias("_first")
    )
    repeated = kept(first.where("n > 1"), "repeated-ids")
    gone = found.where(~F.col("kept")).select("doc_id", "_key").distinct()
    if not repeated.isEmpty():
        others = found.where("kept").join(repeated, "component_id").where(F.col("_key") != F.col("_first"))
        gone = gone.unionByName(others.select("doc_id", "_key")).distinct()
    gone = kept(gone.select(F.col("doc_id").alias("_id"), F.col("_key").alias("_gone")), "duplicates")
    near = F.broadcast(gone) if gone.count() <= FETCHED else gone
    is_gone = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_key") == F.col("_gone"))
    stays = keyed.join(near, is_gone, "left_anti")
    if not repeated.isEmpty():
        twice = repeated.select(F.col("_first").alias("_gone"), F.col("component_id").alias("_id")).distinct()
        alone = stays.join(twice, is_gone, "left_anti")
        stays = alone.unionByName(stays.join(twice, is_gone, "left_semi").dropDuplicates(["doc_id", "_key"]))
    return stays.select("_row.*")
