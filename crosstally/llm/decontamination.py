"""Benchmark decontamination: one automaton over all windows of the test items, one scan of each text.

Texts are normalised to lower-cased words with a blank before and after each. Every window of a test
item is one string of an Aho-Corasick automaton, blanks included, so that it is found at word
boundaries only. Hits are ranges of words, mapped back to offsets in the text as it was.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crosstally.llm.common import text_of, tidy

#: Words are what lies between blanks once letters are in lower case and all ASCII characters but letters
#: and digits are blanks.
WORD = re.compile(rb"[^ ]+")
_TABLE = bytes(
    c + 32 if 65 <= c <= 90 else c if c > 127 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)
#: Bytes of item texts in one automaton. More items are taken in blocks, each in a scan of its own. An
#: automaton takes some 600 times the bytes of its items, since a window has a node for each character.
BLOCK_BYTES = 500_000
_serial = count()


def words_of(text: str) -> list[bytes]:
    """Lower-cased words of a text, as UTF-8."""
    return text.encode().translate(_TABLE).split()


def normalised(words: list[bytes]) -> str:
    """Words between blanks, a character for each byte."""
    return (b" " + b" ".join(words) + b" ").decode("latin-1")


class Windows:
    """The windows of a block of items and the automaton that finds them."""

    def __init__(self, items: list[tuple[object, str]], width: int):
        self.items = [item for item, _ in items]
        holders = defaultdict(set)
        for k, (_, text) in enumerate(items):
            words = words_of(text or "")
            for at in range(max(1, len(words) - width + 1) if words else 0):
                holders[tuple(words[at : at + width])].add(k)
        self.automaton = ahocorasick.Automaton()
        for window, ks in holders.items():
            key = normalised(list(window))
            self.automaton.add_word(key, (len(key), len(window), tuple(sorted(ks))))
        self.any = bool(holders)
        if self.any:
            self.automaton.make_automaton()

    def find(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[int]]:
        """Ranges of words that are hit, joined and in order, and the items whose windows occur."""
        found, ends = set(), []
        if not self.any or not words:
            return [], found
        text = normalised(words)
        for end, (length, width, ks) in self.automaton.iter(text):
            ends.append((end, width))
            found.update(ks)
        if not ends:
            return [], found
        blanks = np.flatnonzero(np.frombuffer(text.encode("latin-1"), np.uint8) == 32)
        last = np.searchsorted(blanks, [end for end, _ in ends])  # the number of words before it
        ranges: list[tuple[int, int]] = []
        for start, stop in sorted((int(b) - width, int(b)) for b, (_, width) in zip(last, ends, strict=True)):
            if ranges and start <= ranges[-1][1]:
                ranges[-1] = (ranges[-1][0], max(stop, ranges[-1][1]))
            else:
                ranges.append((start, stop))
        return ranges, found


def spans(text: str, ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Offsets in characters of ``text`` of ranges of its words."""
    raw = text.encode()
    at = [match.span() for match in WORD.finditer(raw.translate(_TABLE))]  # byte for byte
    return [(len(raw[: at[a][0]].decode()), len(raw[: at[b - 1][1]].decode())) for a, b in ranges]


_built: dict[tuple, Windows] = {}


def _windows(key: tuple, items: list, width: int) -> Windows:
    """Built once per worker process and block; only the last is kept."""
    if key not in _built:
        _built.clear()
        _built[key] = Windows(items, width)
    return _built[key]


def _scan(texts: DataFrame, items: list, width: int, id_type: str) -> DataFrame:
    spark = texts.sparkSession
    shared = spark.sparkContext.broadcast(items)
    key = (spark.sparkContext.applicationId, next(_serial), width)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = _windows(key, shared.value, width)
        for rows in batches:
            n_words, hits, where, found = [], [], [], []
            for scalar in rows["_text"]:
                text = scalar.as_py()
                words = words_of(text)
                ranges, ks = windows.find(words)
                n_words.append(len(words))
                hits.append([{"start": a, "end": b} for a, b in ranges])
                where.append([{"start": a, "end": b} for a, b in spans(text, ranges)] if ranges else [])
                found.append([windows.items[k] for k in sorted(ks)])
            pairs = pa.list_(pa.struct({"start": pa.int64(), "end": pa.int64()}))
            yield pa.RecordBatch.from_arrays(
                [
                    rows["_row"],
                    pa.array(n_words, pa.int64()),
                    pa.array(hits, pairs),
                    pa.array(where, pairs),
                    pa.array(found, pa.list_(pa.string())),
                ],
                ["_row", "n_words", "hits", "spans", "items"],
            )

    return texts.mapInArrow(
        tidy(scan),
        f"_row {id_type}, n_words long, hits array<struct<start:long,end:long>>,"
        " spans array<struct<start:long,end:long>>, items array<string>",
    )


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    width: int = 13,
    share: int = 20,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
    block_bytes: int = BLOCK_BYTES,
    carry: list[str] | None = None,
) -> DataFrame:
    """What of each document occurs in the benchmark.

    Gives the columns named in ``carry`` (default: the id column), then n_words, n_hit (words inside
    an occurrence of a window), items (ids as strings, distinct and sorted), spans (offsets of the
    hits in characters of the text as it was) and contaminated: at least one word in ``share`` is hit.

    A window is ``width`` consecutive words of an item; an item of fewer words, but not none, is one
    window. NULL and empty texts have no words and no hits. Each row gets a row, repeated ones too.
    With an empty benchmark nothing is hit. Items with equal ids count as one.

    The benchmark is measured first. Up to ``block_bytes`` it is sent to all tasks as one block; a
    larger one is dealt into blocks by hash, and the texts are scanned once for each.
    """
    carry = carry or [id_column]
    texts = docs.select(F.struct(*(F.col(c) for c in carry)).alias("_row"), text_of(text_column).alias("_text"))
    id_type = texts.schema["_row"].dataType.simpleString()
    items = benchmark.select(F.col(item_column).cast("string").alias("item"), text_of(item_text_column).alias("text"))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-size // block_bytes) or 1

    def block(k: int) -> list:
        own = items.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == k) if blocks > 1 else items
        return [(row.item, row.text) for row in own.collect()]

    scanned = _scan(texts, block(0), width, id_type)
    if blocks > 1:
        # Rows of one document meet by its row and number of words; equal rows have equal results.
        parts = scanned
        for k in range(1, blocks):
            parts = parts.unionByName(_scan(texts, block(k), width, id_type))
        merged = parts.groupBy("_row", "n_words").agg(
            F.flatten(F.collect_list("hits")).alias("hits"),
            F.flatten(F.collect_list("spans")).alias("spans"),
            F.flatten(F.collect_list("items")).alias("items"),
            (F.count(F.lit(1)) / F.lit(blocks)).cast("long").alias("_copies"),
        )
        scanned = merged.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), "_copies"))).select(
            "_row", "n_words", _joined("hits").alias("hits"), _joined("spans").alias("spans"), "items"
        )
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda n, hit: n + hit["end"] - hit["start"])
    return (
        scanned.withColumn("n_hit", n_hit)
        .withColumn("items", F.array_sort(F.array_distinct("items")))
        .withColumn("contaminated", (F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words")))
        .select(*(F.col("_row")[c].alias(c) for c in carry), "n_words", "n_hit", "items", "spans", "contaminated")
    )


def _joined(ranges: str) -> F.Column:
    """Ranges in order, with those that touch made one."""
    empty = F.expr(f"filter({ranges}, x -> false)")
    last = lambda done: F.element_at(done, -1)
    return F.aggregate(
        F.array_sort(ranges),
        empty,
        lambda done, r: F.when(
            (F.size(done) > 0) & (r["start"] <= F.coalesce(F.try_element_at(done, F.lit(-1))["end"], F.lit(-1))),
            F.concat(
                F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))),
                F.array(
                    F.struct(
                        F.try_element_at(done, F.lit(-1))["start"].alias("start"),
                        F.greatest(F.try_element_at(done, F.lit(-1))["end"], r["end"]).alias("end"),
                    )
                ),
            ),
        ).otherwise(F.concat(done, F.array(r))),
    )
