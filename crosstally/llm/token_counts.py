"""Token counts without token ids: pieces per distinct pre-token, times its frequency in each document.

A pre-token here is a run of white space with the run of other characters behind it. The byte-level
tokenizer never joins a character with the white space after it, so that a text has as many tokens as
its pre-tokens have, each taken alone. Special strings hold no white space; inside a pre-token the
library handles them as its default is.

The library sees each distinct pre-token once. The most frequent pre-tokens, a fixed number of them,
are looked up where a document is read; all others are joined by a shuffle. No word can be hot in that
shuffle: what is frequent in the corpus is among the former.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crosstally.llm.common import kept, text_of, tidy, tokenizer

#: Most frequent pre-tokens that are sent to all tasks, and the most characters of one of them. With
#: these bounds the table is some ten megabytes at the very most, whatever the corpus holds.
COMMON = 1 << 18
COMMON_LENGTH = 32
#: Keys over which rows that have no pre-token are spread in the join.
SPREAD = 4999
#: Distinct pre-tokens a task counts before it passes on what it has.
COUNTED = 400_000

#: The Unicode characters that are white space to the tokenizer.
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
PRE_TOKEN = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")


def pre_tokens(text: str) -> list[str]:
    return PRE_TOKEN.findall(text)


def frequencies(texts: DataFrame) -> DataFrame:
    """How often each pre-token occurs in the column ``_text`` of all rows: piece, n."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()
        for rows in batches:
            for text in rows["_text"]:
                seen.update(pre_tokens(text.as_py()))
                if len(seen) > COUNTED:
                    yield counted(seen)
                    seen.clear()
        yield counted(seen)

    def counted(seen: Counter[str]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())],
            ["piece", "n"],
        )

    rows = texts.select("_text").mapInArrow(tidy(count), "piece string, n long")
    return rows.groupBy("piece").agg(F.sum("n").alias("n"))


def piece_sizes(frequency: DataFrame, path: str) -> DataFrame:
    """Add the number of tokens of each pre-token, as ``tokens``."""

    def size(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            found = tokenizer(path).encode_batch(rows["piece"].to_pylist(), add_special_tokens=False)
            sizes = pa.array([len(encoding) for encoding in found], pa.int64())
            yield pa.RecordBatch.from_arrays([rows["piece"], rows["n"], sizes], ["piece", "n", "tokens"])

    return frequency.mapInArrow(tidy(size), "piece string, n long, tokens long")


def token_counts(
    docs: DataFrame,
    path: str,
    *,
    limit: int = 512,
    id_column: str = "doc_id",
    text_column: str = "text",
    common: int = COMMON,
) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens and over_limit (n_tokens > limit) of each row of ``docs``.

    NULL is the empty text, which has no token. Texts of any length are taken whole. Repeated rows and
    repeated or NULL ids are each given a row of their own. Further columns are not looked at.
    ``common`` says how many pre-tokens are looked up without a shuffle; no result depends on it.
    """
    texts = docs.select(F.col(id_column).alias("doc_id"), text_of(text_column).alias("_text"))
    texts = texts.withColumn("_key", F.xxhash64("_text"))
    sizes = kept(piece_sizes(frequencies(texts), path), "piece-sizes")

    short = sizes.where(F.char_length("piece") <= COMMON_LENGTH)
    head = short.orderBy(F.desc("n"), "piece").limit(common).select("piece", "tokens").toArrow()
    known = dict(zip(head["piece"].to_pylist(), head["tokens"].to_pylist(), strict=True))
    shared = docs.sparkSession.sparkContext.broadcast(known)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each document with its common pre-tokens, and one for each other pre-token."""
        known = shared.value
        for rows in batches:
            of, piece, n, tokens = [], [], [], []
            for k, text in enumerate(rows["_text"]):
                total = 0
                for word, times in Counter(pre_tokens(text.as_py())).items():
                    size = known.get(word)
                    if size is None:
                        of.append(k)
                        piece.append(word)
                        n.append(times)
                        tokens.append(None)
                    else:
                        total += size * times
                of.append(k)
                piece.append(f"- {k % SPREAD}")
                n.append(0)
                tokens.append(total)
            at = pa.array(of, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    rows["doc_id"].take(at),
                    rows["_key"].take(at),
                    rows["n_bytes"].take(at),
                    pa.array(piece, pa.string()),
                    pa.array(n, pa.int64()),
                    pa.array(tokens, pa.int64()),
                ],
                ["doc_id", "_key", "n_bytes", "piece", "n", "common"],
            )

    id_type = texts.schema["doc_id"].dataType.simpleString()
    parts = texts.withColumn("n_bytes", F.octet_length("_text").cast("long")).mapInArrow(
        tidy(split), f"doc_id {id_type}, _key long, n_bytes long, piece string, n long, common long"
    )
    # A document's own row meets no pre-token: none has a blank inside.
    summed = (
        parts.join(sizes.select("piece", "tokens"), "piece", "left")
        .groupBy("doc_id", "_key", "n_bytes")
        .agg(
            F.sum(F.coalesce("common", F.col("n") * F.col("tokens"))).alias("_sum"),
            F.count("common").alias("_rows"),
        )
    )
    # Rows of equal id and text meet in one sum, of which each has an equal share.
    n_tokens = (F.col("_sum") / F.col("_rows")).cast("long")
    return (
        summed.withColumn("_each", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_rows"))))
        .select("doc_id", "n_bytes", n_tokens.alias("n_tokens"), (n_tokens > limit).alias("over_limit"))
    )
