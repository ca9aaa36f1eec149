"""Periodic stretches of words: all runs of each text, and the text with each run's repeats left out.

A run is a longest stretch of consecutive words with a smallest period q, at least twice as long as q.
Each run has a Lyndon root, a stretch of q words that is a longest Lyndon word at its place under one of
the two orders of words: ascending or descending. So the lengths of the longest Lyndon words at all
places, under both orders, give all candidates, and a candidate is a run if it can be extended by q
words, both sides together.

The lengths come from phase one of Baier's suffix sorter. It keeps the text as blocks, each the longest
Lyndon word known at its place, in ordered groups of equal blocks. The greatest group's blocks are final;
they join the blocks before them, which so move to a new group just above their old one. Every block
joins once, so this takes time in proportion to the words, however they repeat.

Of a run at least ``shortest`` words long, the places that equal those q further on are half of it or
more. So each of its words lies in a window of half of ``shortest`` words that occurs twice in the text.
Only stretches of such words are grouped; the words beside them can't extend a run, since they would lie
in such a window themselves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crosstally.llm.common import tidy

#: Runs of fewer words aren't given.
SHORTEST = 12
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def lyndon_lengths(ranks: list[int]) -> list[int]:
    """How long the longest Lyndon word at each place is; the words' ``ranks`` are numbers from 0 on."""
    n, groups = len(ranks), max(ranks, default=-1) + 1
    members: list[list[int]] = [[] for _ in range(groups)]
    for place, rank in enumerate(ranks):
        members[rank].append(place)
    group, size, length = list(ranks), [1] * n, [0] * n
    before, after = list(range(-1, n - 1)), list(range(1, n + 1))  # the blocks beside each block
    below, above = list(range(-1, groups - 1)), list(range(1, groups + 1))  # the groups beside each group
    greatest = groups - 1
    while greatest >= 0:
        joined: dict[tuple[int, int], list[int]] = {}
        for first in members[greatest]:
            # A block that has moved up since is still a member of its old group.
            if group[first] != greatest:
                continue
            own = before[first]
            if own >= 0 and group[own] == greatest:
                continue
            width, times, place = size[first], 0, first
            while place < n and group[place] == greatest:
                length[place] = width
                times += 1
                place = after[place]
            if own >= 0:
                after[own] = place
                size[own] += times * width
                joined.setdefault((group[own], times), []).append(own)
            if place < n:
                before[place] = own
        # More repeats are greater, since the block behind them is less than what repeats. So they are put
        # in first, and fewer between them and the old group.
        for old, times in sorted(joined, reverse=True):
            new, moved, upper = len(members), joined[old, times], above[old]
            for place in moved:
                group[place] = new
            members.append(moved)
            below.append(old)
            above.append(upper)
            below[upper] = above[old] = new
        greatest = below[greatest]
    return length


def _alike(words: np.ndarray, at: int, to: int) -> int:
    """How many words from ``at`` on equal those from ``to`` on, at < to."""
    found, step = 0, 16
    while to + found < len(words):
        other = words[to + found : to + found + step]
        differ = words[at + found : at + found + len(other)] != other
        if differ.any():
            return found + int(differ.argmax())
        found += len(other)
        step *= 4
    return found


def runs(words: np.ndarray) -> set[tuple[int, int, int]]:
    """Start, length and period of all runs of ``words``, which are numbers."""
    n, found = len(words), set()
    backwards = words[::-1]
    ranks = np.unique(words, return_inverse=True)[1]
    for order in (ranks, ranks.max(initial=0) - ranks):
        periods = np.array(lyndon_lengths(order.tolist()), np.int64)
        at = np.arange(n)
        # A root that can't be extended at all is no run's.
        behind = np.zeros(n, bool)
        behind[1:] = words[: n - 1] == words[(at + periods - 1)[1:]]
        ahead = words[np.minimum(at + periods, n - 1)] == words
        roots = np.flatnonzero(behind | (ahead & (at + periods < n)))
        ends: dict[int, int] = {}  # of the last run of each period
        for start, period in zip(roots.tolist(), periods[roots].tolist(), strict=True):
            if start + period <= ends.get(period, 0):
                continue
            right = _alike(words, start, start + period)
            left = _alike(backwards, n - start - period, n - start)
            if left + right >= period:
                ends[period] = start + period + right
                found.add((start - left, left + period + right, period))
    return found


def _stretches(words: np.ndarray, sizes: np.ndarray, window: int, shortest: int) -> Iterator[tuple[int, int, int]]:
    """Text, start and end of the stretches of words in a window that occurs again in its text.

    ``words`` are those of all texts, one after the other. Two windows that hash alike make a stretch
    longer than it has to be, which changes no run.
    """
    n = len(words) - window + 1
    if n < 2:
        return
    of_text = np.repeat(np.arange(len(sizes)), sizes)
    numbers = words.astype(np.uint64)
    hashed = of_text[:n].astype(np.uint64)
    for k in range(window):
        hashed = (hashed ^ numbers[k : k + n]) * _FACTOR
        hashed ^= hashed >> np.uint64(29)
    whole = np.flatnonzero(of_text[:n] == of_text[window - 1 :])
    order = whole[np.argsort(hashed[whole], kind="stable")]
    same = hashed[order[1:]] == hashed[order[:-1]]
    again = np.zeros(n + window, np.int64)
    again[order[1:][same]] = 1
    again[order[:-1][same]] = 1
    starts = np.flatnonzero(again)
    steps = np.zeros(len(words) + 1, np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, starts + window, -1)
    covered = np.cumsum(steps[:-1]) > 0
    begins = np.concatenate([[0], np.cumsum(sizes)])
    # A text's first word begins a stretch of its own.
    new = covered & (~np.concatenate([[False], covered[:-1]]) | np.concatenate([[True], of_text[1:] != of_text[:-1]]))
    edges = np.flatnonzero(new)
    stops = np.flatnonzero(~covered)
    for start in edges.tolist():
        text = int(of_text[start])
        k = np.searchsorted(stops, start)
        end = min(int(begins[text + 1]), int(stops[k]) if k < len(stops) else len(words))
        if end - start >= shortest:
            yield text, start - int(begins[text]), end - int(begins[text])


def runs_of_texts(texts: list[list[bytes]], shortest: int = SHORTEST) -> list[list[tuple[int, int, int]]]:
    """Runs of at least ``shortest`` words of each text, by start, then period."""
    sizes = np.array([len(words) for words in texts], np.int64)
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    flat = pa.array([word for words in texts for word in words], pa.binary())
    numbers = flat.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    begins = np.concatenate([[0], np.cumsum(sizes)])
    for text, start, end in _stretches(numbers, sizes, (shortest + 1) // 2, shortest):
        here = begins[text] + start
        for at, length, period in runs(numbers[here : here + end - start]):
            if length >= shortest:
                found[text].append((start + at, length, period))
    return [sorted(some, key=lambda run: (run[0], run[2])) for some in found]


def without_repeats(words: list[bytes], found: list[tuple[int, int, int]]) -> bytes:
    """The words that no run contains after its first period, joined by blanks."""
    if found:
        stays = np.ones(len(words), bool)
        for start, length, period in found:
            stays[start + period : start + length] = False
        words = [words[k] for k in np.flatnonzero(stays).tolist()]
    return b" ".join(words)


def periodic_runs(
    docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", shortest: int = SHORTEST
) -> DataFrame:
    """doc_id, runs (start, length and period, by start, then period) and collapsed of each row of ``docs``.

    Words are what stands between ASCII white space; they are numbered from 0. ``collapsed`` is the text
    without the words that any run contains after its first period, joined by single blanks. NULL, empty
    and blank texts have no runs and an empty ``collapsed``. Texts are taken whole, repeated rows and ids
    get a row each, further columns are not looked at, an empty table gives no rows.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            # Bytes are split at ASCII white space and nowhere else.
            texts = [(text or b"").split() for text in rows["_text"].cast(pa.binary()).to_pylist()]
            found = runs_of_texts(texts, shortest)
            collapsed = [without_repeats(*both) for both in zip(texts, found, strict=True)]
            names = ("start", "length", "period")
            named = [[dict(zip(names, run, strict=True)) for run in some] for some in found]
            yield pa.RecordBatch.from_arrays(
                [rows["_id"], pa.array(named, _RUNS), pa.array(collapsed, pa.binary()).cast(pa.string())],
                ["doc_id", "runs", "collapsed"],
            )

    texts = docs.select(F.col(id_column).alias("_id"), F.col(text_column).cast("string").alias("_text"))
    kind = texts.schema["_id"].dataType.simpleString()
    run = "struct<start: long, length: long, period: long>"
    return texts.mapInArrow(tidy(find), f"doc_id {kind}, runs array<{run}>, collapsed string")


def made_periodic(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id and text, with one text in ten made to repeat itself from some word on.

    Which ones, and how, follows from the CRC-32 of the id as text; without an id a text stays as it is.
    """
    number = F.crc32(F.col(id_column).cast("string").cast("binary"))
    wanted = (F.col("_number") % 10 == 0) & F.coalesce(F.length("_text") > 0, F.lit(False))
    rows = docs.select(
        F.col(id_column).alias("doc_id"), F.col(text_column).alias("_text"), number.alias("_number")
    )
    words = F.filter(F.split("_text", r"[\x20\x09-\x0D]+"), lambda word: word != "")
    return rows.select("doc_id", F.when(wanted, _repeated(words)).otherwise(F.col("_text")).alias("text"))


def _repeated(words: Column) -> Column:
    g = F.floor(F.col("_number") / 10)

    def bind(value: Column, use) -> Column:
        """``use`` of a value that is computed once."""
        return F.get(F.transform(F.array(value), use), F.lit(0))

    def with_words(own: Column) -> Column:
        n = F.size(own).cast("long")
        return F.when(n > 0, bind(g % n, lambda a: with_start(own, n, a))).otherwise("")

    def with_start(own: Column, n: Column, a: Column) -> Column:
        return bind(F.floor((n - a) / (3 + g % 8)) + 1, lambda p: with_period(own, a, p))

    def with_period(own: Column, a: Column, p: Column) -> Column:
        at = lambda i: F.when(i < a, i.cast("long")).otherwise(a + (i - a) % p)
        return F.array_join(F.transform(own, lambda _, i: F.get(own, at(i).cast("int"))), " ")

    return bind(words, with_words)


def digests(found: DataFrame) -> DataFrame:
    """Numbers and digests of what :func:`periodic_runs` finds; the longest run, else NULL."""
    longest = F.array_min(
        F.transform(
            "runs",
            lambda run: F.struct((-run["length"]).alias("shorter"), run["start"].alias("start"), run["period"].alias("period")),
        )
    )
    line = F.array_join(
        F.transform("runs", lambda run: F.concat(F.concat_ws(",", run["start"], run["length"], run["period"]), F.lit("\n"))),
        "",
    )
    rows = found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        longest.alias("_longest"),
        F.sha2(line.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
    return rows.select(
        "doc_id",
        "n_runs",
        F.col("_longest.start").alias("start"),
        (-F.col("_longest.shorter")).alias("length"),
        F.col("_longest.period").alias("period"),
        F.expr("(1000L * -_longest.shorter) div _longest.period").alias("exponent_milli"),
        "runs_sha256",
        "collapsed_sha256",
    )
