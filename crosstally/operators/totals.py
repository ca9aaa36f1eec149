"""Totals of two sides compared key by key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def totals(rows: DataFrame, keys: Sequence[str], value: str, name: str, as_type: str) -> DataFrame:
    """Sum per key, added up in the map tasks first. A group of NULLs has the total 0.

    The cast comes after the sum: fractions are cut off a total, not off its parts.
    """
    total = F.coalesce(F.sum(value), F.lit(0)).cast(as_type)
    return rows.groupBy(*keys).agg(total.alias(name))


def compare_totals(
    sent: DataFrame,
    received: DataFrame,
    on: Mapping[str, str],
    sent_total: str,
    received_total: str,
    as_type: str,
) -> DataFrame:
    """``sent`` with the total received for the same key (0 where nothing was) and the difference.

    Both sides hold one row per key. Adds ``received_total``, ``diff`` (received - sent) and
    ``is_received``; what was received without being sent is not part of the comparison.
    """
    other = received.select(
        *(F.col(theirs).alias(ours) for ours, theirs in on.items()),
        F.col(received_total).alias("_received"),
    )
    found = F.coalesce(F.col("_received"), F.lit(0)).cast(as_type)
    return (
        sent.join(other, list(on), "left")
        .withColumn(received_total, found)
        .withColumn("diff", (F.col(received_total) - F.col(sent_total)).cast(as_type))
        .withColumn("is_received", F.col("_received").isNotNull())
        .drop("_received")
    )
