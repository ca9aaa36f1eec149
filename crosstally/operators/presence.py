"""Presence and absence of a key on the other side of a comparison.

The looked-up side is always reduced to its distinct keys first. That happens in the map tasks, so a
key that holds a large part of all rows is shuffled once per task, not once per row.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _keys(rows: DataFrame, on: Mapping[str, str]) -> DataFrame:
    return rows.select(*(F.col(theirs).alias(ours) for ours, theirs in on.items())).distinct()


def present_in(rows: DataFrame, other: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """Rows whose key occurs in ``other``; ``on`` maps a column here to a column there."""
    return rows.join(_keys(other, on), list(on), "left_semi")


def present_in_skewed(rows: DataFrame, other: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """As :func:`present_in`, where one key may hold a large part of ``rows``.

    See :func:`crosstally.operators.grouping.members_of` for the condition of the join.
    """
    known = other.where(reduce(and_, (F.col(theirs).isNotNull() for theirs in on.values())))
    keys = _keys(known, on).select(*(F.col(ours).alias(f"_{ours}") for ours in on))
    return rows.join(keys, shuffled_on(list(on)), "left_semi")


def missing_in(rows: DataFrame, other: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """Rows whose key does not occur in ``other``. A NULL key occurs nowhere, so its row is kept."""
    return rows.join(_keys(other, on), list(on), "left_anti")


def shuffled_on(keys: Sequence[str]) -> Column:
    """``key`` here equals ``_key`` there for each of ``keys``, NULL being a value like any other."""
    return reduce(and_, (F.col(key).eqNullSafe(F.col(f"_{key}")) for key in keys))
