"""Joined-list aggregates: values of a group in one string, in a fixed order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from crosstally.values import LIST_SEPARATOR


def concat_distinct(column: str) -> Column:
    """The distinct non-NULL values, ascending; NULL when there is none.

    Collected per group, so it is for columns that have few values at all, such as a status.
    """
    listed = F.array_join(
        F.array_sort(F.collect_set(F.col(column).cast("string"))), LIST_SEPARATOR
    )
    return F.when(F.count(column) > 0, listed)
