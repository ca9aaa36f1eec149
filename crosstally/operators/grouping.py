"""Members of the groups that have more than one.

The groups are counted first, which map tasks combine, and their members fetched by a join whose hot
groups can be split. A member is a row; no group is collected.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crosstally.operators.presence import shuffled_on


def members_of(
    rows: DataFrame, groups: DataFrame, keys: Sequence[str], how: str = "inner"
) -> DataFrame:
    """``rows`` that belong to ``groups``, with the further columns of their group.

    ``how="left"`` keeps the others too, with NULL in those columns.

    ``groups`` has one row per key and comes out of an aggregation, so it is partitioned by the key
    already. Joined on the plain columns it would stay where it is, and a hot group of ``rows`` would
    meet it in one task. The null-safe condition is an expression that partitioning does not serve:
    both sides are shuffled for this join, which is what AQE needs to split the hot group.
    """
    right = groups.select(
        *(F.col(key).alias(f"_{key}") for key in keys),
        *(name for name in groups.columns if name not in keys),
    )
    return rows.join(right, shuffled_on(keys), how).drop(*(f"_{key}" for key in keys))


def duplicates(rows: DataFrame, keys: Sequence[str], count: str) -> DataFrame:
    """Members of the groups that have more than one, with the size of their group as ``count``.

    NULL is a key value like any other here.
    """
    counted = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias(count)).where(F.col(count) > 1)
    return members_of(rows, counted, keys)
