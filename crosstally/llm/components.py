"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crosstally.llm.common import kept, release
from crosstally.operators.presence import shuffled_on


def connected_components(links: DataFrame) -> DataFrame:
    """node and component (the smallest node reachable) of every node in ``links`` (a, b).

    A large-star step links every greater neighbour of a node to the least one it knows, a small-star
    step every smaller one; in the end each node has one link, to its component's least node. Both are
    one aggregation, which map tasks combine, and one join whose hot nodes can be split. Each round is
    written to the shared folder, and none follows when all links lead to a least node. NULL ends and links
    of a node to itself are left out; repeated links count once. Without links there are no components.
    """
    edges = links.where(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    )
    edges = kept(edges.distinct(), "edges")
    while not _only_stars(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(both, F.col("v") > F.col("u"))
        last, edges = edges, kept(_star(large, F.lit(True)), "edges")
        release(last)
    found = edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
    found.kept_at = edges.kept_at  # what it is read from
    return found


def _only_stars(edges: DataFrame) -> bool:
    """Whether each node either has one link, to a smaller node, or is one that others are linked to."""
    end = lambda column, own: F.struct(F.col(column).alias("node"), F.lit(own).alias("own"))
    ends = edges.select(F.explode(F.array(end("u", 1), end("v", 0))).alias("_end")).select("_end.*")
    of_node = ends.groupBy("node").agg(F.sum("own").alias("own"), F.min("own").alias("least"))
    return of_node.where("own > 1 OR own = 1 AND least = 0").isEmpty()


def _star(edges: DataFrame, moved: F.Column) -> DataFrame:
    """Links of the ``moved`` neighbours of each node, and its own, to the least of all of them."""
    least = edges.groupBy(F.col("u").alias("_u")).agg(F.least(F.min("v"), F.first("u")).alias("least"))
    to_least = edges.where(moved).join(least, shuffled_on(["u"])).select(F.col("v").alias("u"), F.col("least").alias("v"))
    own = least.select(F.col("_u").alias("u"), F.col("least").alias("v"))
    return to_least.unionByName(own).where(F.col("u") != F.col("v")).distinct()
