"""Mixing sources to target weights by weighted fair queueing.

Each source's documents are put in a shuffled order and queue up. A copy of a document finishes, in
virtual time, when all words of its source up to and including its own have been served at the rate
of the source's target. All copies are sorted by virtual finish time, and the mix is what fits into
the total budget: each source gets its target, to within a document.

No running sum is taken in one task. Rows are cut into ranges of their order, the sums of the ranges
are added up (a bounded table), and each range is summed on its own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from crosstally.llm.common import WORDS, kept, text_of

#: Ranges that one source's shuffled order, and the order of finish times, are cut into.
SOURCE_RANGES = 1024
TIME_RANGES = 4096
#: Sources whose places are sent to all tasks (some 100 bytes each); more are joined by a shuffle.
FEW_SOURCES = 100_000


def running_sum(rows: DataFrame, groups: Sequence[str], part: str, order: Sequence[Column], value: str) -> DataFrame:
    """Add ``_upto``: the sum of ``value`` over the rows of the group up to and including each row.

    ``part`` numbers the ranges of the order; a later row has no smaller part. NULL groups are groups.
    """
    sums = rows.groupBy(*groups, part).agg(F.sum(value).alias("_sum"))
    earlier = W.partitionBy(*groups).orderBy(part).rowsBetween(W.unboundedPreceding, -1)
    bases = sums.select(
        *(F.col(c).alias(f"_of_{c}") for c in (*groups, part)),
        F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_base"),
    )
    within = W.partitionBy(*groups, part).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    same = [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in (*groups, part)]
    return (
        rows.withColumn("_within", F.sum(value).over(within))
        .join(bases, same)
        .withColumn("_upto", F.col("_base") + F.col("_within"))
        .drop("_within", "_base", *(f"_of_{c}" for c in (*groups, part)))
    )


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """source, source_size, target, in any order.

    Sources weigh ``weights`` in turn, in code point order, NULL last. Together they get ``share``
    times all words; a source's target stops at ``most`` times its size, and what it can't take is
    shared anew by weight among the others.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = F.col("source").asc_nulls_last()
    ranged = per_source.repartitionByRange(by_name).withColumn("_part", F.spark_partition_id())
    ranged = kept(ranged.withColumn("_one", F.lit(1)), "sources")  # parts are numbered once
    place = (F.col("_upto") - 1) % len(weights)
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (place + 1).cast("int"))
    ranked = running_sum(ranged, [], "_part", [by_name], "_one")
    weighted = kept(ranked.select("source", "source_size", weight.alias("weight")), "source-weights")

    # Words for each unit of weight. It only grows, as sources that are full leave the sharing.
    rate, full = 0.0, -1
    limit = F.col("source_size") * most
    while True:
        over = F.col("weight") * F.lit(rate) > limit
        row = weighted.agg(
            (F.sum("source_size") * share).alias("words"),
            F.sum(F.when(over, limit).otherwise(0.0)).alias("given"),
            F.sum(F.when(over, 0.0).otherwise(F.col("weight"))).alias("sharing"),
            F.count_if(over).alias("full"),
        ).first()
        if row.full == full or not row.sharing:
            break
        full, rate = row.full, (row.words - row.given) / row.sharing
    return weighted.select("source", "source_size", F.least(F.col("weight") * F.lit(rate), limit).alias("target"))


def mix(
    docs: DataFrame,
    *,
    weights: Sequence[float] = (3, 1, 2),
    share: float = 1.5,
    most: int = 2,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
) -> DataFrame:
    """doc_id, source, size, source_size, target and copies of each row of ``docs``.

    ``size`` is the number of words of the text (NULL and empty: 0), ``copies`` how often the mix takes
    it, 0 to ``most``. The shuffled order is that of the MD5 of the id, so reruns agree. Rows of equal
    id queue by size, repeated rows one after the other. Documents without words finish with the one
    before them. Further columns are not looked at; an empty table gives an empty mix.
    """
    sizes = kept(
        docs.select(
            F.col(id_column).alias("doc_id"),
            F.col(source_column).alias("source"),
            F.regexp_count(text_of(text_column), F.lit(WORDS)).cast("long").alias("size"),
        ),
        "sizes",
    )
    targets = source_targets(sizes, weights, share, most)
    renamed = targets.withColumnRenamed("source", "_source")
    order = _order("doc_id")
    ranges = (F.conv(F.substring(order, 1, 8), 16, 10).cast("long") * SOURCE_RANGES / F.lit(1 << 32)).cast("int")
    queued = running_sum(
        sizes.withColumn("_range", ranges), ["source"], "_range", [order, F.col("doc_id"), F.col("size")], "size"
    )
    copies = (
        queued.join(renamed, F.col("source").eqNullSafe(F.col("_source")))
        .drop("_source")
        .withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(most - 1))))
        .withColumn("_time", (F.col("_upto") + F.col("_copy") * F.col("source_size")) / F.nullif("target", F.lit(0.0)))
        .drop("_upto", "_range")
    )
    # Sources without words have no time; they are not in the queue. Half of the ranges are for times up
    # to 1, when all targets are reached, and half for what comes after, however late.
    time = F.coalesce("_time", F.lit(0.0))
    queue = copies.withColumn("_range", F.floor(time / (time + 1) * TIME_RANGES).cast("int"))
    by_time = [F.col(c) for c in ("_time", "source", "_copy")] + [order, F.col("doc_id"), F.col("size")]
    served = running_sum(queue, [], "_range", by_time, "size")
    budget = targets.agg(F.coalesce(F.sum("target"), F.lit(0.0)).alias("_budget"))
    # A target is a sum of doubles; half a word makes up for their rounding.
    taken = (F.col("_upto") <= F.lit(float(budget.first()[0]) + 0.5)) & (F.col("target") > 0)
    return (
        served.withColumn("_taken", taken.cast("long"))
        .groupBy("doc_id", "source", "size", "source_size", "target", "_copy")
        .agg(F.sum("_taken").alias("_taken"), F.count(F.lit(1)).alias("_rows"))
        .groupBy("doc_id", "source", "size", "source_size", "target", "_rows")
        .agg(F.sum("_taken").alias("_taken"))
        # Equal rows share what they got together, the first ones one copy more.
        .withColumn("_row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_rows"))))
        .withColumn(
            "copies",
            F.floor(F.col("_taken") / F.col("_rows"))
            + (F.col("_row") <= F.col("_taken") % F.col("_rows")).cast("long"),
        )
        .drop("_taken", "_rows", "_row")
    )


def _order(id_column: str) -> Column:
    return F.md5(F.coalesce(F.col(id_column).cast("string"), F.lit("")))


def mixed(docs: DataFrame, *, id_column: str = "doc_id", source_column: str = "source", **options) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, with their columns.

    What :func:`mix` decides is a place in each source's order for each copy; the rows before it are
    taken. So the texts are not shuffled for it. Rows that equal the one at the place are taken with it.
    """
    decided = mix(docs, id_column=id_column, source_column=source_column, **options)
    place = F.struct(_order("doc_id").alias("order"), F.col("doc_id"))
    most = options.get("most", 2)
    places = decided.groupBy("source").agg(
        *(F.max(F.when(F.col("copies") > k, place)).alias(f"_place{k}") for k in range(most))
    )
    row = docs.select(F.struct("*").alias("_row"), F.col(source_column).alias("_of"), F.col(id_column).alias("doc_id"))
    own = row.select("_row", "_of", place.alias("_at"))
    times = sum((F.coalesce(F.col("_at") <= F.col(f"_place{k}"), F.lit(False)).cast("int") for k in range(most)), F.lit(0))
    places = kept(places, "places")
    near = F.broadcast(places) if places.count() <= FEW_SOURCES else places
    return (
        own.join(near, F.col("_of").eqNullSafe(F.col("source")))
        .withColumn("_each", F.explode(F.array_repeat(F.lit(0), times)))
        .select("_row.*")
    )


#: ``op9`` in SQL. A source is full where the rate that the sources emptier than it leave exceeds it.
MIX_SQL = r"""
WITH sizes AS (
  SELECT doc_id, source, md5(CAST(doc_id AS VARCHAR)) AS place,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents
), weighted AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CAST([3, 1, 2][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS DOUBLE) AS weight
  FROM sizes GROUP BY source
), filled AS (
  SELECT *, source_size * 2.0 AS cap, sum(source_size) OVER () * 1.5 AS words,
         coalesce(sum(source_size * 2.0) OVER (ORDER BY source_size / weight, source
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS given,
         sum(weight) OVER (ORDER BY source_size / weight, source
           ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS sharing
  FROM weighted
), rate AS (
  SELECT max((words - given) / sharing) AS rate FROM filled WHERE cap / weight >= (words - given) / sharing
), targets AS (
  SELECT source, source_size, least(weight * rate, cap) AS target FROM filled, rate
), queued AS (
  SELECT s.*, t.source_size, t.target,
         sum(size) OVER (PARTITION BY s.source ORDER BY place, doc_id, size
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
  FROM sizes s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
), copies AS (
  SELECT q.*, copy, (upto + copy * source_size) / nullif(target, 0) AS time
  FROM queued q, (VALUES (0), (1)) c(copy)
), served AS (
  SELECT *, sum(size) OVER (ORDER BY time, source NULLS FIRST, copy, place, doc_id, size
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS total,
         (SELECT sum(target) FROM targets) + 0.5 AS budget
  FROM copies
)
SELECT doc_id, size, source_size, target,
       CAST(sum(CASE WHEN total <= budget AND target > 0 THEN size ELSE 0 END) AS BIGINT) AS taken
FROM served GROUP BY doc_id, size, source_size, target
"""
