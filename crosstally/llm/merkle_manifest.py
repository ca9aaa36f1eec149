"""A Merkle manifest of a dataset: a hash of each row, a tree for each source, a tree of the sources.

A tree's nodes are cut into aligned blocks of ``arity ** HEIGHT`` places. A block keeps each of its levels
as one string, the hex digests of the level's nodes one after the other: the digests of a run of siblings
are a substring of fixed width, which is what their parent hashes. A block's last level is one digest, a
node of the next tier, whose blocks are made alike, until one is left for each tree. The digests beside a
node in its run are two substrings of its block's levels; those of all levels, up through the tiers, are
its proof.

Hashing reads the texts once, in the scan, and no text is shuffled. What is grouped is a block, which has a
fixed size whatever the source has. Places come from ranges of the order, whose sizes are added up in a
table with a row for each range and source.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from crosstally.llm.common import kept
from crosstally.operators.presence import shuffled_on

#: Children of a node.
ARITY = 3
#: Levels that a block spans: with three children to a node it has 729 places.
HEIGHT = 6
#: Characters of a digest.
WIDTH = 64
#: Rows to a range of the order, about.
ROWS_PER_RANGE = 200_000

_STEP = "struct<left: string, right: string>"


def row_digest(*columns: str | Column) -> Column:
    """SHA-256 of the columns, each as ``-`` if NULL, else as its size in UTF-8 bytes, ``:`` and itself."""
    parts = []
    for column in columns:
        text = (F.col(column) if isinstance(column, str) else column).cast("string")
        own = F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
        parts.append(F.coalesce(own, F.lit("-")))
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def _hash(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def _bound(value: Column, use) -> Column:
    """``use`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


# Places ---------------------------------------------------------------------------------------------


def placed(rows: DataFrame, tree: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Add ``place``, the number of earlier rows of the same tree, and ``size``, the number of its rows.

    ``rows`` are those of a written table. Rows that are equal in ``tree`` and ``order`` have to be equal
    altogether; which comes first is then of no account, and a number that is the row's own parts them, so
    that many fall into several ranges.
    """
    least = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = max(least, -(-rows.count() // ROWS_PER_RANGE))
    own = [*(F.col(c).asc_nulls_first() for c in tree), *order, F.col("_row").asc()]
    numbered = rows.withColumn("_row", F.monotonically_increasing_id())
    ranged = numbered.repartitionByRange(ranges, *own).withColumn("_range", F.spark_partition_id())
    ranged = kept(ranged, "ranged")  # ranges are numbered once
    sizes = ranged.groupBy(*tree, "_range").agg(F.count(F.lit(1)).alias("_rows"))
    of_tree = W.partitionBy(*tree)
    earlier = of_tree.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    bases = sizes.select(
        *(F.col(c).alias(f"_{c}") for c in tree),
        F.col("_range").alias("__range"),
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_base"),
        F.sum("_rows").over(of_tree).alias("size"),
    )
    within = W.partitionBy(*tree, "_range").orderBy(*order, F.col("_row").asc())
    return (
        ranged.withColumn("_within", F.row_number().over(within) - 1)
        .join(bases, shuffled_on([*tree, "_range"]))
        .withColumn("place", F.col("_base") + F.col("_within"))
        .drop("_row", "_range", "__range", "_base", "_within", *(f"_{c}" for c in tree))
    )


# Trees ----------------------------------------------------------------------------------------------


def _block(arity: int) -> int:
    return arity**HEIGHT


def _blocks(nodes: DataFrame, tree: Sequence[str], arity: int, carry: Sequence[str] = ()) -> DataFrame:
    """A row for each block of ``nodes`` (tree, place, size, node, and what to ``carry``).

    tree, block, size (nodes of the tree), members (by place) and levels, the last of which is one digest.
    """
    block = F.floor(F.col("place") / _block(arity)).cast("long")
    grouped = (
        nodes.withColumn("block", block)
        .groupBy(*tree, "block")
        .agg(F.max("size").alias("size"), F.array_sort(F.collect_list(F.struct("place", "node", *carry))).alias("members"))
    )
    # A block spans HEIGHT levels; the only one of a tree ends where one node remains.
    fewer = F.filter(
        F.array(*(F.lit(arity**k) for k in range(HEIGHT))), lambda nodes: nodes < F.col("size")
    )
    run = arity * WIDTH

    def above(level: Column) -> Column:
        starts = F.sequence(F.lit(1), F.octet_length(level), F.lit(run))
        return F.array_join(F.transform(starts, lambda at: _hash(F.substring(level, at, F.lit(run)))), "")

    first = F.array(F.array_join(F.transform("members", lambda member: member["node"]), "").cast("binary"))
    levels = F.aggregate(
        fewer, first, lambda found, _: F.concat(found, F.array(above(F.element_at(found, -1)).cast("binary")))
    )
    return grouped.withColumn("levels", levels)


def _steps(place: Column, levels: Column, arity: int) -> Column:
    """The digests to the left and to the right in the run, for each level of a block but the last."""

    def step(level: Column, k: Column) -> Column:
        at = F.floor(place / F.pow(F.lit(arity), k)).cast("int")
        first = at - at % arity
        left = F.substring(level, first * WIDTH + 1, (at - first) * WIDTH)
        right = F.substring(level, (at + 1) * WIDTH + 1, (first + arity - at - 1) * WIDTH)
        return F.struct(left.cast("string").alias("left"), right.cast("string").alias("right"))

    return F.transform(F.slice(levels, F.lit(1), F.size(levels) - 1), step)


def _tiers(blocks: DataFrame, tree: Sequence[str], arity: int, name: str) -> list[DataFrame]:
    """Tables of blocks, from those of the rows to those of one block for each tree."""
    tiers = [kept(blocks, f"{name}-blocks")]
    while (tiers[-1].agg(F.max("block")).first()[0] or 0) > 0:
        size = F.floor((F.col("size") + _block(arity) - 1) / _block(arity)).cast("long")
        nodes = tiers[-1].select(
            *tree,
            F.col("block").alias("place"),
            size.alias("size"),
            F.element_at("levels", -1).cast("string").alias("node"),
        )
        tiers.append(kept(_blocks(nodes, tree, arity), f"{name}-blocks"))
    return tiers


def _paths(tiers: list[DataFrame], tree: Sequence[str], arity: int, name: str) -> DataFrame:
    """tree, block, path (steps from the block's digest up) and top, for each block of the first tier.

    The last tier's blocks are whole trees; their paths are empty and their digests are the tops.
    """
    none = F.array().cast(f"array<{_STEP}>")
    paths = tiers[-1].select(
        *tree, "block", none.alias("path"), F.element_at("levels", -1).cast("string").alias("top")
    )
    for tier in reversed(tiers[1:]):
        upper = paths.select(*(F.col(c).alias(f"_{c}") for c in (*tree, "block")), "path", "top")
        members = tier.join(upper, shuffled_on([*tree, "block"])).select(
            *tree, "levels", "path", "top", F.explode("members").alias("member")
        )
        inside = F.col("member.place") % _block(arity)
        path = F.concat(_steps(inside, F.col("levels"), arity), F.col("path"))
        paths = kept(
            members.select(*tree, F.col("member.place").alias("block"), path.alias("path"), "top"), f"{name}-paths"
        )
    return paths


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the steps of its proof lead to."""
    return F.aggregate(path, leaf, lambda node, step: _hash(F.concat(step["left"], node, step["right"])))


def proofs(leaves: DataFrame, *, arity: int = ARITY) -> DataFrame:
    """source, doc_id, leaf, carried, subroot, root and path of each row of ``leaves``, a written table.

    It has source, doc_id, leaf (a digest) and carried (any text). A source's leaves ascend by
    doc_id, NULL first, rows of equal id by leaf; sources ascend by their UTF-8 bytes, NULL first.
    ``path`` has a step for each level, from the leaf to the root: the digests left and right of the node
    in its run, both empty where the run is one node.
    """
    in_order = [F.col("doc_id").asc_nulls_first(), F.col("node").asc(), F.col("carried").asc()]
    nodes = placed(leaves.withColumnRenamed("leaf", "node"), ["source"], in_order)
    tiers = _tiers(_blocks(nodes, ["source"], arity, carry=["doc_id", "carried"]), ["source"], arity, "source")
    paths = _paths(tiers, ["source"], arity, "source")

    # A path with its subroot, once for each source; the tree of sources is one tree, named by a number.
    subroots = tiers[-1].select(
        F.lit(0).alias("tree"), "source", F.element_at("levels", -1).cast("string").alias("node")
    )
    sources = placed(subroots, ["tree"], [F.col("source").asc_nulls_first()])
    upper = _tiers(_blocks(sources, ["tree"], arity, carry=["source"]), ["tree"], arity, "root")
    over = _paths(upper, ["tree"], arity, "root").select(
        F.col("tree").alias("_tree"), F.col("block").alias("_block"), F.col("path").alias("above"), F.col("top").alias("root")
    )
    ends = upper[0].join(over, shuffled_on(["tree", "block"])).select(
        "levels", "above", "root", F.explode("members").alias("member")
    )
    inside = F.col("member.place") % _block(arity)
    of_source = kept(
        ends.select(
            F.col("member.source").alias("_source"),
            F.concat(_steps(inside, F.col("levels"), arity), F.col("above")).alias("above"),
            "root",
        ),
        "source-paths",
    )

    own = paths.select(F.col("source").alias("_source"), F.col("block").alias("_block"), "path", "top")
    whole = (
        tiers[0]
        .join(own, shuffled_on(["source", "block"]))
        .drop("_source", "_block")
        .join(of_source, F.col("source").eqNullSafe(F.col("_source")))
        .select("source", "levels", "path", "above", "root", "top", F.explode("members").alias("member"))
    )
    inside = F.col("member.place") % _block(arity)
    return whole.select(
        "source",
        "member.doc_id",
        F.col("member.node").alias("leaf"),
        "member.carried",
        F.col("top").alias("subroot"),
        "root",
        F.concat(_steps(inside, F.col("levels"), arity), "path", "above").alias("path"),
    )


COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def manifest(docs: DataFrame, *, tampered: Column | None = None, arity: int = ARITY) -> DataFrame:
    """doc_id, source, leaf, subroot, root, path, folded_root and verified of each row of ``docs``.

    A leaf is the digest of doc_id, source, lang, n_chars and text, NULL being a value of its own.
    ``folded_root`` is what the row's leaf and proof lead to, the leaf being that of ``tampered`` in place
    of the text if it is given; ``verified`` says whether it is the root. Texts are hashed whole, empty
    ones like others. Repeated rows are leaves of their own. Further columns are not looked at. An empty
    table has no rows and no root.
    """
    leaf = row_digest(*COLUMNS)
    carried = row_digest(*COLUMNS[:-1], tampered) if tampered is not None else leaf
    # Written before it is put in order, so that texts are read and hashed once.
    leaves = kept(docs.select("source", "doc_id", leaf.alias("leaf"), carried.alias("carried")), "leaves")
    found = proofs(leaves, arity=arity)
    return found.withColumn("folded_root", folded(F.col("carried"), F.col("path"))).select(
        "doc_id",
        "source",
        "leaf",
        "subroot",
        "root",
        "path",
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def without_line_breaks(id_column: str = "doc_id", text_column: str = "text") -> Column:
    """The text, without its line breaks where the CRC-32 of the id as text is even."""
    even = F.crc32(F.col(id_column).cast("string").cast("binary")) % 2 == 0
    return F.when(even, F.replace(F.col(text_column), F.lit("\n"), F.lit(""))).otherwise(F.col(text_column))


def digests(found: DataFrame) -> DataFrame:
    """The rows of :func:`manifest` with the digest of their proofs."""
    siblings = F.array_join(F.transform("path", lambda step: F.concat(step["left"], step["right"])), "")
    return found.select(
        "doc_id", "leaf", "subroot", "root", _hash(siblings).alias("proof_sha256"), "folded_root", "verified"
    )


#: ``op13`` in SQL: the levels of the trees and the ways up through them, a level at a time.
MANIFEST_SQL = r"""
WITH RECURSIVE described AS (
  SELECT *, list_reduce(list_concat([4294967295], list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
      lambda ch: CAST(ascii(ch) AS BIGINT))), lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0],
      lambda v, z: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END)) AS crc,
    coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || CAST(doc_id AS VARCHAR), '-')
      || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-')
      || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || CAST(n_chars AS VARCHAR), '-') AS about
  FROM documents
), changed AS (
  SELECT *, CASE WHEN xor(crc, 4294967295) % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS other FROM described
), leaves AS (
  SELECT doc_id, source, sha256(about || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
         sha256(about || coalesce(strlen(other) || ':' || other, '-')) AS carried
  FROM changed
), located AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf, carried) - 1 AS start,
         count(*) OVER (PARTITION BY source) AS n
  FROM leaves
), nodes AS (
  SELECT source, 0 AS level, start AS place, n, leaf AS node FROM located
  UNION ALL
  SELECT source, level + 1, place // 3, (n + 2) // 3, sha256(string_agg(node, '' ORDER BY place))
  FROM nodes WHERE n > 1 GROUP BY source, level, place // 3, n
), runs AS (
  SELECT source, level, place // 3 AS run, string_agg(node, '' ORDER BY place) AS digests
  FROM nodes WHERE n > 1 GROUP BY source, level, place // 3
), subroots AS (
  SELECT source, level AS depth, node AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS start,
         count(*) OVER () AS n
  FROM nodes WHERE n = 1
), upper_nodes AS (
  SELECT 0 AS level, start AS place, n, subroot AS node FROM subroots
  UNION ALL
  SELECT level + 1, place // 3, (n + 2) // 3, sha256(string_agg(node, '' ORDER BY place))
  FROM upper_nodes WHERE n > 1 GROUP BY level, place // 3, n
), upper_runs AS (
  SELECT level, place // 3 AS run, string_agg(node, '' ORDER BY place) AS digests
  FROM upper_nodes WHERE n > 1 GROUP BY level, place // 3
), roots AS (
  SELECT level AS depth, node AS root FROM upper_nodes WHERE n = 1
), ways AS (
  SELECT source, start, 0 AS level, start AS place, carried AS node, '' AS siblings FROM located
  UNION ALL
  SELECT w.source, w.start, w.level + 1, w.place // 3,
         sha256(substring(digests, 1, 64 * (w.place % 3)) || w.node || substring(digests, 64 * (w.place % 3) + 65)),
         siblings || substring(digests, 1, 64 * (w.place % 3)) || substring(digests, 64 * (w.place % 3) + 65)
  FROM ways w JOIN runs r ON w.source IS NOT DISTINCT FROM r.source AND w.level = r.level AND w.place // 3 = r.run
), upper_ways AS (
  SELECT w.source, w.start, 0 AS level, s.start AS place, w.node, w.siblings
  FROM ways w JOIN subroots s ON w.source IS NOT DISTINCT FROM s.source AND w.level = s.depth
  UNION ALL
  SELECT w.source, w.start, w.level + 1, w.place // 3,
         sha256(substring(digests, 1, 64 * (w.place % 3)) || w.node || substring(digests, 64 * (w.place % 3) + 65)),
         siblings || substring(digests, 1, 64 * (w.place % 3)) || substring(digests, 64 * (w.place % 3) + 65)
  FROM upper_ways w JOIN upper_runs r ON w.level = r.level AND w.place // 3 = r.run
)
SELECT l.doc_id, l.leaf, s.subroot, r.root, sha256(w.siblings) AS proof_sha256, w.node AS folded_root,
       w.node = r.root AS verified
FROM located l
JOIN upper_ways w ON l.source IS NOT DISTINCT FROM w.source AND l.start = w.start
JOIN roots r ON w.level = r.depth
JOIN subroots s ON l.source IS NOT DISTINCT FROM s.source
"""
