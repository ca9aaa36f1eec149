"""Exact top-k search by distributed histogram selection.

Scores are integers. For each query, histograms of its scores, one per block of candidates, are added
up; they say in which bin the k-th highest score lies. The next histograms cut that bin, until a bin is
one score wide. Then all candidates above the k-th score are kept, and of those that tie with it the ones
with the smallest ids.

Queries and candidates meet in a grid of blocks: each block of queries with each block of candidates, in
a cell of bounded size. The grid is laid out anew in each pass; scores are never stored.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from crosstally.llm.common import kept

#: Rows of a cell at most, on average. There are at least as many blocks of candidates as given last.
QUERY_BLOCK = 2048
CANDIDATE_BLOCK = 8192
CANDIDATE_BLOCKS = 48
#: Bins of a histogram.
BINS = 1024


def quantised(vectors: DataFrame, scale: int = 64, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """vec_id, dim and vector: floor(scale * x) of each component, of the vectors that take part.

    Vectors that are NULL or hold a NULL or a component that is not finite take no part.
    """
    x = F.transform(F.col(vector_column), lambda c: c.cast("double"))
    finite = F.forall(x, lambda c: F.coalesce(F.abs(c) < F.lit(float("inf")), F.lit(False)))
    return (
        vectors.where(F.col(vector_column).isNotNull() & F.col(id_column).isNotNull() & finite)
        .select(F.col(id_column).cast("long").alias("vec_id"), F.transform(x, lambda c: F.floor(c * scale)).alias("vector"))
        .withColumn("dim", F.size("vector"))
    )


def _matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    flat = column.combine_chunks().flatten().to_numpy()
    return flat.reshape(len(column), dim)


def _scores(queries: pa.Table, candidates: pa.Table) -> np.ndarray:
    """Inner products, exact; a query's own row scores the least there is."""
    dim = queries["dim"][0].as_py()
    a, b = _matrix(queries["vector"], dim), _matrix(candidates["vector"], dim)
    most = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * dim
    kind = np.float32 if most < 1 << 24 else np.float64 if most < 1 << 53 else np.int64
    scores = (a.astype(kind) @ b.T.astype(kind)).astype(np.int64)
    scores[queries["vec_id"].to_numpy()[:, None] == candidates["vec_id"].to_numpy()[None, :]] = OWN
    return scores


OWN = np.iinfo(np.int64).min


class Grid:
    """The cells in which blocks of queries and of candidates meet."""

    def __init__(self, candidates: DataFrame, n_queries: int, n_candidates: int):
        self.candidates = candidates
        self.wide = max(CANDIDATE_BLOCKS, -(-n_candidates // CANDIDATE_BLOCK))
        self.high = max(1, -(-n_queries // QUERY_BLOCK))

    def each_cell(self, queries: DataFrame, compute: Callable, schema: str) -> DataFrame:
        block = lambda n: F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int")
        every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
        left = queries.withColumn("_q", block(self.high)).withColumn("_c", every(self.wide))
        right = self.candidates.withColumn("_c", block(self.wide)).withColumn("_q", every(self.high))
        keys = ("dim", "_q", "_c")

        def cell(q: pa.Table, c: pa.Table) -> pa.Table:
            if not q.num_rows or not c.num_rows:
                return pa.table(compute(None, None, None))
            return pa.table(compute(q, c, _scores(q, c)))

        return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(cell, schema)


def _counted(q: pa.Table | None, c: pa.Table | None, scores: np.ndarray | None, n_bins: int) -> dict:
    """Histogram of each query's scores from ``low`` to below ``high``, in bins of ``width``, as far as it matters.

    Scores below the k-th of this block are left out: at least k in the block are higher, so the
    query's k-th score can't be among them. Those from ``high`` on were counted before.
    """
    if q is None:
        return {"vec_id": pa.array([], pa.int64()), "bin": pa.array([], pa.int32()), "n": pa.array([], pa.int64())}
    k, width = q["k"][0].as_py(), q["width"][0].as_py()
    low, high = q["low"].to_numpy()[:, None], q["high"].to_numpy()[:, None]
    inside = (scores >= low) & (scores < high)
    if scores.shape[1] > k:
        inside &= scores >= np.partition(scores, -k, axis=1)[:, -k][:, None]
    row, at = np.nonzero(inside)
    bins = (scores[row, at] - low[row, 0]) // width
    cells, n = np.unique(row * n_bins + bins, return_counts=True)
    return {
        "vec_id": pa.array(q["vec_id"].to_numpy()[cells // n_bins]),
        "bin": pa.array((cells % n_bins).astype(np.int32)),
        "n": pa.array(n.astype(np.int64)),
    }


def _chosen(q: pa.Table | None, c: pa.Table | None, scores: np.ndarray | None) -> dict:
    """Candidates above the k-th score, and of those that tie with it the first k by id."""
    if q is None:
        return {name: pa.array([], pa.int64()) for name in ("query_id", "vec_id", "score")}
    order = np.argsort(c["vec_id"].to_numpy(), kind="stable")
    scores, ids = scores[:, order], c["vec_id"].to_numpy()[order]
    k, least = q["k"][0].as_py(), q["low"].to_numpy()[:, None]
    tied = scores == least
    row, at = np.nonzero((scores > least) & (scores != OWN) | tied & (np.cumsum(tied, axis=1) <= k))
    return {
        "query_id": pa.array(q["vec_id"].to_numpy()[row]),
        "vec_id": pa.array(ids[at]),
        "score": pa.array(scores[row, at]),
    }


def top_k(queries: DataFrame, candidates: DataFrame, k: int = 20) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of the k highest scores of each query.

    Both sides come from :func:`quantised`. Ties go to the smaller id. A query has no row with its own
    id among its results. It gets all candidates if there are fewer than k, and none if there are none.
    Vectors are compared with vectors of their own dimension only. A repeated candidate row counts each
    time; a query id that occurs more than once is asked once, with its least vector. An empty table on
    either side gives an empty result. Scores have to fit into a long.
    """
    candidates = candidates.select("vec_id", "dim", "vector")
    asked = kept(queries.groupBy("vec_id").agg(F.min(F.struct("vector", "dim")).alias("_v")).select("vec_id", "_v.dim", "_v.vector"), "queries")
    sizes = candidates.agg(F.count(F.lit(1)).alias("n"), F.max(_norm()).alias("norm")).first()
    asked_sizes = asked.agg(F.count(F.lit(1)).alias("n"), F.max(_norm()).alias("norm")).first()
    reach = int((sizes.norm or 0) ** 0.5 * (asked_sizes.norm or 0) ** 0.5 * 1.000001) + 2  # no score is beyond
    grid = Grid(candidates, asked_sizes.n, sizes.n)

    if reach >= 1 << 61:
        raise ValueError("scores of these vectors don't fit into a long")
    span, n_bins = 2 * reach + 1, BINS
    # above: how many scores there are from high on.
    state = asked.select(
        "vec_id", *(F.lit(n).cast("long").alias(name) for name, n in (("low", -reach), ("high", reach + 1), ("above", 0)))
    )
    while span > 1:
        width = -(-span // n_bins)
        current = asked.join(state, "vec_id").select(
            "vec_id", "dim", "vector", F.lit(k).alias("k"), "low", "high", F.lit(width).cast("long").alias("width")
        )
        counts = grid.each_cell(current, lambda *cell: _counted(*cell, n_bins), "vec_id long, bin int, n long")
        counts = counts.groupBy("vec_id", "bin").agg(F.sum("n").alias("n"))
        upper = W.partitionBy("vec_id").orderBy(F.desc("bin")).rowsBetween(W.unboundedPreceding, 0)
        kth = (
            counts.join(state, "vec_id")
            .withColumn("_upto", F.sum("n").over(upper) + F.col("above"))  # at most n_bins rows a query
            .where(F.col("_upto") >= k)
            .groupBy(F.col("vec_id").alias("_vec_id"))
            .agg(F.max(F.struct("bin", (F.col("_upto") - F.col("n")).alias("above"))).alias("_kth"))
        )
        # A query with fewer than k scores has no k-th; then every score is wanted.
        start = F.col("low") + F.col("_kth.bin").cast("long") * width
        state = kept(
            state.join(kth, F.col("vec_id") == F.col("_vec_id"), "left").select(
                "vec_id",
                F.coalesce(start, F.col("low")).alias("low"),
                F.when(start.isNull(), F.col("low")).otherwise(F.least(start + width, F.col("high"))).alias("high"),
                F.coalesce(F.col("_kth.above"), F.col("above")).alias("above"),
            ),
            "kth-scores",
        )
        span = width

    current = asked.join(state, "vec_id").select("vec_id", "dim", "vector", F.lit(k).alias("k"), "low")
    rows = grid.each_cell(current, _chosen, "query_id long, vec_id long, score long")
    ranking = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        rows.withColumn("rank", F.row_number().over(ranking))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def _norm() -> F.Column:
    """Squared length of a vector, as a double."""
    return F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x)


#: ``op8`` in SQL.
TOP_K_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS DOUBLE)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id
  WHERE q.vec_id % 20 = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 20
"""
