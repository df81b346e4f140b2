"""Approximate nearest neighbours by counting collisions around the query on single projections.

Vectors are dealt into blocks; a task holds one block of vectors and one block of queries. Each random projection
of a block is a sorted array. A query starts with a narrow window around its own value on every array and widens
them level by level (virtual rehashing); a vector that lies in the windows of at least half of the arrays is verified
with the exact measure. A query is done when a vector as near as its k-th best would have been counted often enough.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Projections, the share of them whose windows a vector must lie in, and how the windows grow from what to what.
PROJECTIONS, SHARE, GROWTH, FIRST = 64, 0.5, 1.25, 0.1
#: Standard deviations by which the count of a vector at the k-th distance is expected to pass the threshold.
CERTAINTY = 2.0
#: Rows of a block; a task holds one of each kind (17 MB each for 64 doubles).
BLOCK, QUERY_BLOCK = 32_768, 32_768


def _collision(width: float, distance: float) -> float:
    """Chance that a projection moves by at most ``width`` over ``distance``."""
    return math.erf(width / (max(distance, 1e-12) * math.sqrt(2)))


class SortedProjections:
    """The projections of one block of unit vectors, sorted."""

    def __init__(self, vectors: np.ndarray, projections: int):
        self.n, self.m = len(vectors), projections
        self.lines = np.random.default_rng(vectors.shape[1]).standard_normal((vectors.shape[1], projections))
        values = vectors @ self.lines
        self.order = np.argsort(values, axis=0, kind="stable").T.astype(np.int32).copy()
        self.values = np.take_along_axis(values.T, self.order.astype(np.int64), axis=1)

    def search(self, query: np.ndarray, k: int, distance) -> tuple[np.ndarray, np.ndarray]:
        """Verified rows and their distances to a unit query; ``distance(rows)`` verifies."""
        centre = query @ self.lines
        low = np.array([np.searchsorted(v, c) for v, c in zip(self.values, centre)])
        high, counts = low.copy(), np.zeros(self.n, np.int32)
        verified, near, far = np.zeros(self.n, bool), [], []
        width, needed, best = FIRST, math.ceil(SHARE * self.m), math.inf
        while True:
            fresh = []
            for j in range(self.m):
                a = np.searchsorted(self.values[j, : low[j]], centre[j] - width, "left")
                b = high[j] + np.searchsorted(self.values[j, high[j] :], centre[j] + width, "right")
                fresh += [self.order[j, a : low[j]], self.order[j, high[j] : b]]
                low[j], high[j] = a, b
            counts += np.bincount(np.concatenate(fresh), minlength=self.n).astype(np.int32)
            rows = np.flatnonzero((counts >= needed) & ~verified)
            if len(rows):
                verified[rows] = True
                near.append(rows)
                far.append(distance(rows))
                every = np.concatenate(far)
                best = np.partition(every, k - 1)[k - 1] if len(every) >= k else math.inf
            if all(low == 0) and all(high == self.n):
                break
            if best < math.inf:
                p = _collision(width, best)
                if p * self.m - CERTAINTY * math.sqrt(self.m * p * (1 - p)) >= needed:
                    break
            width *= GROWTH
        none = np.zeros(0, np.int64)
        return (np.concatenate(near), np.concatenate(far)) if near else (none, none.astype(float))


def _matrix(column: pa.ChunkedArray, n: int) -> np.ndarray:
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(n, -1)


def _scaled(vectors: np.ndarray) -> np.ndarray:
    """Each vector times a power of two that brings its largest component to between 0.5 and 1.

    No cosine changes, and no square over- or underflows.
    """
    _, power = np.frexp(np.abs(vectors).max(axis=1))
    return np.ldexp(vectors, -power[:, None])


def _norms(vectors: np.ndarray) -> np.ndarray:
    return np.sqrt(np.einsum("ij,ij->i", vectors, vectors))


def search_block(ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int, projections: int):
    """``(query row, vector row, cosine)`` of the up to ``k`` nearest vectors found in one block for each query.

    Vectors with the query's id are its own and left out; equal cosines go to the smaller id, a null id (the largest
    number) last. Components of any finite size are welcome.
    """
    vectors, queries = _scaled(vectors), _scaled(queries)
    size, query_size = _norms(vectors), _norms(queries)
    index = SortedProjections(vectors / size[:, None], projections)
    for i in range(len(queries)):
        own = ids == query_ids[i]

        def cosine(rows: np.ndarray, i=i) -> np.ndarray:
            return np.einsum("ij,j->i", vectors[rows], queries[i]) / (size[rows] * query_size[i])

        def distance(rows: np.ndarray, own=own, cosine=cosine) -> np.ndarray:
            return np.where(own[rows], np.inf, np.sqrt(np.maximum(0.0, 2 - 2 * cosine(rows))))

        rows, _ = index.search(queries[i] / query_size[i], k, distance)
        rows = rows[~own[rows]]
        score = cosine(rows)
        for at in np.lexsort((ids[rows], -score))[:k]:
            yield i, int(rows[at]), float(score[at])


def _numbers(n: int) -> Column:
    return F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint"))


def usable(vector: Column) -> Column:
    """Whether a vector has components, all of them finite, and one that is not zero."""
    wide = vector.cast("array<double>")
    finite = F.forall(wide, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(wide, lambda x: x != 0), F.lit(False))


def nearest(
    vectors: DataFrame, queries: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 5,
    projections: int = PROJECTIONS, block: int = BLOCK, query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's ``k`` nearest found by cosine, nearest first.

    Ties go to the smaller id. Vectors that are null, empty, zero or hold null or non-finite components take no part on
    either side; vectors of different lengths are never compared. All rows with the query's id count as the query
    itself. A query with fewer candidates gets them all, one without any has no rows. Repeated rows of other ids are
    candidates each; of query rows with one id the least vector asks. Other columns, whatever their names, are not read. Each side is copied once per block of the
    other, and each block gives back at most ``k`` rows per query.
    """

    def side(df: DataFrame) -> DataFrame:
        return df.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).alias("v")).where(usable(F.col("v")))

    data = side(vectors)
    asked = side(queries).where("id IS NOT NULL").groupBy("id").agg(F.min("v").alias("v"))
    n = max(1, -(-data.count() // block))
    m = max(1, -(-asked.count() // query_block))
    data = data.select(
        "id", "v", F.size("v").alias("dim"), F.pmod(F.xxhash64("id", "v"), F.lit(n)).alias("b"),
        F.explode(_numbers(m)).alias("q"),
    )
    asked = asked.select(
        "id", "v", F.size("v").alias("dim"), F.explode(_numbers(n)).alias("b"),
        F.pmod(F.xxhash64("id", "v"), F.lit(m)).alias("q"),
    )

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        found = []
        if left.num_rows and right.num_rows:
            last = np.iinfo(np.int64).max
            ids = left.column("id").fill_null(last).to_numpy()
            query_ids = right.column("id").to_numpy()
            rows = search_block(
                ids, _matrix(left.column("v"), left.num_rows), query_ids, _matrix(right.column("v"), right.num_rows), k, projections
            )
            found = [(int(query_ids[i]), None if ids[j] == last else int(ids[j]), s) for i, j, s in rows]
        columns = list(zip(*found)) or [(), (), ()]
        types = (pa.int64(), pa.int64(), pa.float64())
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["query_id", "vec_id", "score"])

    keys = ("dim", "b", "q")
    found = data.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(run, "query_id bigint, vec_id bigint, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
