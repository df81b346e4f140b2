"""Exact nearest neighbours and maximum cosine similarity."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evenkeel.operators.ranking import top_n_per_class
from evenkeel.session import SMALL_BYTES, SMALL_ROWS, cut_lineage, small_side

# Bytes of the vectors of a block, and entries of the distance matrix that are
# held at a time (of 8 bytes each).
BLOCK_BYTES = 8 * 1024 * 1024
STRIP_CELLS = 1024 * 1024
# Blocks smaller than this are not worth a task.
LEAST_BLOCK_ROWS = 1024
# Similarities are rounded, so that copies of a text tie wherever they are scored.
COSINE_DIGITS, DISTANCE_DIGITS = 12, 9
# Columns whose minimum is taken together where the closest entries are sought.
MINIMUM_OF = 64


def _matrix(vectors, unit: bool) -> np.ndarray:
    m = np.asarray(list(vectors), dtype=np.float64)
    if unit:
        norm = np.linalg.norm(m, axis=1, keepdims=True)
        m = np.divide(m, norm, out=np.zeros_like(m), where=norm > 0)
    return m


def _distances(xm: np.ndarray, ym: np.ndarray, unit: bool) -> np.ndarray:
    """Squared distances, or one minus the cosine for unit vectors.

    Rounded, so that equal vectors tie whatever the order of the sums was.
    """
    if unit:
        return np.round(np.maximum(1.0 - xm @ ym.T, 0.0), COSINE_DIGITS)
    d = (xm * xm).sum(1)[:, None] + (ym * ym).sum(1)[None, :] - 2.0 * (xm @ ym.T)
    return np.round(np.maximum(d, 0.0), DISTANCE_DIGITS)


def _smallest(d: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of the ``k`` smallest finite entries per row, ties by column."""
    k = min(k, d.shape[1])
    limit = np.partition(d, k - 1, axis=1)[:, k - 1 : k]
    rows, cols = np.nonzero((d <= limit) & np.isfinite(d))
    order = np.lexsort((cols, d[rows, cols], rows))
    rows, cols = rows[order], cols[order]
    place = np.arange(len(rows)) - np.searchsorted(rows, rows)
    return rows[place < k], cols[place < k]


def _closest(xm: np.ndarray, ym: np.ndarray, unit: bool, k: int, own: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, column and distance of the ``k`` closest pairs per row, ties by column, without those in ``own``.

    The same as :func:`_smallest` of :func:`_distances`, but only entries that may be among them are rounded and sorted:
    the ``k``-th least of the minima of groups of columns is no less than the ``k``-th least entry.
    """
    k = min(k, len(ym))
    d = xm @ ym.T
    if unit:
        np.subtract(1.0, d, out=d)
    else:
        d *= -2.0
        d += np.add.outer((xm * xm).sum(1), (ym * ym).sum(1))
    if own is not None:
        d[own] = np.inf
    least = np.minimum.reduceat(d, np.arange(0, len(ym), max(1, min(MINIMUM_OF, len(ym) // k))), axis=1)
    if np.isnan(least).any():
        d = _distances(xm, ym, unit)
        if own is not None:
            d[own] = np.inf
        rows, cols = _smallest(d, k)
        return rows, cols, d[rows, cols]
    digits = COSINE_DIGITS if unit else DISTANCE_DIGITS
    limit = np.maximum(np.partition(least, k - 1, axis=1)[:, k - 1 : k], 0.0) + 2 * 10.0**-digits
    rows, cols = np.nonzero(d <= limit)
    dist = np.round(np.maximum(d[rows, cols], 0.0), digits)
    order = np.lexsort((cols, dist, rows))
    order = order[np.isfinite(dist[order])]
    rows, cols, dist = rows[order], cols[order], dist[order]
    first = np.arange(len(rows)) - np.searchsorted(rows, rows) < k
    return rows[first], cols[first], dist[first]


def block_count(n: Column, width: int, block_rows: int, cores: int) -> Column:
    """Blocks for ``n`` vectors: of ``block_rows``, but no more than keep the cores busy, unless a block would be too large."""
    most_rows = max(1, BLOCK_BYTES // (8 * max(1, width)))
    busy = math.ceil(math.sqrt(2 * cores))
    return F.greatest(F.ceil(n / most_rows), F.least(F.lit(busy), F.ceil(n / block_rows)))


def nearest(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    vec: str,
    k: int,
    by: str | None = None,
    metric: str = "l2",
    block_rows: int | None = None,
    skip_self: bool = False,
) -> DataFrame:
    """The ``k`` closest rows of ``right`` for each row of ``left``, exactly.

    ``metric`` is ``l2`` (squared distance) or ``cosine`` (one minus the
    cosine). Both sides are cut into blocks, per class if ``by`` is given, and
    each pair of blocks is compared in one task, strip by strip. A block pair
    gives back ``k`` rows per left row and no more; these are merged afterwards.
    Each side is sent once per block of the other, so blocks are as large as
    ``BLOCK_BYTES`` allows, but small enough to keep all cores busy. With
    ``block_rows``, blocks are that small, unless there would be more of them
    than keep all cores busy. Memory per task is bounded by the block and not by
    the class. Result: left key, ``neighbors`` as an array of ``(dist, id)``
    ascending, ties by id.
    """
    groups = ["g"] if by else []
    group_of = [F.col(by).alias("g")] if by else []

    first = right.select(F.size(vec)).head()
    cores = left.sparkSession.sparkContext.defaultParallelism
    n_blocks = block_count(F.count("*"), first[0] if first else 1, block_rows or LEAST_BLOCK_ROWS, cores)

    def sizes(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(*group_of).agg(n_blocks.cast("int").alias(name))

    if by:
        blocks = small_side(sizes(left, "_lb").join(sizes(right, "_rb"), "g"))
    else:
        n_left, n_right = sizes(left, "n").head()[0], sizes(right, "n").head()[0]
        blocks = None

    def cut(df: DataFrame, key: str, own: str, other: str, own_id: str, other_id: str) -> DataFrame:
        slim = df.select(*group_of, F.col(key).alias("id"), F.col(vec).alias("vec"))
        if by:
            slim = slim.join(blocks, "g")
        else:
            slim = slim.withColumn("_lb", F.lit(n_left)).withColumn("_rb", F.lit(n_right))
        # both sides need the same type here: an int and a bigint hash differently
        return slim.select(
            *groups,
            "id",
            "vec",
            F.pmod(F.xxhash64("id"), F.col(own)).cast("int").alias(own_id),
            F.explode(F.sequence(F.lit(0), (F.col(other) - 1).cast("int"))).alias(other_id),
        )

    a = cut(left, left_key, "_lb", "_rb", "l", "r")
    b = cut(right, right_key, "_rb", "_lb", "r", "l")
    out_type = T.StructType(
        [T.StructField("g", left.schema[by].dataType) for _ in groups]
        + [
            T.StructField("id", left.schema[left_key].dataType),
            T.StructField("neighbor", right.schema[right_key].dataType),
            T.StructField("dist", T.DoubleType()),
        ]
    )

    unit = metric == "cosine"

    def pair(x: pd.DataFrame, y: pd.DataFrame) -> pd.DataFrame:
        if x.empty or y.empty:
            return pd.DataFrame({f.name: [] for f in out_type.fields})
        y = y.sort_values("id", kind="stable")
        xm, ym = _matrix(x["vec"], unit), _matrix(y["vec"], unit)
        xid, yid = x["id"].to_numpy(), y["id"].to_numpy()
        parts = []
        strip = max(1, STRIP_CELLS // len(yid))
        for start in range(0, len(xid), strip):
            ids = xid[start : start + strip]
            own = ids[:, None] == yid[None, :] if skip_self else None
            rows, cols, dist = _closest(xm[start : start + strip], ym, unit, k, own)
            parts.append(pd.DataFrame({"id": ids[rows], "neighbor": yid[cols], "dist": dist}))
        out = pd.concat(parts)
        if by:
            out["g"] = x["g"].iloc[0]
        return out[[f.name for f in out_type.fields]]

    keys = [*groups, "l", "r"]
    found = a.groupBy(*keys).cogroup(b.groupBy(*keys)).applyInPandas(pair, out_type)
    # at most k rows per left row and block
    ranked = F.sort_array(F.collect_list(F.struct("dist", F.col("neighbor").alias("id"))))
    return (
        found.groupBy(*groups, "id")
        .agg(F.slice(ranked, 1, k).alias("neighbors"))
        .select(*([F.col("g").alias(by)] if by else []), F.col("id").alias(left_key), "neighbors")
    )


def max_cosine(
    df: DataFrame,
    ref: DataFrame,
    vec: str,
    key: str,
    out: str = "sim_score",
    max_ref_rows: int = SMALL_ROWS,
    max_ref_bytes: int = SMALL_BYTES,
    recall: float | None = None,
) -> DataFrame:
    """Highest cosine similarity of each row of ``df`` to any row of ``ref``.

    A zero vector has similarity 0 to everything, a null vector none (null), and
    null vectors of the reference set are passed over. Each row of ``df`` gets a
    score, whether its key is null, repeated or neither.

    The reference set is counted and measured first. Within the bounds it is sent
    to the executors once and each batch of rows is one matrix product, without a
    shuffle; a larger one goes block by block through :func:`nearest`. Both ways
    give the same scores. With ``recall``, a larger one is searched in hashed
    buckets, whose recall on a sample is at least that.
    """
    vectors = ref.select(F.col(vec).cast("array<double>").alias("v")).where(F.col("v").isNotNull())
    size = vectors.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(8 * F.size("v")), F.lit(0)).alias("bytes")).head()
    if size["rows"] == 0:
        return df.withColumn(out, F.lit(None).cast("double"))
    if size["rows"] <= max_ref_rows and size["bytes"] <= max_ref_bytes:
        rows = vectors.toArrow()
        matrix = df.sparkSession.sparkContext.broadcast(_matrix(rows.column("v").to_pylist(), unit=True))

        @F.pandas_udf(T.DoubleType())
        def best(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            refs = matrix.value
            for batch in batches:
                there = batch.notna().to_numpy()
                if not there.any():
                    yield pd.Series(np.full(len(batch), np.nan)).astype(object).where(there, None)
                    continue
                m = _matrix(batch[there], unit=True)
                top = np.empty(len(m))
                strip = max(1, STRIP_CELLS // len(refs))
                for at in range(0, len(m), strip):
                    top[at : at + strip] = (m[at : at + strip] @ refs.T).max(axis=1)
                scores = pd.Series([None] * len(batch), dtype=object)
                scores[there] = np.round(top, COSINE_DIGITS)
                yield scores

        # not to be computed a second time by a filter on the score
        return df.withColumn(out, best.asNondeterministic()(F.col(vec).cast("array<double>")))
    # rows are known by a number of their own, given once
    rows = cut_lineage(df.withColumn("_row", F.monotonically_increasing_id()))
    others = vectors.select(F.col("v").alias(vec), F.xxhash64("v").alias("_row"))
    if recall is None:
        closest = nearest(rows.where(F.col(vec).isNotNull()), others, "_row", "_row", vec, 1, metric="cosine")
    else:
        from evenkeel.operators.approximate import hashed_nearest

        closest, _, _ = hashed_nearest(rows, others.dropDuplicates(["_row"]), "_row", "_row", vec, 1, recall)
    score = F.round(1.0 - F.col("neighbors")[0]["dist"], COSINE_DIGITS)
    return rows.join(closest.select("_row", score.alias(out)), "_row", "left").select(*df.columns, out)


def select_similar(
    candidates: DataFrame,
    ref: DataFrame,
    n_per_class: dict[int, int],
    key: str,
    label: str = "label",
    vec: str = "vec",
    score: str = "sim_score",
) -> DataFrame:
    """The candidates of each class that come closest to the reference set."""
    scored = max_cosine(candidates.where(F.col(label).isin(*n_per_class)), ref, vec, key, out=score)
    return top_n_per_class(scored, label, score, n_per_class, key)
