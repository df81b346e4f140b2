"""Approximate nearest neighbours with a measured recall: hashed buckets by random planes, inverted lists by centroids.

Both deal rows into groups and search group by group with :func:`evenkeel.operators.similarity.nearest`, which cuts large
groups into blocks, so a bucket of copies is no single task and no list of pairs. How many buckets or lists are searched
follows from the recall on a sample of rows that are also searched exactly; if all steps fall short, and for rows that
have found too few, the exact search is taken. Large groups with many lists have further steps: recall falls as lists grow
in number, and some more of them cost less than all rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenkeel.functions.binding import let
from evenkeel.operators import similarity
from evenkeel.operators.sampling import SEED
from evenkeel.operators.similarity import STRIP_CELLS, nearest
from evenkeel.session import cut_lineage, small_side

#: Rows whose neighbours are also searched exactly, to measure the recall.
SAMPLE = 200
#: Rows per bucket or list that are aimed at, and steps of tables or lists that are tried.
BUCKET_ROWS = 512
TABLES, PROBES = (4, 8, 16, 32), (2, 4, 8, 16)
#: After the last of ``PROBES``, twice as many lists are tried as long as they are no more than this share of a group's lists.
MOST_SHARE = 1 / 4
#: Bytes of vectors that a task of the search in lists gets.
TASK_BYTES = 128 * 1024 * 1024
#: Rows per list of the sample that centroids are fitted on, rounds of fitting, and the most lists of a group.
FIT_ROWS, FIT_ROUNDS, MOST_LISTS = 64, 10, 4096
#: Distances that differ by less count as equal when recall is measured.
CLOSE = 1e-9


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _unit(x: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    return np.divide(x, norm, out=np.zeros_like(x), where=norm > 0)


def _nearest_lists(x: np.ndarray, centres: np.ndarray, n: int) -> Iterator[tuple[int, np.ndarray]]:
    """First row of a strip of ``x``, and the ``n`` nearest centres of its rows; a strip has ``STRIP_CELLS`` distances at most."""
    size = (centres**2).sum(1)
    strip = max(1, STRIP_CELLS // len(centres))
    for at in range(0, len(x), strip):
        far = size - 2 * x[at : at + strip] @ centres.T
        if n == 1:
            yield at, far.argmin(1)[:, None]
        elif n < len(centres) and np.isfinite(far).all():
            yield at, similarity._smallest(far, n)[1].reshape(-1, n)
        else:
            yield at, np.argsort(far, axis=1, kind="stable")[:, :n]


def sample_by_key(df: DataFrame, key: str, n: int, seed: int = SEED) -> DataFrame:
    """``n`` rows at most, the same ones under any partitioning."""
    return df.orderBy(F.xxhash64(F.lit(seed), F.col(key)), F.col(key)).limit(n)


def merged(found: DataFrame, key: str, k: int) -> DataFrame:
    """The ``k`` nearest of each row over all groups that it was searched in; a neighbour found twice counts once."""
    each = found.select(F.col(key).alias("_of"), F.explode("neighbors").alias("_n")).groupBy("_of", F.col("_n.id").alias("_nid"))
    ranked = F.sort_array(F.collect_list(F.struct("dist", F.col("_nid").alias("id"))))
    nearest_first = each.agg(F.min("_n.dist").alias("dist")).groupBy("_of").agg(F.slice(ranked, 1, k).alias("neighbors"))
    return nearest_first.withColumnRenamed("_of", key)


def measured_recall(exact: DataFrame, found: DataFrame, key: str) -> float:
    """Share of the exact neighbours that were found, or others at the same distance."""
    far = F.array_max(F.transform("neighbors", lambda n: n["dist"]))
    wanted = exact.select(key, F.size("neighbors").alias("_n"), far.alias("_far"))
    near = F.size(F.filter("neighbors", lambda n: n["dist"] <= F.col("_far") + CLOSE))
    row = wanted.join(found, key, "left").agg(F.sum("_n"), F.sum(F.coalesce(F.least(near, F.col("_n")), F.lit(0)))).head()
    return 1.0 if not row[0] else row[1] / row[0]


def _bucket_of(planes: np.ndarray, tables: int, bits: int) -> Callable[[Column], Column]:
    @F.arrow_udf("array<bigint>")
    def of(vectors: pa.Array) -> pa.Array:
        side = (_matrix(vectors) @ planes[:, : tables * bits] > 0).reshape(len(vectors), tables, bits)
        number = side @ (1 << np.arange(bits)) + (np.arange(tables) << bits)
        return pa.ListArray.from_arrays(pa.array(np.arange(0, number.size + 1, tables), pa.int32()), pa.array(number.ravel(), pa.int64()))

    return of


def _settled(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str, vec: str, k: int, by: str | None, metric: str, skip_self: bool,
    recall: float, steps, search: Callable[[DataFrame, int], DataFrame], seed: int,
    trial: Callable[[DataFrame], Callable[[int], DataFrame]] | None = None,
) -> tuple[DataFrame, float, int | None]:
    """Search with the first step whose recall on a sample is enough, exactly where none is.

    ``trial`` searches the sample once and gives back what each step finds; without it, each step searches.
    """

    def exactly(rows: DataFrame) -> DataFrame:
        out = nearest(rows, right, left_key, right_key, vec, k, by=by, metric=metric, skip_self=skip_self)
        return out.select(left_key, "neighbors")

    some = cut_lineage(sample_by_key(left, left_key, SAMPLE, seed))
    wanted = cut_lineage(exactly(some))
    tried = trial(some) if trial else lambda step: search(some, step)
    for step in steps:
        reached = measured_recall(wanted, tried(step), left_key)
        if reached >= recall:
            found = cut_lineage(search(left, step))
            # every row that has k others in reach gets k neighbours
            full = found.where(F.size("neighbors") >= k).select(left_key)
            short = left.join(full, left_key, "left_anti")
            return found.where(F.size("neighbors") >= k).unionByName(exactly(short)), reached, step
    return exactly(left), 1.0, None


def hashed_nearest(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str, vec: str, k: int, recall: float = 0.9, skip_self: bool = False,
    bits: int | None = None, seed: int = SEED,
) -> tuple[DataFrame, float, int | None]:
    """The ``k`` nearest rows of ``right`` by cosine, found in buckets of random planes.

    Gives back ``left_key, neighbors`` as :func:`nearest` does, the recall on the sample, and the number of tables (None
    for the exact search). Two vectors at an angle ``a`` share a bucket of ``b`` bits with a chance of
    ``(1 - a / pi) ** b``; the tables are independent. Keys must be unique; rows with null vectors take no part.
    """
    left, right = (
        cut_lineage(df.select(key, F.col(vec).cast("array<double>").alias(vec)).where(F.col(vec).isNotNull()))
        for df, key in ((left, left_key), (right, right_key))
    )
    first = right.select(F.size(vec)).head()
    if first is None or not first[0]:
        return nearest(left, right, left_key, right_key, vec, k, metric="cosine", skip_self=skip_self), 1.0, None
    if bits is None:
        bits = min(40, max(1, math.ceil(math.log2(max(2, right.count() / BUCKET_ROWS)))))
    planes = np.random.default_rng(seed).standard_normal((first[0], max(TABLES) * bits))

    def search(rows: DataFrame, tables: int) -> DataFrame:
        of = _bucket_of(planes, tables, bits)
        a, b = (df.select("*", F.explode(of(F.col(vec))).alias("_bucket")) for df in (rows, right))
        found = nearest(a, b, left_key, right_key, vec, k, by="_bucket", metric="cosine", skip_self=skip_self)
        return merged(found, left_key, k)

    return _settled(left, right, left_key, right_key, vec, k, None, "cosine", skip_self, recall, TABLES, search, seed)


def _centroids(rows: DataFrame, key: str, by: str, vec: str, unit: bool, seed: int) -> DataFrame:
    """``(by, list, centroid)``: centroids of each group, fitted on a sample of ``FIT_ROWS`` rows per list."""
    sizes = rows.groupBy(by).agg(F.count("*").alias("_n"))
    lists = F.least(F.lit(MOST_LISTS), F.greatest(F.lit(1), F.ceil(F.sqrt("_n")))).cast("int")
    sizes = cut_lineage(sizes.select(F.col(by).alias("_by"), lists.alias("_lists"), "_n"))
    draw = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}|"), F.col(key).cast("string"))), 1, 13), 16, 10).cast("double") / float(16**13)
    chosen = rows.join(F.broadcast(sizes), F.col(by) == F.col("_by")).where(draw <= F.lit(FIT_ROWS) * F.col("_lists") / F.col("_n"))
    kind = dict(rows.dtypes)[by]

    def fit(part: pa.Table) -> pa.Table:
        part = part.sort_by(key)
        x = _matrix(part.column(vec).combine_chunks())
        if unit:
            x = _unit(x)
        n = min(len(x), part.column("_lists")[0].as_py())
        centres = x[np.random.default_rng(seed).choice(len(x), n, replace=False)]
        for _ in range(FIT_ROUNDS):
            own = np.concatenate([near[:, 0] for _, near in _nearest_lists(x, centres, 1)])
            counts = np.bincount(own, minlength=n)
            sums = np.zeros_like(centres)
            np.add.at(sums, own, x)
            centres = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centres)
        group = pa.concat_arrays([part.column(by).slice(0, 1).combine_chunks()] * n)
        return pa.table({by: group, "list": pa.array(range(n), pa.int32()), "centroid": pa.array(list(centres), pa.list_(pa.float64()))})

    slim = chosen.select(by, key, vec, "_lists")
    return slim.groupBy(by).applyInArrow(fit, f"`{by}` {kind}, list int, centroid array<double>")


def _same(ids: pa.Array, others: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of equal ids, none of them null; ``others`` is ascending, nulls last."""
    at = np.flatnonzero(np.asarray(ids.is_valid()))
    a, b = (x.drop_null().to_numpy(zero_copy_only=False) for x in (ids, others))
    first, end = np.searchsorted(b, a, "left"), np.searchsorted(b, a, "right")
    n = end - first
    row = np.repeat(np.arange(len(a)), n)
    return at[row], np.arange(len(row)) - (np.cumsum(n) - n)[row] + first[row]


def _closest_unit(xm: np.ndarray, ym: np.ndarray, y4: np.ndarray, k: int, own: tuple | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What :func:`evenkeel.operators.similarity._closest` gives for unit vectors; ``y4`` is ``ym`` in single precision.

    Products in single precision leave out what cannot be among the closest, within the bound of their error; the
    distances are those of double precision.
    """
    k = min(k, len(ym))
    s = xm.astype(np.float32) @ y4.T
    if own is not None:
        s[own] = -np.inf
    best = np.maximum.reduceat(s, np.arange(0, len(ym), max(1, min(similarity.MINIMUM_OF, len(ym) // k))), axis=1)
    if np.isnan(best).any():
        return similarity._closest(xm, ym, True, k, own)
    # a product of unit vectors is off by (width + 4) * 2**-24 at most, and so are the limit and the entry
    slack = np.float32((ym.shape[1] + 4) * 2.0**-22)
    at = best.shape[1] - k
    limit = np.minimum(np.partition(best, at, axis=1)[:, at : at + 1], np.float32(1.0)) - slack
    # several times faster than the places of a matrix
    place = np.flatnonzero(s >= limit)
    rows, cols = np.divmod(place[s.ravel()[place] > -np.inf], len(ym))
    dist = np.empty(len(rows))
    for i in range(0, len(rows), step := max(1, STRIP_CELLS // max(1, ym.shape[1]))):
        dist[i : i + step] = 1.0 - np.einsum("ij,ij->i", xm[rows[i : i + step]], ym[cols[i : i + step]])
    dist = np.round(np.maximum(dist, 0.0), similarity.COSINE_DIGITS)
    order = np.lexsort((cols, dist, rows))
    rows, cols, dist = rows[order], cols[order], dist[order]
    first = np.arange(len(rows)) - np.searchsorted(rows, rows) < k
    return rows[first], cols[first], dist[first]


def _in_lists(left: DataFrame, right: DataFrame, k: int, unit: bool, skip_self: bool) -> DataFrame:
    """``(id, _place, neighbors)``: the ``k`` closest rows of ``right`` in each list that a row of ``left`` is sent to.

    Both sides have ``g, _list, id, vec``, and ``left`` the place of the list in the row's order. A list is one group of
    rows; only where a side has more vectors than ``BLOCK_BYTES``, it is cut into blocks by the hash of the id.
    """
    first = right.select(F.size("vec")).head()
    width = max(1, first[0] if first else 1)

    def sizes(df: DataFrame, name: str) -> DataFrame:
        blocks = F.ceil(F.count("*") / max(1, similarity.BLOCK_BYTES // (8 * width))).cast("int")
        return df.groupBy("g", "_list").agg(blocks.alias(name), F.count("*").alias(f"{name}_n"))

    blocks = small_side(sizes(left, "_lb").join(sizes(right, "_rb"), ["g", "_list"]))
    sent = blocks.agg(F.sum(F.col("_lb_n") * F.col("_rb") + F.col("_rb_n") * F.col("_lb"))).head()[0] or 0
    parts = math.ceil(sent * 8 * width / TASK_BYTES)
    keys = ["g", "_list", "l", "r"]

    def cut(df: DataFrame, own: str, other: str, own_id: str, other_id: str) -> DataFrame:
        out = df.join(blocks.select("g", "_list", "_lb", "_rb"), ["g", "_list"]).select(
            *df.columns,
            # both sides need the same type here: an int and a bigint hash differently
            F.pmod(F.xxhash64("id"), F.col(own)).cast("int").alias(own_id),
            F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(other_id),
        )
        # tasks of bounded size, however few partitions the session has
        wanted = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        return out.repartition(parts, *keys) if parts > wanted else out

    kinds = {name: df.schema["id"].dataType.simpleString() for name, df in (("left", left), ("right", right))}

    def pair(x: pa.Table, y: pa.Table) -> pa.Table:
        y = y.sort_by("id")
        xid, yid = (t.column("id").combine_chunks() for t in (x, y))
        neighbor = pa.struct([("dist", pa.float64()), ("id", yid.type)])
        if not (x.num_rows and y.num_rows):
            return pa.table({"id": xid[:0], "_place": pa.array([], pa.int32()), "neighbors": pa.array([], pa.list_(neighbor))})
        xm, ym = (_matrix(t.column("vec").combine_chunks()) for t in (x, y))
        if unit:
            xm, ym = _unit(xm), _unit(ym)
            y4 = ym.astype(np.float32)
        found = []
        strip = max(1, STRIP_CELLS // len(yid))
        for at in range(0, len(xid), strip):
            own = _same(xid[at : at + strip], yid) if skip_self else None
            part = xm[at : at + strip]
            rows, cols, dist = _closest_unit(part, ym, y4, k, own) if unit else similarity._closest(part, ym, False, k, own)
            found.append((rows + at, cols, dist))
        rows, cols, dist = (np.concatenate(part) for part in zip(*found))
        # rows that share an id have k neighbours together
        code = xid.dictionary_encode("encode").indices.to_numpy()
        n = code.max() + 1
        place = np.full(n, np.iinfo(np.int32).max, np.int32)
        np.minimum.at(place, code, x.column("_place").to_numpy())
        first_row = np.empty(n, np.int64)
        first_row[code[::-1]] = np.arange(len(code))[::-1]
        of = code[rows]
        if n < len(code):
            order = np.lexsort((cols, dist, of))
            of, cols, dist = of[order], cols[order], dist[order]
            few = np.arange(len(of)) - np.searchsorted(of, of) < k
            of, cols, dist = of[few], cols[few], dist[few]
        values = pa.StructArray.from_arrays([pa.array(dist), yid.take(pa.array(cols))], fields=list(neighbor))
        ends = np.concatenate([[0], np.cumsum(np.bincount(of, minlength=n))])
        neighbors = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)
        return pa.table({"id": xid.take(pa.array(first_row)), "_place": pa.array(place), "neighbors": neighbors})

    a, b = cut(left, "_lb", "_rb", "l", "r"), cut(right, "_rb", "_lb", "r", "l")
    out = f"id {kinds['left']}, _place int, neighbors array<struct<dist: double, id: {kinds['right']}>>"
    return a.groupBy(*keys).cogroup(b.groupBy(*keys)).applyInArrow(pair, out).where(F.size("neighbors") > 0)


def _merged_lists(found: DataFrame, key: str, k: int) -> DataFrame:
    """As :func:`merged`, within the row: one shuffle, of lists of neighbours."""

    def once(s: Column) -> Column:
        return F.filter(s, lambda n, i: (i == 0) | ~n["id"].eqNullSafe(F.get(s, i - 1)["id"]))

    by_id = F.sort_array(F.transform(F.flatten(F.collect_list("neighbors")), lambda n: F.struct(n["id"].alias("id"), n["dist"].alias("dist"))))
    grouped = found.groupBy(key).agg(by_id.alias("_all"))
    ranked = F.sort_array(F.transform(let(F.col("_all"), once), lambda n: F.struct(n["dist"].alias("dist"), n["id"].alias("id"))))
    return grouped.select(key, F.slice(ranked, 1, k).alias("neighbors"))


def listed_nearest(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str, vec: str, k: int, by: str, metric: str = "l2",
    recall: float = 0.9, skip_self: bool = False, seed: int = SEED,
) -> tuple[DataFrame, float, int | None]:
    """The ``k`` nearest rows of ``right`` in the same group ``by``, found in inverted lists.

    Each row of ``right`` lies in the list of its nearest centroid and is sent there once; a row of ``left`` is sent to
    the lists of its nearest few centroids, and is searched there. Gives back ``left_key, neighbors``, the recall on the
    sample, and the number of lists searched (None for the exact search). The centroids, about the square root of a
    group's rows and no more than ``MOST_LISTS``, are fitted on a sample and sent to every task. Keys must be unique;
    rows without a group or a vector take no part.
    """
    left, right = (
        cut_lineage(df.select(key, by, F.col(vec).cast("array<double>").alias(vec)).where(F.col(vec).isNotNull() & F.col(by).isNotNull()))
        for df, key in ((left, left_key), (right, right_key))
    )
    unit = metric == "cosine"
    group = F.col(by).cast("string")
    rows = cut_lineage(_centroids(right, right_key, by, vec, unit, seed)).select(group.alias("g"), "list", "centroid").collect()
    groups: dict = {}
    for r in rows:
        groups.setdefault(r["g"], []).append((r["list"], r["centroid"]))
    held = left.sparkSession.sparkContext.broadcast({g: np.array([c for _, c in sorted(lists)]) for g, lists in groups.items()})
    most = max(map(len, groups.values()), default=0)
    steps = list(PROBES)
    while steps[-1] * 2 <= most * MOST_SHARE:
        steps.append(steps[-1] * 2)

    def lists_of(probes: int) -> Column:
        """The nearest ``probes`` lists of a row, nearest first."""

        @F.arrow_udf("array<int>")
        def of(vectors: pa.Array, group: pa.Array) -> pa.Array:
            codes = group.dictionary_encode()
            code, out = codes.indices.to_numpy(), np.full((len(vectors), probes), -1, np.int32)
            for c, g in enumerate(codes.dictionary.to_pylist()):
                centres = held.value.get(g)
                if centres is None:
                    continue
                own = np.flatnonzero(code == c)
                x = _matrix(vectors.take(pa.array(own)))
                for at, near in _nearest_lists(_unit(x) if unit else x, centres, probes):
                    out[own[at : at + len(near)], : near.shape[1]] = near
            ends = np.cumsum((out >= 0).sum(1))
            return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(out[out >= 0], pa.int32()))

        return of(F.col(vec), group)

    # a row of the right side lies in one list, of the left side in several; the places say how near they are
    filed = cut_lineage(right.select(group.alias("g"), F.explode(lists_of(1)).alias("_list"), F.col(right_key).alias("id"), F.col(vec).alias("vec")))

    def in_lists(some: DataFrame, probes: int) -> DataFrame:
        slim = cut_lineage(some.select(group.alias("g"), F.col(left_key).alias("id"), F.col(vec).alias("vec"), lists_of(probes).alias("_lists")))
        asked = slim.select("g", F.posexplode("_lists").alias("_place", "_list"), "id", "vec")
        return _in_lists(asked, filed, k, unit, skip_self).withColumnRenamed("id", left_key)

    def trial(some: DataFrame) -> Callable[[int], DataFrame]:
        each = cut_lineage(in_lists(some, steps[-1]))
        return lambda probes: _merged_lists(each.where(F.col("_place") < probes), left_key, k)

    def search(some: DataFrame, probes: int) -> DataFrame:
        return _merged_lists(in_lists(some, probes), left_key, k)

    return _settled(left, right, left_key, right_key, vec, k, by, metric, skip_self, recall, steps, search, seed, trial)
