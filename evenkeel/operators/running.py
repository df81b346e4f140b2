"""Running aggregates that do not put a whole group into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evenkeel.session import small_side

# How a running value is carried over a chunk border.
_COMBINE = {
    "sum": (F.sum, lambda a, b: F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0))),
    "count": (F.count, lambda a, b: F.coalesce(a, F.lit(0)) + b),
    "max": (F.max, lambda a, b: F.greatest(a, b)),
}


# Rows of a chunk, on average, and the most chunks that a group is cut into.
CHUNK_ROWS = 10_000
MOST_CHUNKS = 10_000


def _border_count(borders: Column, place: Column, most: int) -> Column:
    """How many of the ascending borders lie below a value, by halving."""

    def halve(state: Column) -> Column:
        middle = F.floor((state["low"] + state["high"]) / 2).cast("int")
        below = F.get(borders, middle) < place
        return F.when(state["low"] >= state["high"], state).otherwise(
            F.struct(
                F.when(below, middle + 1).otherwise(state["low"]).alias("low"),
                F.when(below, state["high"]).otherwise(middle).alias("high"),
            )
        )

    steps = F.sequence(F.lit(1), F.lit(max(1, most.bit_length() + 1)))
    start = F.struct(F.lit(0).alias("low"), F.size(borders).alias("high"))
    return F.aggregate(steps, start, lambda state, _: halve(state), lambda state: state["low"])


def with_chunks(df: DataFrame, group: list[str], order: str, chunk: Column | None = None) -> DataFrame:
    """Add ``_chunk``, which never falls as ``order`` rises; null where ``order`` is.

    Without an expression of the caller's, each group is cut at approximate
    quantiles of its order values into as many parts as it has ``CHUNK_ROWS``
    rows (``MOST_CHUNKS`` at most, which are longer then), so the chunks follow
    the rows however the values lie, be they epoch numbers, milliseconds or
    timestamps with outliers. Only one row per group is gathered.
    """
    if chunk is not None:
        return df.withColumn("_chunk", chunk)
    kind = df.schema[order].dataType.typeName()
    if kind == "date":
        value = F.unix_date(order)
    elif kind == "timestamp_ntz":
        value = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col(order))
    else:
        value = F.col(order)
    place = value.cast("double")
    known = df.where(F.col(order).isNotNull())
    keys = [F.col(g).alias(f"_s{g}") for g in group]
    sizes = small_side(known.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") > CHUNK_ROWS))
    longest = sizes.agg(F.coalesce(F.max("_n"), F.lit(0))).head()[0]
    parts = min(MOST_CHUNKS, -(-longest // CHUNK_ROWS))
    if parts < 2:
        return df.withColumn("_chunk", F.when(F.col(order).isNotNull(), F.lit(0)).cast("bigint"))
    same = F.lit(True)
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"_s{g}"))
    # every cut of the longest group is one of shorter ones too; how many of them a group takes follows its rows
    shares = F.array(*[F.lit(i / parts) for i in range(1, parts)])
    long_groups = known.join(sizes, same, "left_semi").groupBy(*keys).agg(
        F.count("*").alias("_n"), F.percentile_approx(place, shares, F.lit(max(10_000, 10 * parts))).alias("_cuts")
    )
    step = F.greatest(F.lit(1), F.floor(F.lit(longest) / F.col("_n"))).cast("int")
    cuts = small_side(
        long_groups.select(
            *[f"_s{g}" for g in group], F.array_distinct(F.filter("_cuts", lambda _, i: (i + 1) % step == 0)).alias("_cuts")
        )
    )
    found = F.coalesce(_border_count(F.col("_cuts"), place, parts), F.lit(0))
    return df.join(cuts, same, "left").withColumn(
        "_chunk", F.when(F.col(order).isNotNull(), found).cast("bigint")
    ).select(*df.columns, "_chunk")


def running_by_chunk(
    df: DataFrame,
    group: list[str],
    order: str,
    chunk: Column | None,
    values: dict[str, tuple[str, Column]],
) -> DataFrame:
    """Running ``sum``, ``count`` or ``max`` per group, in ascending ``order``.

    Each group is cut into chunks by ``chunk``, an expression that never falls
    as ``order`` rises, or by :func:`with_chunks`. Chunks are summed up first, the totals of the earlier
    chunks are carried forward over that small table, and the rows are walked
    within their chunk only. A group that holds a third of all rows is thus
    spread over as many tasks as it has chunks. Ties in ``order`` must have been
    removed by the caller. A null group is a group of its own; rows without an
    order value come back with null results and count for no other row.
    """
    work = with_chunks(df.where(F.col(order).isNotNull()), group, order, chunk)
    for name, (_, value) in values.items():
        work = work.withColumn(f"_v{name}", value)

    totals = work.groupBy(*group, "_chunk").agg(
        *[_COMBINE[kind][0](f"_v{name}").alias(f"_t{name}") for name, (kind, _) in values.items()]
    )
    before = Window.partitionBy(*group).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    # the count of nothing is 0 but a sum over nothing is null, so counts of
    # chunks are added up
    carried = totals.select(
        *group,
        "_chunk",
        *[
            (F.sum if kind == "count" else _COMBINE[kind][0])(f"_t{name}").over(before).alias(f"_c{name}")
            for name, (kind, _) in values.items()
        ],
    )
    inside = (
        Window.partitionBy(*group, "_chunk").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    )
    carried = carried.withColumnsRenamed({g: f"_g{g}" for g in group}).withColumnRenamed("_chunk", "_of_chunk")
    same = F.col("_chunk").eqNullSafe(F.col("_of_chunk"))
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"_g{g}"))
    out = work.join(carried, same)
    for name, (kind, _) in values.items():
        agg, combine = _COMBINE[kind]
        out = out.withColumn(name, combine(F.col(f"_c{name}"), agg(f"_v{name}").over(inside)))
    ordered = out.select(*df.columns, *values)
    unordered = df.where(F.col(order).isNull())
    return ordered.unionByName(unordered.select("*", *[F.lit(None).cast(ordered.schema[n].dataType).alias(n) for n in values]))
