"""Exact-size samples, folds, splits and batches that any partitioning repeats.

Randomness is the md5 of ``seed|key``. Keys must be unique. Rows are ordered by
that hash, and by the key where hashes meet. The first hex digits of the hash cut
each class into buckets of equal expected size, however large the class is:

* a sample of ``n`` rows needs only the hash of the ``n``-th row. It is found by
  counting buckets and then ordering the one bucket where the count crosses
  ``n``; the rows themselves are filtered and never shuffled;
* a rank is the number of rows in earlier buckets plus the place in the bucket,
  which shuffles each row once and never puts a class into one task.

``hex_digits`` sets the number of buckets (16 ** hex_digits). It changes the size
of tasks and not the result.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evenkeel.functions.labels import lookup
from evenkeel.operators.joins import union_sources
from evenkeel.session import count_by_label, small_side

SEED = 42
HEX_DIGITS = 3
_CHUNK = 10_000


def hash_of(seed: int | str, *parts: Column) -> Column:
    """md5 of the seed and the parts, joined by ``|``."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[p.cast("string") for p in parts]))


def hash_number(digest: Column) -> Column:
    """The first 60 bits of a digest as a non-negative long."""
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def _hashed(df: DataFrame, key: str, seed: int, hex_digits: int) -> DataFrame:
    return df.withColumn("_h", hash_of(seed, F.col(key))).withColumn("_b", F.substring("_h", 1, hex_digits))


def _offsets(df: DataFrame, by: list[str]) -> DataFrame:
    """Rows per bucket and rows in the earlier buckets of the same class."""
    counts = df.groupBy(*by, "_b").agg(F.count("*").alias("_n"))
    # at most 16 ** hex_digits rows per class
    before = (
        Window.partitionBy(*(by or [F.lit(0)])).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    )
    return counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))


def hash_rank(
    df: DataFrame,
    key: str,
    seed: int = SEED,
    by: str | None = None,
    rank: str = "rank",
    hex_digits: int = HEX_DIGITS,
) -> DataFrame:
    """Number the rows 1, 2, 3, … in hash order, within each class if ``by`` is given.

    Rows without a class are left out.
    """
    groups = [by] if by else []
    work = _hashed(df, key, seed, hex_digits)
    place = Window.partitionBy(*groups, "_b").orderBy("_h", key)
    return (
        work.join(_offsets(work, groups).drop("_n"), [*groups, "_b"])
        .withColumn(rank, F.col("_before") + F.row_number().over(place))
        .select(*df.columns, rank)
    )


def _label_counts(df: DataFrame, label: str) -> DataFrame:
    """``label, _n, _start``: rows per label, and the rows of the labels before it."""
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("_n"))
    # one row per label
    before = Window.orderBy(label).rowsBetween(Window.unboundedPreceding, -1)
    return small_side(counts.withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0))))


def _quota_table(df: DataFrame, by: str, quotas: Mapping) -> DataFrame:
    fields = T.StructType([T.StructField(by, df.schema[by].dataType), T.StructField("_quota", T.LongType())])
    return F.broadcast(df.sparkSession.createDataFrame([(lab, int(n)) for lab, n in quotas.items()], fields))


def _take_first(
    df: DataFrame,
    key: str,
    quotas: Mapping | DataFrame | int,
    seed: int,
    by: str | None,
    hex_digits: int,
) -> DataFrame:
    """Add ``_first``: is the row among the first ``quota`` of its class in hash order?

    ``quotas`` is one number or one per class, as a mapping or a table
    ``(by, _quota)``; classes it does not name have no row taken. Rows that
    share the key at which the quota is reached are taken in the order of a hash
    of all their columns, as many as are still wanted.
    """
    groups = [by] if by else []
    if by:
        df = df.where(F.col(by).isNotNull())
    if isinstance(quotas, Mapping):
        quotas = _quota_table(df, by, quotas)
    slim = _hashed(df.select(key, *groups), key, seed, hex_digits)
    buckets = _offsets(slim, groups)
    if isinstance(quotas, DataFrame):
        buckets = buckets.join(quotas, groups)
    else:
        buckets = buckets.withColumn("_quota", F.lit(int(quotas)))
    buckets = buckets.withColumn("_left", F.col("_quota") - F.col("_before"))
    # the bucket in which the quota is reached, if it is reached at all
    edge = small_side(
        buckets.where((F.col("_left") > 0) & (F.col("_left") <= F.col("_n"))).select(*groups, "_b", "_left")
    )
    place = Window.partitionBy(*groups, "_b").orderBy("_h", key)
    cuts = small_side(
        slim.join(edge, [*groups, "_b"])
        .withColumn("_place", F.row_number().over(place))
        .withColumn("_first_place", F.rank().over(place))
        .withColumn("_ties", F.count("*").over(Window.partitionBy(*groups, "_b", "_h", key)))
        .where(F.col("_place") == F.col("_left"))
        .select(
            *groups,
            F.col("_h").alias("_cut_h"),
            F.col(key).alias("_cut_key"),
            (F.col("_left") - F.col("_first_place") + 1).alias("_wanted"),
            "_ties",
        )
    )
    work = _hashed(df, key, seed, hex_digits)
    if groups:
        if isinstance(quotas, DataFrame):
            work = work.join(quotas, groups, "left").withColumn("_quota", F.coalesce("_quota", F.lit(0)))
        else:
            work = work.withColumn("_quota", F.lit(int(quotas)))
        work = work.join(cuts, groups, "left")
    else:
        cut = cuts.head() or (None, None, None, None)
        work = (
            work.withColumn("_quota", F.lit(int(quotas)))
            .withColumn("_cut_h", F.lit(cut[0]).cast("string"))
            .withColumn("_cut_key", F.lit(cut[1]).cast(df.schema[key].dataType))
            .withColumn("_wanted", F.lit(cut[2]).cast("bigint"))
        )
    same_hash = F.col("_h") == F.col("_cut_h")
    at_cut = same_hash & F.col(key).eqNullSafe(F.col("_cut_key"))
    within = (F.col("_h") < F.col("_cut_h")) | (same_hash & (F.col(key) < F.col("_cut_key"))) | at_cut
    # without a cut the class has fewer rows than its quota, or a quota of zero
    first = F.when(F.col("_cut_h").isNull(), F.col("_quota") > 0).otherwise(F.coalesce(within, F.lit(False)))
    flagged = work.withColumn("_first", first)
    if not cuts.where(F.col("_ties") > F.col("_wanted")).take(1):
        return flagged.select(*df.columns, "_first")
    # the key at the cut is repeated: its rows, and only those, are numbered
    tied = F.coalesce(at_cut, F.lit(False))
    number = F.row_number().over(Window.partitionBy(*groups, "_h", key).orderBy(F.xxhash64(*df.columns)))
    numbered = flagged.where(tied).withColumn("_first", number <= F.col("_wanted"))
    return flagged.where(~tied).select(*df.columns, "_first").unionByName(numbered.select(*df.columns, "_first"))


def undersample(
    df: DataFrame,
    n: int | Mapping,
    key: str,
    seed: int = SEED,
    by: str | None = None,
    hex_digits: int = HEX_DIGITS,
) -> DataFrame:
    """Exactly ``min(rows, n)`` rows without replacement, per class if ``by`` is given.

    With a mapping, classes that it does not name are kept whole. Rows without a
    class are left out.
    """
    if isinstance(n, Mapping):
        flagged = _take_first(df, key, n, seed, by, hex_digits)
        return flagged.where(F.col("_first") | ~F.col(by).isin(*n)).drop("_first")
    return _take_first(df, key, n, seed, by, hex_digits).where("_first").drop("_first")


def draw_rows(
    ranked: DataFrame,
    label: str,
    sizes: Mapping,
    wanted: Mapping,
    seed: int = SEED,
    rank: str = "_rank",
    draw: str = "draw",
) -> DataFrame:
    """``wanted[label]`` draws with replacement from rows numbered 1 to ``sizes[label]``.

    Each draw picks a rank by its hash. Draw numbers are made in two steps of at
    most 10,000 per input row, so that a large sample is spread over tasks. Where
    a row is expected to be drawn more often than that, it is copied under
    several salts and its draws are dealt out over them, so that a class of a few
    rows drawn many times is no hot key.
    """
    spark = ranked.sparkSession
    salts = {lab: -(-n // (sizes[lab] * _CHUNK)) for lab, n in wanted.items()}
    plan = spark.createDataFrame(
        [(str(lab), int(sizes[lab]), int(n), int(salts[lab])) for lab, n in wanted.items()],
        "_label string, _size bigint, _n bigint, _salts bigint",
    )
    start = F.col("_start")
    chunks = plan.select(
        "*", F.explode(F.sequence(F.lit(0), F.col("_n") - 1, F.lit(_CHUNK))).alias("_start")
    ).repartition(F.col("_label"), start)
    draws = chunks.select(
        F.col("_label").cast(ranked.schema[label].dataType).alias(label),
        "_size",
        "_salts",
        F.explode(F.sequence(start, F.least(start + _CHUNK, F.col("_n")) - 1)).alias(draw),
    ).select(
        label,
        draw,
        (F.pmod(hash_number(hash_of(seed, F.col(label), F.col(draw))), F.col("_size")) + 1).alias(rank),
        F.pmod(F.col(draw), F.col("_salts")).alias("_salt"),
    )
    keys = [label, rank]
    if max(salts.values()) > 1:
        keys.append("_salt")
        copies = lookup(F.col(label), salts).cast("bigint")
        ranked = ranked.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), copies - 1)))
    else:
        draws = draws.drop("_salt")
    return draws.join(ranked, keys).drop("_salt")


def oversample(
    df: DataFrame,
    n: int | Mapping,
    key: str,
    label: str,
    seed: int = SEED,
    sizes: Mapping | None = None,
    hex_digits: int = HEX_DIGITS,
) -> DataFrame:
    """Exactly ``n`` rows per class drawn with replacement, with the draw's number.

    Classes without rows stay empty; with a mapping only the classes it names are
    drawn.
    """
    sizes = count_by_label(df, label) if sizes is None else sizes
    wanted = {lab: int(n[lab] if isinstance(n, Mapping) else n) for lab in sizes if not isinstance(n, Mapping) or lab in n}
    wanted = {lab: k for lab, k in wanted.items() if k > 0 and sizes[lab] > 0}
    if not wanted:
        return df.limit(0).withColumn("draw", F.lit(None).cast("bigint"))
    rows = df.where(F.col(label).isin(*wanted))
    ranked = hash_rank(rows, key, seed, by=label, rank="_rank", hex_digits=hex_digits)
    return draw_rows(ranked, label, sizes, wanted, seed).select(*df.columns, "draw")


def balance_classes(
    df: DataFrame,
    key: str,
    label: str = "label",
    majority=0,
    target: int = 2000,
    minimum: int = 2000,
    seed: int = SEED,
    hex_digits: int = HEX_DIGITS,
) -> DataFrame:
    """Cut the majority class to ``target`` and draw the small ones up to ``minimum``.

    Classes in between are kept, classes without rows stay out. ``draw`` is null
    for rows taken as they are. There is one filtered pass for all kept classes
    and one join for all drawn classes, whatever their number.
    """
    sizes = count_by_label(df, label)
    small = {lab: minimum for lab, size in sizes.items() if lab != majority and size < minimum}
    kept = df.where(~F.col(label).isin(*small)) if small else df.where(F.col(label).isNotNull())
    if sizes.get(majority, 0) > target:
        kept = undersample(kept, {majority: target}, key, seed, by=label, hex_digits=hex_digits)
    kept = kept.withColumn("draw", F.lit(None).cast("bigint"))
    if not small:
        return kept
    return kept.unionByName(oversample(df, small, key, label, seed, sizes, hex_digits))


def source_mix(
    main: DataFrame,
    extra: DataFrame,
    key: str,
    label: str = "label",
    pooled: Mapping | None = None,
    drawn: Mapping | None = None,
    seed: int = SEED,
    hex_digits: int = HEX_DIGITS,
) -> DataFrame:
    """Mix two sources by class.

    ``pooled`` classes are taken from both and cut to a size; ``drawn`` classes
    come from ``main`` alone and are drawn with replacement to a size, also if
    they are larger; all rows of the other classes of both sources are kept. The
    defaults are the sizes of the six-class task.
    """
    pooled = {0: 15_000} if pooled is None else pooled
    drawn = {4: 2_000, 5: 2_000} if drawn is None else drawn
    main, extra = main.withColumn("source", F.lit(0)), extra.withColumn("source", F.lit(1))
    both = union_sources(main, extra).where(~F.col(label).isin(*drawn) if drawn else F.col(label).isNotNull())
    # ids of two sources may meet, so the source is part of the sampling key
    both = both.withColumn("_id", F.concat_ws(":", "source", F.col(key).cast("string")))
    kept = undersample(both, pooled, "_id", seed, by=label, hex_digits=hex_digits).drop("_id")
    kept = kept.withColumn("draw", F.lit(None).cast("bigint"))
    if not drawn:
        return kept
    return union_sources(kept, oversample(main, drawn, key, label, seed, hex_digits=hex_digits))


def reindex(
    df: DataFrame,
    key: str,
    source: str,
    out: str = "index",
    seed: int = SEED,
    hex_digits: int = HEX_DIGITS,
) -> DataFrame:
    """Ids 0, 1, … n-1 over a union of sources, source after source.

    ``key`` must be unique within a source.
    """
    ranked = hash_rank(df, key, seed, by=source, rank="_rank", hex_digits=hex_digits)
    starts = _label_counts(df, source).drop("_n")
    number = (F.col("_start") + F.col("_rank") - 1).cast("string")
    return ranked.join(starts, source).withColumn(out, number).select(*[c for c in df.columns if c != out], out)


def stratified_folds(
    df: DataFrame,
    key: str,
    label: str = "label",
    k: int = 5,
    seed: int = SEED,
    fold: str = "fold",
    hex_digits: int = HEX_DIGITS,
) -> DataFrame:
    """Assign each row to one of ``k`` folds, shuffled and stratified.

    Sizes differ by at most one, per class and in total, because the classes
    are dealt out one after the other.
    """
    ranked = hash_rank(df, key, seed, by=label, rank="_rank", hex_digits=hex_digits)
    starts = _label_counts(df, label).drop("_n")
    dealt = F.pmod(F.col("_start") + F.col("_rank") - 1, F.lit(k)).cast("int")
    return ranked.join(starts, label).withColumn(fold, dealt).select(*[c for c in df.columns if c != fold], fold)


def assign_batches(
    df: DataFrame,
    batch_size: int,
    key: str,
    seed: int = SEED,
    batch: str = "batch",
    hex_digits: int = HEX_DIGITS,
) -> DataFrame:
    """Shuffle and cut into batches; only the last one may be smaller."""
    ranked = hash_rank(df, key, seed, rank="_rank", hex_digits=hex_digits)
    return ranked.withColumn(batch, F.floor((F.col("_rank") - 1) / batch_size).cast("bigint")).drop("_rank")


def holdout_sizes(sizes: Mapping, test_size: float) -> dict:
    """Test rows per class: shares rounded down, the rest by largest remainder."""
    total = sum(sizes.values())
    n_test = math.ceil(round(test_size * total, 9))
    share = {lab: divmod(size * n_test, total) for lab, size in sizes.items()}
    out = {lab: whole for lab, (whole, _) in share.items()}
    order = sorted(share, key=lambda lab: -share[lab][1])
    for lab in order[: n_test - sum(out.values())]:
        out[lab] += 1
    return out


def stratified_split(
    df: DataFrame,
    key: str,
    label: str = "label",
    test_size: float = 0.1,
    seed: int = SEED,
    out: str = "is_test",
    hex_digits: int = HEX_DIGITS,
) -> DataFrame:
    """Mark a stratified hold-out part of exactly ``ceil(test_size * rows)`` rows.

    The rows are not shuffled.
    """
    rows = df.where(F.col(label).isNotNull())
    quotas = small_side(holdout_quotas(_label_counts(rows, label), label, test_size))
    return _take_first(rows, key, quotas, seed, label, hex_digits).withColumnRenamed("_first", out)


def holdout_quotas(counts: DataFrame, label: str, test_size: float) -> DataFrame:
    """``(label, _quota)``: :func:`holdout_sizes` for a table of any number of labels."""
    everything = Window.partitionBy(F.lit(0))
    total = F.sum("_n").over(everything)
    wanted = F.ceil(F.round(total * F.lit(float(test_size)), 9))
    shares = counts.select(label, "_n", total.alias("_all"), wanted.alias("_wanted")).select(
        label,
        "_wanted",
        F.expr("_n * _wanted div _all").alias("_whole"),
        F.expr("_n * _wanted % _all").alias("_rest"),
    )
    more = F.col("_wanted") - F.sum("_whole").over(everything)
    place = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.desc("_rest"), label))
    quota = F.col("_whole") + (place <= more).cast("bigint")
    return shares.withColumn("_quota", quota).select(label, "_quota")
