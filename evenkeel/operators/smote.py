"""Synthetic minority rows between a row and one of its nearest neighbours."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenkeel.operators.approximate import listed_nearest
from evenkeel.operators.sampling import HEX_DIGITS, SEED, draw_rows, hash_number, hash_of, hash_rank, undersample
from evenkeel.operators.similarity import nearest
from evenkeel.session import count_by_label


def neighbor_count(sizes: Mapping, k: int) -> int:
    """``k``, or fewer if the smallest class present has not that many others."""
    return max(1, min(k, min(sizes.values()) - 1))


def smote(
    df: DataFrame,
    key: str,
    label: str = "label",
    vec: str = "vec",
    target: int = 2000,
    k: int = 5,
    seed: int = SEED,
    hex_digits: int = HEX_DIGITS,
    block_rows: int | None = None,
    recall: float | None = None,
) -> DataFrame:
    """Bring every class present to exactly ``target`` rows.

    Larger classes are cut. Smaller ones keep all rows and gain synthetic ones:
    a draw picks a row, one of its ``k`` nearest rows of the same class, and how
    far to go towards it. A class of one row is copied. Only classes with fewer
    than ``target`` rows meet in the neighbour search, so its size is bounded by
    ``target``. With ``recall`` they are found in inverted lists by centroids of
    their class, each row filed once, with at least that recall on a sample;
    that is the way for large targets. Result: key as text, label, vector as array of doubles,
    ``synthetic``.
    """
    sizes = count_by_label(df, label)
    small = {lab: target - size for lab, size in sizes.items() if size < target}
    rows = df.where(F.col(label).isNotNull()).select(key, label, F.col(vec).cast("array<double>").alias(vec))
    large = {lab: target for lab, size in sizes.items() if size > target}
    real = undersample(rows, large, key, seed, by=label, hex_digits=hex_digits) if large else rows
    kept = real.select(F.col(key).cast("string").alias(key), label, vec, F.lit(False).alias("synthetic"))
    if not small:
        return kept

    base = rows.where(F.col(label).isin(*small))
    k_used = neighbor_count(sizes, k)
    if recall is None:
        close, on = nearest(base, base, key, key, vec, k_used, by=label, skip_self=True, block_rows=block_rows), [label, key]
    else:
        close, on = listed_nearest(base, base, key, key, vec, k_used, label, recall=recall, skip_self=True, seed=seed)[0], [key]
    ranked = hash_rank(base, key, seed, by=label, rank="_rank", hex_digits=hex_digits).join(close, on, "left")
    pick = hash_number(hash_of(f"{seed}n", F.col(label), F.col("draw")))
    # 52 bits, so that the fraction is an exact double
    gap = F.conv(F.substring(hash_of(f"{seed}g", F.col(label), F.col("draw")), 1, 13), 16, 10).cast("double") / float(16**13)
    chosen = draw_rows(ranked, label, sizes, small, seed).select(
        label,
        "draw",
        F.col(vec).alias("_x"),
        F.get("neighbors", F.pmod(pick, F.greatest(F.size("neighbors"), F.lit(1))).cast("int"))["id"].alias("_nid"),
        gap.alias("_u"),
    )
    other = base.select(F.col(label).alias("_nl"), F.col(key).alias("_nid"), F.col(vec).alias("_y"))
    made = (
        chosen.join(other.drop("_nl"), "_nid", "left")
        .withColumn("_y", F.coalesce("_y", "_x"))
        .select(
            F.concat(F.lit("smote_"), F.col(label).cast("string"), F.lit("_"), F.col("draw").cast("string")).alias(key),
            label,
            F.transform(
                F.arrays_zip(F.col("_x").alias("a"), F.col("_y").alias("b")),
                lambda p: p["a"] + F.col("_u") * (p["b"] - p["a"]),
            ).alias(vec),
            F.lit(True).alias("synthetic"),
        )
    )
    return kept.unionByName(made)
