"""Joins of texts with labels, weights and folds, and unions of sources."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_labels(text: DataFrame, labels: DataFrame, on: str = "index", null_safe: bool = False) -> DataFrame:
    """Inner join of texts and labels on their id.

    Repeated ids multiply and unmatched rows drop out. ``null_safe`` also
    matches null ids with each other. The strategy is left to adaptive
    execution, which splits hot ids where it sorts and merges.
    """
    if not null_safe:
        return text.join(labels, on, "inner")
    t, l = text.alias("t"), labels.alias("l")
    return t.join(l, F.col(f"t.{on}").eqNullSafe(F.col(f"l.{on}")), "inner").select(
        "t.*", *[F.col(f"l.{c}") for c in labels.columns if c != on]
    )


def union_sources(*frames: DataFrame) -> DataFrame:
    """All rows of all sources by column name; absent columns become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def merge_splits(*splits: DataFrame) -> DataFrame:
    """Training and validation rows as one input; the columns must agree."""
    return reduce(lambda a, b: a.unionByName(b), splits)


def fold_parts(df: DataFrame, k: int, fold: str = "fold") -> tuple[DataFrame, DataFrame]:
    """Training part and validation part of fold ``k``."""
    return df.where(F.col(fold) != k), df.where(F.col(fold) == k)
