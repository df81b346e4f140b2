"""Connected components of a link table by alternating stars, each round a few shuffles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenkeel.llm.common import settle


def _state(edges: DataFrame) -> tuple:
    """Number and order-free digest of the links; two equal states mean that a round changed nothing."""
    mixed = F.xxhash64("u", "v")
    row = edges.agg(
        F.count(F.lit(1)), F.bit_xor(mixed), F.sum(mixed.bitwiseAND(F.lit((1 << 32) - 1)))
    ).first()
    return tuple(row)


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the least of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the least of those neighbours."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.withColumnRenamed("m", "v"))


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``(node, root)`` for every node of a link table of two bigint columns; ``root`` is the least node reachable.

    Links to oneself and links with a null give no row; repeated links count once; without links the result is empty.
    Each round keeps at most the links it was given, as sums of the least neighbour per node, so no task gathers a
    component. A star's centre is a hot join key, which adaptive execution splits. Rounds grow with the logarithm of the
    number of nodes.
    """
    edges = settle(
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .where(F.col(a).isNotNull() & F.col(b).isNotNull())
        .where("u > v")
        .distinct()
    )
    before = _state(edges)
    while before[0]:
        large = _large_star(edges).where("u != v").distinct()
        edges = settle(_small_star(large).where("u != v").distinct())
        after = _state(edges)
        if after == before:
            break
        before = after
    pairs = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return pairs.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
