"""Expressions on arrays of doubles: logits, probabilities, losses."""

from __future__ import annotations

import sys
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from evenkeel.functions.binding import let


def total(col: Column) -> Column:
    return F.aggregate(col, F.lit(0.0), lambda acc, x: acc + x)


def softmax(logits: Column) -> Column:
    """Probabilities from logits, shifted by the maximum to stay finite."""
    shifted = let(logits, lambda v: let(F.array_max(v), lambda top: F.transform(v, lambda x: F.exp(x - top))))
    return let(shifted, lambda e: let(total(e), lambda s: F.transform(e, lambda x: x / s)))


def argmax(col: Column) -> Column:
    """Position of the largest entry; the first one wins a tie."""
    return let(col, lambda v: (F.array_position(v, F.array_max(v)) - 1).cast("int"))


def apply_multipliers(probs: Column, multipliers: Sequence[float] | Column) -> Column:
    """Scale each class probability by its own factor."""
    if not isinstance(multipliers, Column):
        multipliers = F.array(*[F.lit(float(m)) for m in multipliers])
    return F.zip_with(probs, multipliers, lambda p, m: p * m)


def l2_normalise(col: Column) -> Column:
    """Unit length; a zero vector stays zero."""

    def scale(v: Column) -> Column:
        length = F.sqrt(F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x * x))
        return let(length, lambda n: F.transform(v, lambda x: F.when(n > 0, x / n).otherwise(F.lit(0.0))))

    return let(col, scale)


def label_weight(label: Column, weights: Mapping[int, float] | None) -> Column:
    """Weight of a label from a per-class table; 1 if no table is given."""
    if not weights:
        return F.lit(1.0)
    pairs = [F.lit(x) for kv in weights.items() for x in (kv[0], float(kv[1]))]
    return F.try_element_at(F.create_map(*pairs), label)


def cross_entropy(logits: Column, label: Column, weights: Mapping[int, float] | None = None) -> Column:
    """Weighted cross-entropy per row, from logits."""

    def ce(v: Column) -> Column:
        rest = let(F.array_max(v), lambda top: top + F.log(total(F.transform(v, lambda x: F.exp(x - top)))))
        return rest - F.get(v, label)

    return label_weight(label, weights) * let(logits, ce)


def weighted_ce(probs: Column, label: Column, weights: Mapping[int, float] | None = None) -> Column:
    """Weighted cross-entropy per row, from probabilities; one of zero counts as the least positive double."""
    own = F.get(probs, label)
    least = sys.float_info.min
    return label_weight(label, weights) * -F.log(F.when(own < least, F.lit(least)).otherwise(own))


def focal_loss(ce: Column, gamma: float = 2.0) -> Column:
    """Focal loss from a cross-entropy that already carries its class weight."""
    return F.pow(1 - F.exp(-ce), F.lit(float(gamma))) * ce
