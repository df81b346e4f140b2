"""Search for class multipliers by a simplex that walks over the scores of candidate vectors.

Each step tries the reflected, the expanded and both contracted points in one job, and a shrunken simplex in another, so
a step costs one pass over the stored rows. Only confusion counts per candidate leave the tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenkeel.operators.blocks import ARRAY_ROWS, array_rows, summed
from evenkeel.operators.epochs import f1_scores
from evenkeel.session import cut_lineage

# Products of rows, candidates and classes that a task holds at a time.
HELD = 1 << 22


def candidate_confusions(df: DataFrame, candidates: np.ndarray, label: str = "label", probs: str = "probs") -> np.ndarray:
    """Counts of true by predicted class for each candidate vector of multipliers, in one pass.

    The first of equal products wins. Rows without a label of the classes, or without probabilities, take no part.
    """
    many, classes = candidates.shape
    slim = df.select(F.col(label).cast("int").alias("label"), F.col(probs).cast("array<double>").alias("probs")).where(
        F.col("label").between(0, classes - 1) & (F.size("probs") == classes)
    )

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((many, classes * classes))
        for batch in batches:
            p = batch.column("probs").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, classes)
            y = np.asarray(batch.column("label"), np.int64)
            for at in range(0, len(y), step := max(1, HELD // (many * classes))):
                said = (p[at : at + step, None] * candidates).argmax(axis=2)
                cell = y[at : at + step, None] * classes + said
                for c in range(many):
                    total[c] += np.bincount(cell[:, c], minlength=classes * classes)
        yield from array_rows(total)

    slim = slim.coalesce(df.sparkSession.sparkContext.defaultParallelism)
    return summed(slim.mapInArrow(task, ARRAY_ROWS), (many, classes, classes))


def walk(
    score: Callable[[np.ndarray], np.ndarray], start: Sequence[float], steps: int, tolerance: float = 1e-4
) -> tuple[np.ndarray, float]:
    """The lowest point that a simplex finds from ``start``, and its value; ``score`` judges several points at once.

    The first simplex moves each coordinate by a twentieth. It ends when points and values lie within ``tolerance`` of
    the best, or after ``steps`` steps. The start is one of the points, so the result is never worse.
    """
    start = np.asarray(start, float)
    points = np.vstack([start] + [np.where(np.arange(len(start)) == i, np.where(start != 0, 1.05 * start, 0.00025), start) for i in range(len(start))])
    values = score(points)
    for _ in range(steps):
        order = np.argsort(values, kind="stable")
        points, values = points[order], values[order]
        if np.abs(points[1:] - points[0]).max() <= tolerance and np.abs(values[1:] - values[0]).max() <= tolerance:
            break
        centre, worst = points[:-1].mean(axis=0), points[-1]
        tried = centre + np.array([1.0, 2.0, 0.5, -0.5])[:, None] * (centre - worst)
        mirrored, stretched, outside, inside = score(tried)
        if mirrored < values[0]:
            chosen = 1 if stretched < mirrored else 0
        elif mirrored < values[-2]:
            chosen = 0
        elif mirrored < values[-1]:
            chosen = 2 if outside <= mirrored else None
        else:
            chosen = 3 if inside < values[-1] else None
        if chosen is not None:
            points[-1], values[-1] = tried[chosen], (mirrored, stretched, outside, inside)[chosen]
        else:
            points[1:] = points[0] + 0.5 * (points[1:] - points[0])
            values[1:] = score(points[1:])
    best = int(np.argmin(values))
    return points[best], float(values[best])


def simplex_multipliers(
    df: DataFrame, n_classes: int, label: str = "label", probs: str = "probs", steps: int = 300, tolerance: float = 1e-4
) -> tuple[list[float], float, float]:
    """Class multipliers that raise the macro F1 of the rows; with that F1, and that of the plain argmax."""
    stored = cut_lineage(df.select(label, probs))

    def score(points: np.ndarray) -> np.ndarray:
        counts = candidate_confusions(stored, points, label, probs)
        # rounded, so that equal scores tie however they were added up
        return np.array([-round(float(f1_scores(c)[1]), 12) if c.sum() else 0.0 for c in counts])

    ones = np.ones(n_classes)
    base = -float(score(ones[None])[0])
    best, value = walk(score, ones, steps, tolerance)
    return [float(m) for m in best], -value, base
