"""Rows of features as numpy blocks inside tasks, and array sums across tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Entries of an array that travel in one row, and products that are held at a time.
CHUNK = 1 << 14
HELD = 1 << 22


def feature_parts(df: DataFrame, features: str) -> tuple[Column, Column]:
    """Indices (null for a dense row) and values of a vector column or an array of numbers, without a Python pass."""
    if isinstance(df.schema[features].dataType, VectorUDT):
        plain = F.unwrap_udt(F.col(features))
        return plain["indices"], plain["values"]
    return F.lit(None).cast("array<int>"), F.col(features).cast("array<double>")


def width_of(df: DataFrame, features: str) -> int:
    """Number of features; zero for a table without rows."""
    if isinstance(df.schema[features].dataType, VectorUDT):
        plain = F.unwrap_udt(F.col(features))
        size = F.coalesce(plain["size"], F.size(plain["values"]))
    else:
        size = F.size(features)
    return df.where(F.col(features).isNotNull()).agg(F.coalesce(F.max(size), F.lit(0))).head()[0]


class RowBlock:
    """Some rows of ``width`` features, dense or sparse, row by row as they came."""

    def __init__(self, indices: pa.Array, values: pa.Array, width: int):
        self.n, self.width = len(values), width
        counts = np.asarray(values.value_lengths().fill_null(0), np.int64)
        held = values.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        sparse = np.asarray(indices.is_valid())
        if not sparse.any() and (counts == width).all():
            self.dense, self.values = held.reshape(self.n, width), None
            return
        self.dense, self.values = None, held
        self.rows = np.repeat(np.arange(self.n), counts)
        first = np.cumsum(counts) - counts
        # a dense row holds all positions in order
        self.columns = np.arange(len(held)) - first[self.rows]
        self.columns[sparse[self.rows]] = indices.flatten().to_numpy(zero_copy_only=False)

    def margins(self, weights: np.ndarray) -> np.ndarray:
        """Rows times a matrix of ``width`` rows."""
        if self.dense is not None:
            return self.dense @ weights
        out = np.zeros((self.n, weights.shape[1]))
        for at in range(0, len(self.values), step := max(1, HELD // weights.shape[1])):
            some = slice(at, at + step)
            np.add.at(out, self.rows[some], self.values[some, None] * weights[self.columns[some]])
        return out

    def gradient(self, slopes: np.ndarray) -> np.ndarray:
        """Columns times one slope per row and output."""
        if self.dense is not None:
            return self.dense.T @ slopes
        return np.stack(
            [np.bincount(self.columns, self.values * slopes[self.rows, c], self.width) for c in range(slopes.shape[1])], axis=1
        )


def array_rows(array: np.ndarray) -> Iterator[pa.RecordBatch]:
    """An array as numbered rows of bounded size, for :func:`summed`."""
    flat = np.ascontiguousarray(array, np.float64).ravel()
    for part, at in enumerate(range(0, len(flat), CHUNK)):
        values = pa.array([flat[at : at + CHUNK]], pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), values], ["part", "values"])


ARRAY_ROWS = "part int, values array<double>"


def summed(parts: DataFrame, shape: tuple[int, ...]) -> np.ndarray:
    """The sum of the arrays that tasks gave out as :func:`array_rows`.

    A task adds up one piece of the array over all of them; the driver gets one array, however many tasks there were.
    """

    def add(table: pa.Table) -> pa.Table:
        held = table.column("values").combine_chunks()
        total = held.flatten().to_numpy().reshape(table.num_rows, -1).sum(axis=0)
        return pa.table({"part": table.column("part")[:1], "values": pa.array([total], pa.list_(pa.float64()))})

    rows = parts.groupBy("part").applyInArrow(add, ARRAY_ROWS).toArrow().sort_by("part")
    if rows.num_rows == 0:
        return np.zeros(shape)
    return rows.column("values").combine_chunks().flatten().to_numpy().reshape(shape)
