"""A caller's own model: one file, sent to the executors, loaded once per worker and run on Arrow batches."""

from __future__ import annotations

import sys
import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evenkeel.functions.vectors import argmax

#: Columns by name, as Arrow arrays, to one row of class probabilities per row.
Model = Callable[[Mapping[str, pa.Array]], np.ndarray]


def read_bytes(spark: SparkSession, path: str) -> bytes:
    """A file, or the files of a folder in the order of their names, from any store that Spark reads."""
    rows = spark.read.format("binaryFile").option("pathGlobFilter", "[!_.]*").load(path)
    return b"".join(bytes(r["content"]) for r in sorted(rows.select("path", "content").collect(), key=lambda r: r["path"]))


def served(
    df: DataFrame,
    load: Callable[[bytes], Model],
    model: bytes | str,
    inputs: Sequence[str],
    probs: str = "probs",
    prediction: str = "prediction",
    batch_rows: int = 1024,
) -> DataFrame:
    """Add the probabilities and the most probable class that the caller's model gives each row.

    ``model`` is the content of the model file, or its path. It goes out once to every executor, and ``load`` makes it
    into a model once in every worker, not once per task or batch. The model gets ``batch_rows`` rows of the ``inputs``
    at a time. All columns of ``df`` are kept.
    """
    content = read_bytes(df.sparkSession, model) if isinstance(model, str) else model
    held = df.sparkSession.sparkContext.broadcast(content)
    token, names = uuid.uuid4().hex, list(inputs)
    schema = T.StructType([*df.schema.fields, T.StructField(probs, T.ArrayType(T.DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = sys.modules.setdefault("evenkeel_served", SimpleNamespace(models={})).models
        if token not in kept:
            kept[token] = load(held.value)
        for batch in batches:
            for at in range(0, batch.num_rows, batch_rows):
                some = batch.slice(at, batch_rows)
                p = np.asarray(kept[token]({name: some.column(name) for name in names}), np.float64)
                if p.ndim != 2 or len(p) != some.num_rows:
                    raise ValueError(f"the model gave {p.shape} for {some.num_rows} rows")
                rows = pa.ListArray.from_arrays(pa.array(np.arange(0, p.size + 1, p.shape[1]), pa.int32()), pa.array(p.ravel()))
                yield pa.RecordBatch.from_arrays([*some.columns, rows], [*some.schema.names, probs])

    return df.mapInArrow(run, schema).withColumn(prediction, argmax(F.col(probs)))
