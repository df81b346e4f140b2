"""User functions over columns and batches, by Arrow and never row by row."""

from __future__ import annotations

import gc
from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Bytes of batches after which a worker looks for those that are done with but not yet let go of.
HELD_BYTES = 16 * 1024 * 1024


class _Released:
    """Frees the batches of a task that only reference cycles still hold.

    ``series.str`` is such a cycle: the series keeps its accessor and that the series. A batch makes few objects, however
    large it is, so Python by itself collects only once dozens of batches are held.
    """

    def __init__(self):
        self.held = 0

    def after(self, batch: pd.Series | pd.DataFrame) -> None:
        size = batch.memory_usage(deep=True)
        self.held += int(size if isinstance(batch, pd.Series) else size.sum())
        if self.held >= HELD_BYTES:
            gc.collect()
            self.held = 0


def map_column(df: DataFrame, col: str, fn: Callable[[pd.Series], pd.Series], kind: T.DataType | str, out: str) -> DataFrame:
    """Add ``out``: a function of a whole column batch."""
    released = _Released()

    def run(batch: pd.Series) -> pd.Series:
        made = fn(batch)
        released.after(batch)
        return made

    return df.withColumn(out, F.pandas_udf(run, kind)(F.col(col)))


def map_batches(
    df: DataFrame,
    fn: Callable[[pd.DataFrame], pd.DataFrame],
    added: str,
    remove_columns: Sequence[str] = (),
) -> DataFrame:
    """Add the columns ``added`` (a DDL string) that ``fn`` makes from each batch.

    ``fn`` gets a batch as a DataFrame and gives back the added columns;
    ``remove_columns`` leave the table afterwards.
    """
    kept = [f for f in df.schema.fields if f.name not in remove_columns]
    new = T._parse_datatype_string(added)
    schema = T.StructType([*kept, *new.fields])

    def run(batches):
        released = _Released()
        for batch in batches:
            made = fn(batch)
            released.after(batch)
            yield pd.concat([batch[[f.name for f in kept]], made[[f.name for f in new.fields]]], axis=1)

    return df.mapInPandas(run, schema)
