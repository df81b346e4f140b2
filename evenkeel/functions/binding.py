"""Binding a computed value to a name inside an expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Compute ``value`` once per row and use it several times in ``body``.

    A column made by an earlier projection gives no such promise: the optimizer
    may merge projections, or push a filter below them, and then the value is
    computed at each use, inside a loop over an array even once per entry.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def with_costly(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are computed once per row even if rows are filtered by them.

    A filter on a plain computed column is moved below the projection, and the
    column is computed once to filter and once more for the rows that stay. A
    generator of one row keeps filters on its own output above itself, and lets
    those on other columns through.
    """
    row = F.struct(*[column.alias(name) for name, column in columns.items()])
    return df.select("*", F.inline_outer(F.array(row)))
