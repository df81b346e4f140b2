"""Run a query and its SQL twin and compare the rows without their order."""

import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _cell(value):
    if value is None:
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, int):
        return value
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    return str(value)


def rows_of_spark(df):
    names = sorted(df.columns)
    table = df.select(*names).toArrow().to_pylist()
    return names, sorted((tuple(_cell(r[n]) for n in names) for r in table), key=repr)


def rows_of_sql(con, sql):
    result = con.sql(sql)
    names = result.columns
    table = result.to_arrow_table().to_pylist()
    order = sorted(names)
    return order, sorted((tuple(_cell(r[n]) for n in order) for r in table), key=repr)


def kinds(rows):
    """Per column, which Python types occur (int and float must not be mixed up)."""
    out = []
    for col in zip(*rows):
        out.append({type(v).__name__ for v in col if v is not None})
    return out


def differences(df, con, sql):
    a_names, a = rows_of_spark(df)
    b_names, b = rows_of_sql(con, sql)
    if a_names != b_names:
        return f"columns {a_names} and {b_names}"
    if len(a) != len(b):
        return f"{len(a)} rows and {len(b)} rows"
    if a != b:
        bad = [(x, y) for x, y in zip(a, b) if x != y]
        return f"{len(bad)} rows differ, first {bad[0][0]} and {bad[0][1]}; kinds {kinds(a)} {kinds(b)}"
    return None
