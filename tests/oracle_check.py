"""Compare a Spark result with its DuckDB statement: columns, types, and values as sorted rows."""

from __future__ import annotations

import glob
import math
import os

import duckdb
import pandas as pd



def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if value is None or value is pd.NaT or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, float):
        return float(repr(value))
    return value


def _rows(table) -> list[tuple]:
    names = sorted(table.column_names)
    columns = [table.column(n).to_pylist() for n in names]
    rows = [tuple(_plain(v) for v in row) for row in zip(*columns)]
    return sorted(rows, key=lambda r: tuple((v is None, str(type(v)), v if v is not None else 0) for v in r))


def _type(arrow_type) -> str:
    text = str(arrow_type)
    return {"large_string": "string", "timestamp[us, tz=UTC]": "timestamp[us]"}.get(text, text)


def differences(spark_df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Empty when both sides agree."""
    left = spark_df.toArrow()
    right = con.sql(sql).to_arrow_table()
    if sorted(left.column_names) != sorted(right.column_names):
        return [f"columns {sorted(left.column_names)} != {sorted(right.column_names)}"]
    found = []
    for name in left.column_names:
        a, b = _type(left.schema.field(name).type), _type(right.schema.field(name).type)
        if a != b:
            found.append(f"type of {name}: {a} != {b}")
    a, b = _rows(left), _rows(right)
    if len(a) != len(b):
        found.append(f"rows {len(a)} != {len(b)}")
    unequal = [(x, y) for x, y in zip(a, b) if x != y]
    if unequal:
        found.append(f"{len(unequal)} rows differ, first {unequal[0]}")
    return found
