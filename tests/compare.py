"""Runs a query on Spark and its expected SQL on DuckDB and compares the results."""

from __future__ import annotations

import glob
import math
from pathlib import Path

import duckdb
import pyarrow as pa
from pyspark.sql import DataFrame

SMALL = "/root/testdata/sf0.001"


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {Path(path).stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def _kind(t: pa.DataType) -> str:
    if pa.types.is_large_string(t) or pa.types.is_string(t):
        return "string"
    if pa.types.is_timestamp(t):
        return "timestamp" if t.tz is None else "timestamp with zone"
    return str(t)


def _rows(table: pa.Table) -> list[tuple]:
    names = sorted(table.column_names)
    columns = [table.column(n).to_pylist() for n in names]
    rows = [
        tuple(round(v, 9) if isinstance(v, float) and not math.isnan(v) else v for v in row)
        for row in zip(*columns)
    ]
    return sorted(rows, key=repr)


def differences(df: DataFrame, con: duckdb.DuckDBPyConnection, text: str) -> list[str]:
    actual = df.toArrow()
    expected = con.sql(text).to_arrow_table()
    found = []
    kinds = [{f.name: _kind(f.type) for f in table.schema} for table in (actual, expected)]
    if kinds[0] != kinds[1]:
        odd = {n for n in {**kinds[0], **kinds[1]} if kinds[0].get(n) != kinds[1].get(n)}
        found.append(f"schema: {[(n, kinds[0].get(n), kinds[1].get(n)) for n in sorted(odd)]}")
    if actual.num_rows != expected.num_rows:
        found.append(f"rows: {actual.num_rows} instead of {expected.num_rows}")
    if set(kinds[0]) == set(kinds[1]):
        a, b = _rows(actual), _rows(expected)
        if a != b:
            found.append(f"values: {next((x, y) for x, y in zip(a + [None], b + [None]) if x != y)}")
    return found
