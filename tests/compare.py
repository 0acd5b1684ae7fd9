"""Compare a query's rows with DuckDB on the same Parquet files."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(os.path.join(sf_dir, "*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    return value


def _ordered(columns: list[str], rows) -> list[tuple]:
    at = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in at) for r in rows), key=lambda t: tuple(map(str, t)))


def difference(frame, con, sql: str) -> str | None:
    """None when columns and rows agree, else what differs first."""
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    if sorted(columns) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} != {sorted(columns)}"
    want, have = _ordered(columns, result.fetchall()), _ordered(frame.columns, frame.collect())
    if len(want) != len(have):
        return f"rows {len(have)} != {len(want)}"
    for a, b in zip(have, want):
        if a != b:
            return f"{a} != {b}"
        if [type(x) for x in a] != [type(x) for x in b]:
            return f"types {a} != {b}"
    return None
