"""Compares registered queries with their SQL in DuckDB, on all rows and columns."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def open_oracle(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


SPARK_TYPES = {
    "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean",
    "TIMESTAMP": "timestamp_ntz",
}


def _cell(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return value


def _sorted(rows):
    return sorted(([_cell(v) for v in r] for r in rows), key=lambda r: [(v is None, str(v)) for v in r])


def differences(frame, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when both results agree, else a short description of the first difference."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    types = {d[0]: SPARK_TYPES.get(str(d[1]), str(d[1])) for d in result.description}
    expected = result.fetchall()
    if sorted(names) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} != {sorted(names)}"
    other = {c: (t, types[c]) for c, t in frame.dtypes if t != types[c]}
    if other:
        return f"types {other}"
    order = sorted(names)
    got = _sorted([[r[c] for c in order] for r in frame.collect()])
    want = _sorted([[r[names.index(c)] for c in order] for r in expected])
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)} rows"
    for a, b in zip(got, want):
        if a != b:
            return f"{dict(zip(order, a))} != {dict(zip(order, b))}"
    return None
