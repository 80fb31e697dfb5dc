"""Row-by-row comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import datetime as dt
import math

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def duck(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def plain(value):
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, dt.date):
        return value.isoformat()
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.12g}")
    return value


def rows(columns: list[str], data) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(plain(r[i]) for i in order) for r in data]
    return sorted(out, key=lambda r: tuple((v is None, str(type(v)), str(v)) for v in r))


# Spark and DuckDB names of the same column type.
SAME_TYPE = {
    "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
    "date": "DATE", "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP",
}


def duck_types(con, sql: str) -> dict[str, str]:
    described = con.execute(f"DESCRIBE {sql}").fetchall()
    return {r[0]: r[1] for r in described}


def difference(spark_df, con, sql: str) -> str | None:
    """None if columns, types and rows agree, else what differs."""
    expected = duck_types(con, sql)
    got = dict(spark_df.dtypes)
    if sorted(expected) != sorted(got):
        return f"columns: {sorted(set(expected) ^ set(got))[:10]}"
    wrong = {c: (t, expected[c]) for c, t in got.items() if SAME_TYPE.get(t) != expected[c]}
    if wrong:
        return f"types: {dict(list(wrong.items())[:10])}"
    left = rows(spark_df.columns, spark_df.collect())
    right = rows(list(expected), con.execute(sql).fetchall())
    if len(left) != len(right):
        return f"rows: {len(left)} against {len(right)}"
    names = sorted(expected)
    for a, b in zip(left, right):
        if a != b:
            bad = [(n, x, y) for n, x, y in zip(names, a, b) if x != y]
            return f"values: {bad[:6]}"
    return None
