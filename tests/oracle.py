"""Compare a query with its SQL: column names, row count and sorted values."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, bool) or value is None:
        return str(value)
    if isinstance(value, (float, decimal.Decimal)):
        return "nan" if math.isnan(value) else f"{float(value):.6f}"
    if isinstance(value, (dt.datetime, dt.date)):
        return value.isoformat()
    return str(value)


def rows_of(names, rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(plain(row[i]) for i in order) for row in rows)


FAMILIES = {
    "tinyint": "int", "smallint": "int", "int": "int", "bigint": "bigint", "integer": "int", "hugeint": "hugeint",
    "varchar": "string", "string": "string", "double": "double", "float": "float", "date": "date", "boolean": "boolean",
    "timestamp": "timestamp", "timestamp_ntz": "timestamp",
}


def compare(connection, sql: str, df) -> str | None:
    """None when equal, else a short description of the first difference."""
    result = connection.execute(sql)
    names = [c[0] for c in result.description]
    kinds = {c[0]: FAMILIES.get(str(c[1]).lower(), str(c[1]).lower()) for c in result.description}
    expected = result.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    mine = {n: FAMILIES.get(t, t) for n, t in df.dtypes}
    if mine != kinds:
        return f"types {[(n, mine[n], kinds[n]) for n in names if mine[n] != kinds[n]]}"
    got, want = rows_of(df.columns, df.collect()), rows_of(names, expected)
    if got == want:
        return None
    extra, missing = set(got) - set(want), set(want) - set(got)
    return f"{len(got)} rows, want {len(want)}; extra {sorted(extra)[:2]}; missing {sorted(missing)[:2]}"
