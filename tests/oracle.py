"""Compares registered queries with their SQL on the test tables."""

from __future__ import annotations

import datetime as dt
import decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

SPARK_TYPES = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN",
    "date": "DATE", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def rows_of(names, rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def differences(spark, con, sf_dir, fn, sql) -> list[str]:
    """What differs between the query and the SQL, as text; empty when they agree."""
    frame = fn(spark, sf_dir)
    result = con.execute(sql)
    columns = {d[0]: str(d[1]) for d in result.description}
    expected = rows_of(list(columns), result.fetchall())
    found = rows_of(frame.columns, frame.collect())
    problems = []
    if sorted(columns) != sorted(frame.columns):
        return [f"columns {sorted(frame.columns)} expected {sorted(columns)}"]
    for name, kind in frame.dtypes:
        if SPARK_TYPES.get(kind, kind) != columns[name]:
            problems.append(f"type of {name}: {kind} expected {columns[name]}")
    if len(found) != len(expected):
        problems.append(f"rows: {len(found)} expected {len(expected)}")
    if found != expected:
        pairs = [(a, b) for a, b in zip(found, expected) if a != b][:2]
        problems.append(f"values: {pairs}")
    if not expected:
        problems.append("no rows to compare")
    return problems
