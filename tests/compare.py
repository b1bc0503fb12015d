"""Runs registered queries against their SQL twins and compares the rows as bags."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def sql_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _value(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    if isinstance(value, bool) or value is None:
        return value
    return float(value) if isinstance(value, int) else str(value)


def bag(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_value(row[i]) for i in order) for row in rows)


def spark_bag(df) -> tuple[list[str], Counter]:
    return sorted(df.columns), bag(df.columns, df.collect())


def sql_bag(connection, sql: str) -> tuple[list[str], Counter]:
    result = connection.execute(sql)
    columns = [d[0] for d in result.description]
    return sorted(columns), bag(columns, result.fetchall())
