"""Comparing a Spark result with the answer of a SQL twin, regardless of row order."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in Path(sf).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def _cell(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else repr(value)
    return value if value is None or isinstance(value, (str, bool)) else str(value)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_cell(row[i]) for i in order) for row in rows), key=repr)


def spark_rows(df):
    return sorted(df.columns), _rows(df.columns, df.collect())


def sql_rows(connection, sql):
    cursor = connection.execute(sql)
    names = [column[0] for column in cursor.description]
    return sorted(names), _rows(names, cursor.fetchall())
