"""Runs a registered query and its SQL and compares the rows."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def oracle_connection(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return ("decimal", value.normalize() if value else decimal.Decimal(0))
    if isinstance(value, float):
        return ("float", "nan" if math.isnan(value) else round(value, 9))
    if isinstance(value, dt.datetime):
        return ("ts", value.replace(tzinfo=None))
    return (type(value).__name__, value)


def rows_of(columns: list[str], rows) -> tuple[list[str], list]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(plain, key=repr)


def spark_rows(df):
    return rows_of(df.columns, [tuple(r) for r in df.collect()])


def sql_rows(connection, sql: str):
    cursor = connection.execute(sql)
    return rows_of([c[0] for c in cursor.description], cursor.fetchall())
