"""Compare query results with SQL run by DuckDB."""

import datetime as dt
import math
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def oracle_connection(sf_dir):
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def normal(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if isinstance(value, dt.datetime):
        return value.isoformat(sep=" ")
    return value


def rows_of(columns, rows):
    """Column names in order and the rows sorted, independent of column and row order."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    listed = [tuple(normal(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(listed, key=repr)


def spark_rows(df):
    return rows_of(df.columns, [tuple(r) for r in df.collect()])


def sql_rows(connection, sql):
    cursor = connection.execute(sql)
    return rows_of([d[0] for d in cursor.description], cursor.fetchall())
