"""Compare a Spark result with DuckDB's, row by row, whatever their order."""

import datetime
import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir):
    connection = duckdb.connect()
    for table in TABLES:
        path = os.path.join(sf_dir, f"{table}.parquet")
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}'")
    return connection


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(plain, key=lambda row: tuple((v is None, str(v)) for v in row))


def duck_type(name):
    kinds = {
        "string": "VARCHAR",
        "bigint": "BIGINT",
        "int": "INTEGER",
        "double": "DOUBLE",
        "timestamp_ntz": "TIMESTAMP",
        "boolean": "BOOLEAN",
    }
    return kinds[name]


def compare(spark_df, connection, sql):
    """None when equal, else what differs."""
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    types = {d[0]: str(d[1]) for d in result.description}
    columns, expected = _sorted_rows(names, result.fetchall())
    mine, actual = _sorted_rows(spark_df.columns, [tuple(row) for row in spark_df.collect()])
    if columns != mine:
        return f"columns {mine} instead of {columns}"
    spark_types = {name: duck_type(kind) for name, kind in spark_df.dtypes}
    if any(types[name] not in (spark_types[name], '"NULL"') for name in types):
        return f"types {spark_types} instead of {types}"
    if len(expected) != len(actual):
        return f"{len(actual)} rows instead of {len(expected)}"
    for have, want in zip(actual, expected):
        if have != want:
            return f"row {have} instead of {want}"
    return None
