"""Compare registered queries with their SQL on another engine, value by value."""

from __future__ import annotations

import datetime
import decimal
import glob
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def _plain(value):
    if isinstance(value, (decimal.Decimal, float)):
        return repr(float(value) + 0.0)
    if isinstance(value, (datetime.date, datetime.datetime)):
        return value.isoformat()
    return repr(value)


def _sorted(rows, columns):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(spark_df, connection, sql: str) -> str | None:
    """None when columns and rows agree, else a short account."""
    cursor = connection.execute(sql)
    theirs_columns = [column[0] for column in cursor.description]
    theirs = cursor.fetchall()
    ours_columns = spark_df.columns
    ours = [tuple(row) for row in spark_df.collect()]
    if sorted(ours_columns) != sorted(theirs_columns):
        return f"columns {sorted(ours_columns)} != {sorted(theirs_columns)}"
    if len(ours) != len(theirs):
        return f"rows {len(ours)} != {len(theirs)}"
    left, right = _sorted(ours, ours_columns), _sorted(theirs, theirs_columns)
    if left != right:
        wrong = [(a, b) for a, b in zip(left, right, strict=True) if a != b]
        return f"{len(wrong)} rows differ, first {wrong[0]}"
    return None
