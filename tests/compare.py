"""Run a query and its SQL twin on the same tables and compare the rows."""

from __future__ import annotations

from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        path = Path(folder) / f"{name}.parquet"
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def _canonical(columns, rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def differences(spark_df, connection, sql: str) -> str | None:
    """None when equal, otherwise what differs first."""
    result = connection.execute(sql)
    sql_columns = [d[0] for d in result.description]
    spark_columns = spark_df.columns
    if sorted(sql_columns) != sorted(spark_columns):
        return f"columns {sorted(spark_columns)} vs {sorted(sql_columns)}"
    left = _canonical(spark_columns, [tuple(row) for row in spark_df.collect()])
    right = _canonical(sql_columns, result.fetchall())
    if len(left) != len(right):
        return f"{len(left)} rows vs {len(right)}"
    unequal = [(a, b) for a, b in zip(left, right) if repr(a) != repr(b)]
    return f"{len(unequal)} rows differ, first {unequal[0]}" if unequal else None
