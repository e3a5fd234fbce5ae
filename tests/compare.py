"""Run a Spark query and its SQL oracle on the same tables and compare the bags of rows."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb

SQL_TYPES = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "date": "DATE",
}


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def rows_of(columns, rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(row[i] for i in order) for row in rows)


def differences(spark_df, connection, sql: str) -> str | None:
    """None when column names and rows agree, else what differs."""
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    expected_columns, expected = rows_of(names, result.fetchall())
    actual_columns, actual = rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    types = {f.name: SQL_TYPES[f.dataType.simpleString()] for f in spark_df.schema.fields}
    expected_types = {d[0]: str(d[1]) for d in result.description}
    if types != expected_types:
        return f"types {set(types.items()) ^ set(expected_types.items())}"
    if actual_columns != expected_columns:
        return f"columns {actual_columns} != {expected_columns}"
    if actual != expected:
        extra, missing = actual - expected, expected - actual
        return (
            f"{sum(actual.values())} rows against {sum(expected.values())}; "
            f"extra {list(extra)[:3]}, missing {list(missing)[:3]}"
        )
    return None
