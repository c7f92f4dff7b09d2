"""Order-independent comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import math
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        files = f"{path}/*.parquet" if path.is_dir() else path
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{files}')")
    return connection


def _plain(value: object) -> object:
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    if isinstance(value, datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, date):
        return value.isoformat()
    return value


def _sorted_rows(names: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [names[i] for i in order], sorted(plain, key=repr)


def spark_rows(df: DataFrame) -> tuple[list[str], list[tuple]]:
    return _sorted_rows(df.columns, [tuple(row) for row in df.collect()])


def duckdb_rows(connection: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], list[tuple]]:
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    return _sorted_rows(names, result.fetchall())


def differences(df: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None if both results are the same rows, else what differs first."""
    names, rows = spark_rows(df)
    wanted_names, wanted = duckdb_rows(connection, sql)
    if names != wanted_names:
        return f"columns {names} != {wanted_names}"
    if len(rows) != len(wanted):
        return f"{len(rows)} rows != {len(wanted)} rows"
    for row, other in zip(rows, wanted):
        if repr(row) != repr(other):
            return f"{row} != {other}"
    return None
