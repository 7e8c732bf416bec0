"""Comparison of a Spark result with DuckDB on the same tables."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def _kind(type_name: str) -> str:
    names = {"int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}
    return names.get(type_name, type_name)


def _sortable(row: tuple) -> tuple:
    return tuple((value is None, "nan" if isinstance(value, float) and math.isnan(value) else value) for value in row)


def differences(spark_result: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """The first difference in columns, types, row count or values, or None."""
    names = sorted(spark_result.columns)
    rows = sorted((tuple(r[n] for n in names) for r in spark_result.collect()), key=_sortable)
    expected = connection.sql(sql)
    if names != sorted(expected.columns):
        return f"columns {names} against {sorted(expected.columns)}"
    types = {f.name: _kind(f.dataType.simpleString()) for f in spark_result.schema.fields}
    expected_types = dict(zip(expected.columns, map(str, expected.types), strict=True))
    if types != expected_types:
        return f"types {types} against {expected_types}"
    order = [expected.columns.index(n) for n in names]
    wanted = sorted((tuple(r[i] for i in order) for r in expected.fetchall()), key=_sortable)
    if len(rows) != len(wanted):
        return f"{len(rows)} rows against {len(wanted)}"
    for mine, theirs in zip(rows, wanted, strict=True):
        if mine != theirs:
            return f"{mine} against {theirs}"
    return None
