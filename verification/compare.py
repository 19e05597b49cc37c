"""Running a registered query beside its SQL and comparing every value."""

from __future__ import annotations

import duckdb
import pyarrow as pa
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return connection


def _kind(kind: pa.DataType) -> str:
    if pa.types.is_large_string(kind) or pa.types.is_string(kind):
        return "string"
    return "timestamp" if pa.types.is_timestamp(kind) else str(kind)


def _rows(table: pa.Table) -> list[tuple]:
    names = sorted(table.column_names)
    columns = [table.column(name).to_pylist() for name in names]
    return sorted(zip(*columns, strict=True), key=repr)


def differences(spark_result: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Human-readable differences in columns, types, rows and values; empty when equal."""
    ours, theirs = spark_result.toArrow(), connection.sql(sql).to_arrow_table()
    if sorted(ours.column_names) != sorted(theirs.column_names):
        return [f"columns {sorted(ours.column_names)} against {sorted(theirs.column_names)}"]
    kinds = {
        name: (_kind(ours.schema.field(name).type), _kind(theirs.schema.field(name).type)) for name in ours.column_names
    }
    found = [f"{name}: {left} against {right}" for name, (left, right) in kinds.items() if left != right]
    if ours.num_rows != theirs.num_rows:
        return [*found, f"rows {ours.num_rows} against {theirs.num_rows}"]
    unequal = [pair for pair in zip(_rows(ours), _rows(theirs), strict=True) if pair[0] != pair[1]]
    if unequal:
        found.append(f"{len(unequal)} rows differ, first {unequal[0]}")
    return found
