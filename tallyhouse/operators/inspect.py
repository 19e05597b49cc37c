"""Looking at a table: what it holds, and its first rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.labels import mapped

PREVIEW_ROWS = 100


def profile(df: DataFrame) -> DataFrame:
    """Rows, and nulls per column, with the column's position and type; one pass over the table."""
    counts = df.agg(
        F.count(F.lit(1)).alias("row_count"),
        *(F.count_if(F.col(name).isNull()).alias(name) for name in df.columns),
    )
    long = counts.unpivot(["row_count"], df.columns, "column_name", "null_count")
    return long.select(
        mapped("column_name", {name: place for place, name in enumerate(df.columns, 1)}).alias("position"),
        "column_name",
        mapped("column_name", dict(df.dtypes)).alias("data_type"),
        "row_count",
        "null_count",
    )


def preview(df: DataFrame, rows: int = PREVIEW_ROWS) -> DataFrame:
    """The first rows of a table, for a look at the data; reads no more partitions than it needs."""
    return df.limit(rows)
