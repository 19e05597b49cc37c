"""Typing raw entities: date, amount and ids. Bad text becomes null instead of an error."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.fixed_values import ENTITY_MEASURES


def standardize(df: DataFrame, entity: str) -> DataFrame:
    """Give an entity its published date column, a double amount and a string transaction id.

    The date is taken from the published column if the source has it, otherwise
    from `date`. All other columns pass through.
    """
    date_column, amount = ENTITY_MEASURES[entity]
    source = date_column if date_column in df.columns else "date"
    return df.withColumns(
        {
            date_column: F.col(source).try_cast("date"),
            amount: F.col(amount).try_cast("double"),
            "transaction_id": F.col("transaction_id").cast("string"),
        }
    )


def ensure_column(df: DataFrame, name: str, kind: str) -> DataFrame:
    """Add a null column when the source does not carry it."""
    return df if name in df.columns else df.withColumn(name, F.lit(None).cast(kind))
