"""One row per key, the same one on every run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.fixed_values import ENTITY_KEYS, ENTITY_MEASURES
from tallyhouse.operators.standardize import standardize
from tallyhouse.sources.bronze import LOADED_AT

_RANK = "__rank"
_UNORDERED = ("map", "variant")


def survivor_order(df: DataFrame, entity: str) -> list[Column]:
    """Latest load where there is a load time, then latest date, largest amount, transaction id, every other column.

    A row loaded again is a correction of what was loaded before. With every column in
    the order, two rows can only tie by being equal, so the survivor does not depend on
    how rows were distributed.
    """
    date_column, amount = ENTITY_MEASURES[entity]
    first = [F.desc(date_column), F.desc(amount), F.asc("transaction_id")]
    if LOADED_AT in df.columns:
        first.insert(0, F.desc_nulls_last(LOADED_AT))
    ranked = {LOADED_AT, date_column, amount, "transaction_id", ENTITY_KEYS[entity][1]}
    rest = [name for name, kind in df.dtypes if name not in ranked and not kind.startswith(_UNORDERED)]
    return first + [F.asc(name) for name in rest]


def keep_first(df: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """First row of each key.

    Spark trims every map task to one row per key before the shuffle (a partial
    window group limit), so a key with a third of all rows sends one row per task.
    """
    ranked = df.withColumn(_RANK, F.row_number().over(Window.partitionBy(key).orderBy(*order)))
    return ranked.where(F.col(_RANK) == 1).drop(_RANK)


def deduplicate(df: DataFrame, entity: str) -> DataFrame:
    """Surviving rows of an entity; rows without a key are left to `without_key`."""
    key = ENTITY_KEYS[entity][1]
    return keep_first(df.where(F.col(key).isNotNull()), key, survivor_order(df, entity))


def cleaned(df: DataFrame, entity: str) -> DataFrame:
    """Typed surviving rows of a raw entity.

    Where the published date is the raw `date`, already a date, one of the two equal
    columns is enough to tell rows apart, so the other is added after the shuffle.
    """
    day = ENTITY_MEASURES[entity][0]
    typed = standardize(df, entity)
    if day in df.columns or dict(df.dtypes).get("date") != "date":
        return deduplicate(typed, entity)
    return deduplicate(typed.drop("date"), entity).withColumn("date", F.col(day)).select(*typed.columns)


def without_key(df: DataFrame, entity: str) -> DataFrame:
    """Rows whose primary key is null: they cannot be matched and are kept apart."""
    return df.where(F.col(ENTITY_KEYS[entity][1]).isNull())
