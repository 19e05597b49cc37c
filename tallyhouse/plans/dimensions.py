"""The six dimensions. Keys are dense and follow the order of the natural key."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.fixed_values import CURRENCY_DECIMALS, ENTITY_MEASURES
from tallyhouse.functions.calendar import calendar_columns
from tallyhouse.functions.labels import currency_name, reason_category, status_category, words
from tallyhouse.operators.dense_key import with_dense_key
from tallyhouse.sources.storage import Stored, TableStore


def date_bounds(silver: dict[str, DataFrame]) -> DataFrame:
    """First and last day over all entities, from one small row per entity."""
    per_entity = (
        df.agg(F.min(day).alias("min_d"), F.max(day).alias("max_d"))
        for df, day in ((silver[name], measures[0]) for name, measures in ENTITY_MEASURES.items())
    )
    return reduce(DataFrame.unionByName, per_entity).agg(F.min("min_d").alias("min_d"), F.max("max_d").alias("max_d"))


#: Days a calendar may span: ten thousand years. Longer ones come from a broken date.
MAX_DAYS = 3_660_000


def dim_date(silver: dict[str, DataFrame], max_days: int = MAX_DAYS) -> DataFrame:
    """One row per day between the bounds; no rows when no entity has a date.

    The bounds are two numbers, and the days between them a range that Spark deals over
    tasks. A span beyond `max_days` is refused by name, with the bounds to look for.
    """
    bounds = date_bounds(silver).select(F.unix_date("min_d").alias("low"), F.unix_date("max_d").alias("high")).first()
    spark = next(iter(silver.values())).sparkSession
    return calendar(spark, *((0, -1) if bounds["low"] is None else (bounds["low"], bounds["high"])), max_days)


def calendar(spark: SparkSession, low: int, high: int, max_days: int = MAX_DAYS) -> DataFrame:
    """One row per day from day `low` to day `high` of 1970."""
    if high - low >= max_days:
        raise ValueError(
            f"the calendar would span {high - low + 1} days, from day {low} to day {high} of 1970:"
            " see implausible_dates for the rows that cause it"
        )
    days = spark.range(low, high + 1).select(F.date_from_unix_date(F.col("id").cast("int")).alias("full_date"))
    return days.select(*(column.alias(name) for name, column in calendar_columns("full_date").items()))


def implausible_dates(silver: dict[str, DataFrame], first: str = "1900-01-01", last: str = "2100-12-31") -> DataFrame:
    """Per entity, the number of rows dated outside a plausible span; none is cut."""
    counts = []
    for name, measures in ENTITY_MEASURES.items():
        outside = (F.col(measures[0]) < F.lit(first).cast("date")) | (F.col(measures[0]) > F.lit(last).cast("date"))
        counts.append(silver[name].agg(F.count_if(outside).alias("metric_value")).select(F.lit(name).alias("entity"), "metric_value"))
    return reduce(DataFrame.unionByName, counts)


# Dimension -> (entity, source column, natural key, surrogate key, attributes of the natural key).
_CODED: dict[str, tuple[str, str, str, str, dict[str, Column]]] = {}


def _coded() -> dict:
    """Attribute expressions need a running session, so the table is filled on first use."""
    if not _CODED:
        merchant, currency = F.col("merchant_id"), F.col("currency_code")
        status, reason = F.col("status_code"), F.col("reason_code")
        _CODED.update(
            dim_merchant=(
                "transactions",
                "merchant_id",
                "merchant_id",
                "merchant_key",
                {"merchant_name": merchant, "merchant_category": F.lit("Unknown"), "status": F.lit("Active")},
            ),
            dim_currency=(
                "transactions",
                "currency",
                "currency_code",
                "currency_key",
                {"currency_name": currency_name(currency), "decimal_places": F.lit(CURRENCY_DECIMALS)},
            ),
            dim_transaction_status=(
                "transactions",
                "status",
                "status_code",
                "status_key",
                {"status_name": F.initcap(status), "status_category": status_category(status)},
            ),
            dim_refund_reason=(
                "refunds",
                "reason",
                "reason_code",
                "refund_reason_key",
                {"reason_name": words(reason), "reason_category": reason_category(reason)},
            ),
            dim_chargeback_reason=(
                "chargebacks",
                "reason_code",
                "reason_code",
                "chargeback_reason_key",
                {"reason_name": reason, "source_system": F.lit("CARD_NETWORK")},
            ),
        )
    return _CODED


def _codes(name: str, rows: DataFrame) -> DataFrame:
    _, column, code, _, _ = _coded()[name]
    return rows.select(F.col(column).alias(code)).where(F.col(code).isNotNull()).distinct()


def _described(name: str, keyed: DataFrame) -> DataFrame:
    _, _, code, key, attributes = _coded()[name]
    return keyed.select(key, code, *(value.alias(label) for label, value in attributes.items()))


def coded_dimension(name: str, silver: dict[str, DataFrame], store: TableStore) -> Stored:
    """Distinct non-null values of one column, keyed and described. The row count is known from writing it."""
    entity, _, code, key, _ = _coded()[name]
    keyed = with_dense_key(_codes(name, silver[entity]), code, key, store, f"keys/{name}", "int")
    return keyed._replace(df=_described(name, keyed.df))


def entity_of(name: str) -> str:
    """The entity whose codes a dimension lists."""
    return _coded()[name][0]


def added_codes(name: str, changed: DataFrame, known: DataFrame, last_key: int, store: TableStore) -> Stored:
    """Rows for codes of `changed` that the dimension `known` lacks, with the keys after `last_key`.

    Codes that no longer occur keep their rows, so a key never changes its meaning.
    """
    _, _, code, key, _ = _coded()[name]
    unknown = _codes(name, changed).join(known.select(code), code, "left_anti")
    keyed = with_dense_key(unknown, code, key, store, f"keys/added_{name}", "int")
    return keyed._replace(df=_described(name, keyed.df.withColumn(key, F.col(key) + F.lit(last_key))))
