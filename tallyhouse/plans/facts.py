"""The three fact tables, before their surrogate key is dealt.

Columns named in `keep` pass through, so that rows can carry their place.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.fixed_values import ENTITY_KEYS, ENTITY_MEASURES, UNKNOWN_CURRENCY_KEY
from tallyhouse.functions.calendar import date_key
from tallyhouse.functions.labels import risk_category
from tallyhouse.functions.money import difference
from tallyhouse.operators.lookup import BROADCAST_ROWS, lookup_key
from tallyhouse.operators.standardize import ensure_column
from tallyhouse.sources.storage import Stored


# What the transaction fact needs of a transaction besides its rollups.
TRANSACTION_COLUMNS = (
    "transaction_id",
    "transaction_date",
    "amount",
    "merchant_id",
    "currency",
    "status",
    "source_system",
)


def fact_transaction(
    matched: DataFrame,
    dims: dict[str, Stored],
    broadcast_rows: int = BROADCAST_ROWS,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Measures, flags and risk of every transaction.

    `date_key` is computed from the date: the date dimension covers every day that
    occurs, so looking it up would return the same number.
    """
    gross, refunded, charged_back = (
        F.coalesce(name, F.lit(0.0)) for name in ("amount", "refund_amount", "chargeback_amount")
    )
    risk = risk_category(F.col("amount"), gross, refunded, charged_back, F.col("status"))
    rows = matched.select(
        "transaction_id",
        date_key("transaction_date").alias("date_key"),
        "merchant_id",
        "currency",
        "status",
        "transaction_date",
        gross.alias("gross_amount"),
        refunded.alias("refund_amount"),
        charged_back.alias("chargeback_amount"),
        difference(gross, refunded, charged_back).alias("net_amount"),
        F.coalesce("refund_count", F.lit(0)).cast("int").alias("refund_count"),
        F.coalesce("chargeback_count", F.lit(0)).cast("int").alias("chargeback_count"),
        (refunded > 0).cast("int").alias("has_refund"),
        (charged_back > 0).cast("int").alias("has_chargeback"),
        risk.alias("risk_category"),
        "source_system",
        *keep,
    )
    for dimension, code, dimension_code, key in (
        ("dim_merchant", "merchant_id", "merchant_id", "merchant_key"),
        ("dim_currency", "currency", "currency_code", "currency_key"),
        ("dim_transaction_status", "status", "status_code", "status_key"),
    ):
        rows = lookup_key(rows, dims[dimension], code, dimension_code, key, ["transaction_id"], broadcast_rows)
    return rows.select(
        "transaction_id",
        "date_key",
        "merchant_key",
        "currency_key",
        "status_key",
        "transaction_date",
        "gross_amount",
        "refund_amount",
        "chargeback_amount",
        "net_amount",
        "refund_count",
        "chargeback_count",
        "has_refund",
        "has_chargeback",
        "risk_category",
        "source_system",
        *keep,
    )


def _detail_fact(
    df: DataFrame,
    entity: str,
    dims: dict[str, Stored],
    reason: str,
    reason_dimension: str,
    reason_key: str,
    default_currency_key: int | None,
    broadcast_rows: int,
    keep: Sequence[str],
) -> DataFrame:
    own_key = ENTITY_KEYS[entity][1]
    day, amount = ENTITY_MEASURES[entity]
    rows = ensure_column(df, "currency", "string").select(
        own_key, "transaction_id", "merchant_id", "currency", day, amount, reason, "source_system", *keep
    )
    for dimension, code, dimension_code, key in (
        ("dim_merchant", "merchant_id", "merchant_id", "merchant_key"),
        ("dim_currency", "currency", "currency_code", "currency_key"),
        (reason_dimension, reason, "reason_code", reason_key),
    ):
        rows = lookup_key(rows, dims[dimension], code, dimension_code, key, [own_key], broadcast_rows)
    currency_key = F.coalesce("currency_key", F.lit(default_currency_key).cast("int"))
    return rows.select(
        own_key,
        "transaction_id",
        date_key(day).alias(f"{day}_key"),
        "merchant_key",
        currency_key.alias("currency_key"),
        reason_key,
        day,
        amount,
        reason,
        "source_system",
        *keep,
    )


def fact_refund(
    refunds: DataFrame,
    dims: dict[str, Stored],
    default_currency_key: int | None = UNKNOWN_CURRENCY_KEY,
    broadcast_rows: int = BROADCAST_ROWS,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Every refund with its keys; an unknown currency gets the default key."""
    rows = _detail_fact(
        refunds,
        "refunds",
        dims,
        "reason",
        "dim_refund_reason",
        "refund_reason_key",
        default_currency_key,
        broadcast_rows,
        keep,
    )
    return rows.withColumnRenamed("reason", "refund_reason_raw")


def fact_chargeback(
    chargebacks: DataFrame,
    dims: dict[str, Stored],
    default_currency_key: int | None = UNKNOWN_CURRENCY_KEY,
    broadcast_rows: int = BROADCAST_ROWS,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Every chargeback with its keys; an unknown currency gets the default key."""
    return _detail_fact(
        chargebacks,
        "chargebacks",
        dims,
        "reason_code",
        "dim_chargeback_reason",
        "chargeback_reason_key",
        default_currency_key,
        broadcast_rows,
        keep,
    )


# Fact -> dimensions whose keys it carries; its date key needs no lookup.
FACT_DIMENSIONS = {
    "fact_transaction": ("dim_merchant", "dim_currency", "dim_transaction_status"),
    "fact_refund": ("dim_merchant", "dim_currency", "dim_refund_reason"),
    "fact_chargeback": ("dim_merchant", "dim_currency", "dim_chargeback_reason"),
}

# Fact -> (key of the source rows, surrogate key).
FACT_KEYS = {
    "fact_transaction": ("transaction_id", "transaction_key"),
    "fact_refund": ("refund_id", "refund_key"),
    "fact_chargeback": ("chargeback_id", "chargeback_key"),
}
