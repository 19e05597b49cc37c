"""Matching transactions with their refunds and chargebacks."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.fixed_values import ENTITY_KEYS, ENTITY_MEASURES, RECONCILIATION_COLUMNS
from tallyhouse.functions.money import total

_COUNTS = {"refunds": "refund_count", "chargebacks": "chargeback_count"}


def rollup(df: DataFrame, entity: str) -> DataFrame:
    """Amount, latest date and number of refunds (or chargebacks) per transaction.

    Sums are combined inside each map task before the shuffle, so a transaction
    with very many refunds sends one row per task.
    """
    date_column, amount = ENTITY_MEASURES[entity]
    return df.groupBy("transaction_id").agg(
        total(amount).alias(amount),
        F.max(date_column).alias(date_column),
        F.count(ENTITY_KEYS[entity][1]).alias(_COUNTS[entity]),
    )


def match(transactions: DataFrame, refunds: DataFrame, chargebacks: DataFrame, large: Collection[str] = ()) -> DataFrame:
    """Every transaction with both rollups beside it; nulls where there is none.

    All three inputs are unique per transaction when joined, so rows can neither
    multiply nor pile up on a key. Facts and the published base share this table.
    Rollups of entities named in `large` are not broadcast, however small their
    compressed files look.
    """
    paired = transactions
    for entity, df in (("refunds", refunds), ("chargebacks", chargebacks)):
        totals = rollup(df, entity)
        paired = paired.join(totals.hint("merge") if entity in large else totals, "transaction_id", "left")
    return paired


def reconciliation_base(matched: DataFrame) -> DataFrame:
    """The seven published columns of the matched table."""
    return matched.withColumnRenamed("amount", "txn_amount").select(*RECONCILIATION_COLUMNS)
