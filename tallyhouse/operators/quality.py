"""The thirteen data quality checks and their summary.

The checks of a table are conditional counts of one aggregation, apart from
uniqueness, which has to bring equal keys together. Every aggregation yields a single row of counts, turned into (check, count) rows,
and a check fed by several tables is the sum of its contributions.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.fixed_values import ENTITY_KEYS, ENTITY_MEASURES, QUALITY_CHECKS
from tallyhouse.functions.labels import mapped
from tallyhouse.functions.money import difference
from tallyhouse.operators.skew import join_unique

_FOUND = "__found"


def as_rows(counts: DataFrame, name: str = "name", value: str = "metric_value") -> DataFrame:
    """One wide row of counts -> one row per count."""
    return counts.unpivot([], counts.columns, name, value)


def surplus_rows(df: DataFrame, key: str, name: str) -> DataFrame:
    """Rows beyond the first of each key; all rows without a key count as one key.

    An aggregation of its own: only keys and their counts are shuffled.
    """
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias(name))


def uniqueness(df: DataFrame, entity: str) -> DataFrame:
    return surplus_rows(df, ENTITY_KEYS[entity][1], f"{entity}_uniqueness")


def with_transaction(df: DataFrame, entity: str, transactions: DataFrame) -> DataFrame:
    """Refunds (or chargebacks) with the amount and date of their transaction.

    One transaction may hold very many refunds, so hot ids are split. `__found` is
    null where the transaction does not exist.
    """
    date_column, amount = ENTITY_MEASURES[entity]
    key = ENTITY_KEYS[entity][1]
    partner = transactions.select("transaction_id", "amount", "transaction_date", F.lit(True).alias(_FOUND))
    return join_unique(
        df.select(key, "transaction_id", amount, date_column), partner, "transaction_id", [key]
    )


def broken_rules(entity: str) -> dict[str, Column]:
    """Conditions over `with_transaction`; a comparison with a null never counts as broken."""
    date_column, amount = ENTITY_MEASURES[entity]
    short = entity.removesuffix("s")
    return {
        f"{entity}_referential_integrity": F.col(_FOUND).isNull(),
        f"{short}_amount_rule": F.col(amount) > F.col("amount"),
        f"{short}_date_rule": F.col(date_column) < F.col("transaction_date"),
    }


def violations(df: DataFrame, entity: str, transactions: DataFrame, rule: str) -> DataFrame:
    """The rows that break one rule."""
    return with_transaction(df, entity, transactions).where(broken_rules(entity)[rule]).drop(_FOUND)


def over_refunded() -> Column:
    """Refunds plus chargebacks exceed the transaction; the sum is exact."""
    given_back = (F.coalesce(name, F.lit(0.0)) for name in ("refund_amount", "chargeback_amount"))
    return difference("txn_amount", *given_back) < 0


def _measured(transactions: DataFrame, refunds: DataFrame, chargebacks: DataFrame, base: DataFrame) -> list[DataFrame]:
    amount = F.col("amount")
    size_gap = "reconciliation_row_count_integrity"
    found = [
        uniqueness(transactions, "transactions"),
        transactions.agg(
            F.count_if(amount.isNull()).alias("transaction_amount_not_null"),
            F.count_if(amount.isNull() | (amount <= 0)).alias("positive_amounts_rule"),
            (-F.count(F.lit(1))).alias(size_gap),
        ),
        base.agg(F.count_if(over_refunded()).alias("reconciled_total_amounts_rule"), F.count(F.lit(1)).alias(size_gap)),
    ]
    for entity, df in (("refunds", refunds), ("chargebacks", chargebacks)):
        own_amount = ENTITY_MEASURES[entity][1]
        found.append(uniqueness(df, entity))
        found.append(
            with_transaction(df, entity, transactions).agg(
                *(F.count_if(broken).alias(name) for name, broken in broken_rules(entity).items()),
                F.count_if(F.col(own_amount) <= 0).alias("positive_amounts_rule"),
            )
        )
    return found


def verdict(metric: Column) -> Column:
    return F.when(metric == 0, "PASS").otherwise("FAIL")


def quality_report(
    transactions: DataFrame, refunds: DataFrame, chargebacks: DataFrame, base: DataFrame
) -> DataFrame:
    """All checks in report order: name, description, metric_value, status."""
    found = [as_rows(counts) for counts in _measured(transactions, refunds, chargebacks, base)]
    metric = F.abs(F.sum("metric_value"))
    position = {name: number for number, name in enumerate(QUALITY_CHECKS)}
    return (
        reduce(DataFrame.unionByName, found)
        .groupBy("name")
        .agg(metric.alias("metric_value"))
        .orderBy(mapped("name", position))
        .select(
            "name",
            mapped("name", QUALITY_CHECKS).alias("description"),
            "metric_value",
            verdict(F.col("metric_value")).alias("status"),
        )
    )


def raw_uniqueness(raw: dict[str, DataFrame]) -> DataFrame:
    """Duplicates before deduplication, when there still are some."""
    found = reduce(DataFrame.unionByName, (as_rows(uniqueness(df, entity)) for entity, df in raw.items()))
    return found.withColumn("status", verdict(F.col("metric_value")))


def summarize(report: DataFrame) -> DataFrame:
    """Number of checks passed and failed, and the overall status."""
    failed = F.count_if(F.col("status") == "FAIL")
    return report.agg(
        F.count(F.lit(1)).alias("total_checks"),
        F.count_if(F.col("status") == "PASS").alias("passed"),
        failed.alias("failed"),
        verdict(failed).alias("status"),
    )


class QualityError(RuntimeError):
    """A check that must hold has failed."""


def require(report: DataFrame, names: tuple[str, ...]) -> None:
    """Raise if one of the named checks failed; the report has thirteen rows."""
    unknown = set(names) - set(QUALITY_CHECKS)
    if unknown:
        raise ValueError(f"unknown checks: {sorted(unknown)}")
    failed = [row["name"] for row in report.collect() if row["status"] == "FAIL" and row["name"] in names]
    if failed:
        raise QualityError(f"failed checks: {', '.join(failed)}")
