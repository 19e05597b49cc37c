"""Reports over the star schema.

Facts are aggregated by surrogate key before any dimension is joined. A surrogate
key stands for exactly one natural key, so the result is the same, while the join
handles one row per key instead of one per fact and no hot merchant can slow it.
Inner joins leave out facts whose key is unknown.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.fixed_values import RISK_CATEGORIES
from tallyhouse.functions.calendar import date_key
from tallyhouse.functions.money import rate_pct, total
from tallyhouse.plans.warehouse import together

Gold = Callable[[str], DataFrame]


def _side_by_side(gold: Gold, names: Sequence[str]) -> dict[str, DataFrame]:
    """Several tables of a report; those that are not built yet are built at the same time."""
    found: dict[str, DataFrame] = {}
    together(SparkSession.active(), (lambda name=name: found.update({name: gold(name)}) for name in names))
    return found


def _count() -> Column:
    return F.count(F.lit(1))


def _flagged(name: str) -> Column:
    return F.sum(F.col(name).cast("bigint"))


_AMOUNTS = {
    "revenue": "gross_amount",
    "refunds": "refund_amount",
    "chargebacks": "chargeback_amount",
    "net_revenue": "net_amount",
}


def _sums(*names: str) -> list[Column]:
    return [total(_AMOUNTS[name]).alias(name) for name in names or _AMOUNTS]


def _by_day(rows: DataFrame, gold: Gold, key: str = "date_key") -> DataFrame:
    days = gold("dim_date").select("date_key", "full_date", "year", "month", "year_month")
    return rows.join(days.withColumnRenamed("date_key", key), key)


def _by_merchant(rows: DataFrame, gold: Gold) -> DataFrame:
    return rows.join(gold("dim_merchant").select("merchant_key", "merchant_id"), "merchant_key")


def executive_summary(gold: Gold) -> DataFrame:
    """Money and counts per day and merchant."""
    facts = (
        gold("fact_transaction")
        .groupBy("date_key", "merchant_key")
        .agg(
            *_sums(),
            _count().alias("txn_count"),
            _flagged("has_refund").alias("txn_with_refund"),
            _flagged("has_chargeback").alias("txn_with_chargeback"),
        )
    )
    return _by_merchant(_by_day(facts, gold), gold).select(
        "full_date",
        "year",
        "month",
        "year_month",
        "merchant_id",
        *_AMOUNTS,
        "txn_count",
        "txn_with_refund",
        "txn_with_chargeback",
    )


def merchant_risk(gold: Gold) -> DataFrame:
    """Totals and refund and chargeback rates per merchant."""
    facts = (
        gold("fact_transaction")
        .groupBy("merchant_key")
        .agg(
            _count().alias("total_txns"),
            total("gross_amount").alias("total_revenue"),
            total("refund_amount").alias("total_refunds"),
            total("chargeback_amount").alias("total_chargebacks"),
            total("net_amount").alias("net_revenue"),
            rate_pct(F.sum("has_refund"), _count()).alias("refund_rate_pct"),
            rate_pct(F.sum("has_chargeback"), _count()).alias("chargeback_rate_pct"),
            F.count_if(F.col("risk_category") == "CHARGEBACK").alias("chargeback_txns"),
        )
    )
    columns = facts.columns[1:]
    return _by_merchant(facts, gold).select("merchant_id", *columns)


def kpis(gold: Gold) -> DataFrame:
    """One row of headline figures; rates are fractions, null without transactions."""
    return gold("fact_transaction").agg(
        *_sums(),
        _count().alias("total_transactions"),
        F.try_divide(_flagged("has_refund").cast("double"), _count().cast("double")).alias("refund_rate"),
        F.try_divide(_flagged("has_chargeback").cast("double"), _count().cast("double")).alias("chargeback_rate"),
    )


def revenue_trend(gold: Gold) -> DataFrame:
    facts = gold("fact_transaction").groupBy("date_key").agg(*_sums("revenue", "net_revenue"))
    return _by_day(facts, gold).select("full_date", "revenue", "net_revenue")


def merchant_performance(gold: Gold) -> DataFrame:
    """Revenue per merchant with refunds, chargebacks and their rates."""
    return merchant_risk(gold).select(
        "merchant_id",
        F.col("total_revenue").alias("revenue"),
        "net_revenue",
        F.col("total_refunds").alias("refunds"),
        F.col("total_chargebacks").alias("chargebacks"),
        "refund_rate_pct",
        "chargeback_rate_pct",
    )


def risk_by_merchant(gold: Gold) -> DataFrame:
    """Transactions per merchant and risk category, one column per category."""
    risk = F.col("risk_category")
    counts = [F.count_if(risk == name).alias(name.lower()) for name in RISK_CATEGORIES]
    facts = gold("fact_transaction").groupBy("merchant_key").agg(*counts)
    return _by_merchant(facts, gold).select("merchant_id", *(name.lower() for name in RISK_CATEGORIES))


def risk_summary(gold: Gold) -> DataFrame:
    """Transactions and net revenue per risk category."""
    return (
        gold("fact_transaction")
        .groupBy("risk_category")
        .agg(_count().alias("txn_count"), total("net_amount").alias("net_revenue"))
    )


def chargeback_reasons(gold: Gold) -> DataFrame:
    """Chargebacks per reason."""
    facts = (
        gold("fact_chargeback")
        .groupBy("chargeback_reason_key")
        .agg(_count().alias("chargeback_count"), total("chargeback_amount").alias("chargeback_amount"))
    )
    reasons = gold("dim_chargeback_reason").select("chargeback_reason_key", "reason_code", "reason_name")
    return facts.join(reasons, "chargeback_reason_key").select(
        "reason_code", "reason_name", "chargeback_count", "chargeback_amount"
    )


def chargeback_trend(gold: Gold) -> DataFrame:
    facts = (
        gold("fact_chargeback")
        .groupBy("chargeback_date_key")
        .agg(_count().alias("chargeback_count"), total("chargeback_amount").alias("chargeback_amount"))
    )
    return _by_day(facts, gold, "chargeback_date_key").select("full_date", "chargeback_count", "chargeback_amount")


def top_risk_merchants(gold: Gold, limit: int = 10) -> DataFrame:
    """Merchants with the highest chargeback rate; ties go to the smaller id."""
    return (
        merchant_risk(gold)
        .select("merchant_id", "chargeback_rate_pct", "chargeback_txns", "total_txns")
        .orderBy(F.desc("chargeback_rate_pct"), "merchant_id")
        .limit(limit)
    )


def operational_metrics(gold: Gold) -> DataFrame:
    """Volume and average amount per day."""
    facts = (
        gold("fact_transaction")
        .groupBy("date_key")
        .agg(
            _count().alias("txn_count"),
            F.try_divide(total("gross_amount"), F.count("gross_amount").cast("double")).alias("avg_amount"),
        )
    )
    return _by_day(facts, gold).select("full_date", "txn_count", "avg_amount")


def status_breakdown(gold: Gold) -> DataFrame:
    facts = (
        gold("fact_transaction")
        .groupBy("status_key")
        .agg(_count().alias("txn_count"), *_sums("revenue", "net_revenue"))
    )
    return facts.join(gold("dim_transaction_status"), "status_key").select(
        "status_code", "status_name", "status_category", "txn_count", "revenue", "net_revenue"
    )


def refund_vs_chargeback(gold: Gold) -> DataFrame:
    """Refunds and chargebacks per day, zero where only the other kind occurred."""
    facts, parts = _side_by_side(gold, ("fact_refund", "fact_chargeback")), []
    for name, key, column in (
        ("fact_refund", "refund_date_key", "refund_count"),
        ("fact_chargeback", "chargeback_date_key", "chargeback_count"),
    ):
        counts = facts[name].groupBy(F.col(key).alias("date_key")).agg(_count().alias(column))
        parts.append(counts)
    refunds, chargebacks = parts
    both = (
        refunds.unionByName(chargebacks, allowMissingColumns=True)
        .groupBy("date_key")
        .agg(
            F.coalesce(F.sum("refund_count"), F.lit(0)).alias("refund_count"),
            F.coalesce(F.sum("chargeback_count"), F.lit(0)).alias("chargeback_count"),
        )
    )
    return _by_day(both, gold).select("full_date", "refund_count", "chargeback_count")


def sliced_transactions(
    gold: Gold,
    start: date | None = None,
    end: date | None = None,
    merchants: Sequence[str] | None = None,
    statuses: Sequence[str] | None = None,
    risks: Sequence[str] | None = None,
) -> DataFrame:
    """Transaction facts narrowed by the report slicers; a slicer that is not set lets everything pass.

    Date and risk are filters on the scan. Merchant and status are picked in their
    dimension first; what is left has at most as many rows as values were asked
    for, so it is broadcast.
    """
    facts = gold("fact_transaction")
    if start is not None:
        facts = facts.where(F.col("date_key") >= date_key(F.lit(start)))
    if end is not None:
        facts = facts.where(F.col("date_key") <= date_key(F.lit(end)))
    if risks is not None:
        facts = facts.where(F.col("risk_category").isin(*risks))
    for values, dimension, code, key in (
        (merchants, "dim_merchant", "merchant_id", "merchant_key"),
        (statuses, "dim_transaction_status", "status_code", "status_key"),
    ):
        if values is not None:
            picked = gold(dimension).where(F.col(code).isin(*values)).select(key)
            facts = facts.join(F.broadcast(picked), key, "left_semi")
    return facts


def sliced_summary(gold: Gold, **slicers) -> DataFrame:
    """Money and volume of the sliced transactions per merchant and risk category."""
    facts = (
        sliced_transactions(gold, **slicers)
        .groupBy("merchant_key", "risk_category")
        .agg(_count().alias("txn_count"), *_sums())
    )
    return _by_merchant(facts, gold).select("merchant_id", "risk_category", "txn_count", *_AMOUNTS)


def row_counts(gold: Gold, tables: Sequence[str]) -> DataFrame:
    """Rows per table."""
    built = _side_by_side(gold, tables)
    first, *rest = (built[name].agg(_count().alias("row_count")).select(F.lit(name).alias("table_name"), "row_count") for name in tables)
    for counted in rest:
        first = first.union(counted)
    return first
