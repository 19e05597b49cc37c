"""The three payment entities derived from the order tables used for testing.

The mapping plants defects on purpose (missing amounts, orphans, duplicate ids,
refunds dated before their transaction) so that every check has something to find.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _merchant(customer: Column) -> Column:
    return F.concat(F.lit("M"), F.lpad((customer % 50).cast("string"), 3, "0"))


def transactions(spark: SparkSession, folder: str) -> DataFrame:
    key, state = F.col("o_orderkey"), F.col("o_orderstatus")
    urgency = F.col("o_orderpriority")
    return table(spark, folder, "orders").select(
        key.cast("string").alias("transaction_id"),
        _merchant(F.col("o_custkey")).alias("merchant_id"),
        F.col("o_orderdate").cast("date").alias("date"),
        F.when(key % 97 != 0, F.col("o_totalprice")).alias("amount"),
        F.when(urgency == "1-URGENT", "EUR").when(urgency == "2-HIGH", "GBP").otherwise("USD").alias("currency"),
        F.when(state == "F", "settled")
        .when(state == "P", "pending")
        .when(key % 5 == 0, "failed")
        .otherwise("completed")
        .alias("status"),
    )


def _returned_lines(spark: SparkSession, folder: str, condition: Column) -> DataFrame:
    """Line items with their order's merchant. Orders are unique here, lines per order are not: AQE splits hot orders."""
    orders = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), _merchant(F.col("o_custkey")).alias("merchant_id")
    )
    return table(spark, folder, "lineitem").where(condition).join(orders, "l_orderkey")


def _line_id() -> Column:
    return F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))


def _price_times(factor: Column) -> Column:
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    return F.round(price * factor, 2).cast("double")


def refunds(spark: SparkSession, folder: str) -> DataFrame:
    discount = F.col("l_discount").cast("decimal(4,2)")
    orphan = F.when(F.col("l_orderkey") % 101 == 0, 100_000_000).otherwise(0)
    # Reason by line number; the seventh line has none.
    reasons = (
        "fraud_suspected",
        "defective_item",
        "item_not_received",
        "customer_request",
        "goodwill",
        "duplicate__charge",
    )
    return _returned_lines(spark, folder, F.col("l_returnflag") == "R").select(
        _line_id().alias("refund_id"),
        (F.col("l_orderkey") + orphan).cast("string").alias("transaction_id"),
        "merchant_id",
        F.col("l_shipdate").cast("date").alias("date"),
        _price_times(F.lit(1) - discount).alias("refund_amount"),
        F.try_element_at(F.array(*map(F.lit, reasons)), F.col("l_linenumber")).alias("reason"),
    )


def chargebacks(spark: SparkSession, folder: str) -> DataFrame:
    condition = (F.col("l_returnflag") == "A") & (F.col("l_linestatus") == "F")
    return _returned_lines(spark, folder, condition).select(
        _line_id().alias("chargeback_id"),
        F.col("l_orderkey").cast("string").alias("transaction_id"),
        "merchant_id",
        F.col("l_shipdate").cast("date").alias("date"),
        _price_times(F.col("l_discount").cast("decimal(4,2)")).alias("chargeback_amount"),
        F.concat(F.lit("10."), F.col("l_linenumber").cast("string")).alias("reason_code"),
    )


ENTITIES = {"transactions": transactions, "refunds": refunds, "chargebacks": chargebacks}
