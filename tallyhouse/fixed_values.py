"""Values that downstream users rely on and that therefore must not change.

Everything in this module is fixed: table and column names, code lists, labels,
check names and warehouse limits. Logic lives elsewhere.
"""

from __future__ import annotations

from dataclasses import dataclass

# Source entities, their watermark column and primary key.
ENTITY_KEYS = {
    "transactions": ("date", "transaction_id"),
    "refunds": ("date", "refund_id"),
    "chargebacks": ("date", "chargeback_id"),
}

# Entity -> (published date column, amount column).
ENTITY_MEASURES = {
    "transactions": ("transaction_date", "amount"),
    "refunds": ("refund_date", "refund_amount"),
    "chargebacks": ("chargeback_date", "chargeback_amount"),
}

# Columns of the matched base, in order.
RECONCILIATION_COLUMNS = (
    "transaction_id",
    "txn_amount",
    "transaction_date",
    "refund_amount",
    "refund_date",
    "chargeback_amount",
    "chargeback_date",
)

# Transaction status groups.
SUCCESS_STATUSES = ("settled", "completed")
FAILURE_STATUSES = ("failed", "voided")

# Refund reason groups.
PRODUCT_REASONS = ("defective_item", "item_not_received")
CUSTOMER_REASONS = ("customer_request", "goodwill")

# Risk categories of a transaction, strongest first.
RISK_CATEGORIES = (
    "INVALID_AMOUNT",
    "CHARGEBACK",
    "HIGH_REFUND",
    "FAILED",
    "NORMAL",
)

# Currency names that differ from the code, and decimal places.
CURRENCY_NAMES = {"USD": "US Dollar"}
CURRENCY_DECIMALS = 2

# Key given to a refund or chargeback whose currency is unknown.
UNKNOWN_CURRENCY_KEY = 1

# Fields of one audit row and one run-metrics row.
AUDIT_FIELDS = (
    "run_timestamp",
    "pipeline_run_id",
    "source_system",
    "source_table",
    "bronze_table",
    "bronze_path",
    "records_inserted",
    "status",
    "message",
)
METRIC_FIELDS = ("start_time", "end_time", "records_processed", "status")

# Quality checks in report order, name -> description.
QUALITY_CHECKS = {
    "transactions_uniqueness": "Check if transaction_id is unique in silver transactions",
    "refunds_uniqueness": "Check if refund_id is unique in silver refunds",
    "chargebacks_uniqueness": "Check if chargeback_id is unique in silver chargebacks",
    "refunds_referential_integrity": "Check if every refund's transaction_id exists in transactions",
    "chargebacks_referential_integrity": "Check if every chargeback's transaction_id exists in transactions",
    "refund_amount_rule": "Check if refund_amount is less than or equal to transaction amount",
    "chargeback_amount_rule": "Check if chargeback_amount is less than or equal to transaction amount",
    "refund_date_rule": "Check if refund_date is greater than or equal to transaction_date",
    "chargeback_date_rule": "Check if chargeback_date is greater than or equal to transaction_date",
    "transaction_amount_not_null": "Check if transaction amount is present (not null)",
    "positive_amounts_rule": "Check if all amounts (transactions, refunds, chargebacks) are positive",
    "reconciled_total_amounts_rule": "Check if sum of refunds and chargebacks is <= transaction amount",
    "reconciliation_row_count_integrity": "Check if base reconciliation table row count matches transactions count",
}


@dataclass(frozen=True)
class Field:
    """One published column: Spark type, optional text length, required or not."""

    name: str
    kind: str
    required: bool = False
    length: int | None = None
    references: str | None = None
    filled_with: float | None = None


def _int(name, required=False, references=None):
    return Field(name, "int", required, references=references)


def _long(name):
    return Field(name, "bigint", True)


def _text(name, length, required=False):
    return Field(name, "string", required, length=length)


def _day(name, required=False):
    return Field(name, "date", required)


def _money(name, filled_with=None):
    return Field(name, "double", filled_with is not None, filled_with=filled_with)


# Digits of a money column in the warehouse, total and after the point.
MONEY_DIGITS = (18, 2)

# The nine published tables, columns in order; the first is the primary key.
GOLD_TABLES = {
    "dim_date": (
        _int("date_key", True),
        _day("full_date", True),
        _int("year", True),
        _int("quarter", True),
        _text("quarter_name", 2, True),
        _int("month", True),
        _text("month_name", 20, True),
        _text("month_abbr", 3, True),
        _int("week_of_year", True),
        _int("day_of_week", True),
        _text("day_name", 10, True),
        _int("day_of_month", True),
        _int("is_weekend", True),
        _text("year_month", 7, True),
    ),
    "dim_merchant": (
        _int("merchant_key", True),
        _text("merchant_id", 64, True),
        _text("merchant_name", 255, True),
        _text("merchant_category", 64),
        _text("status", 32),
    ),
    "dim_currency": (
        _int("currency_key", True),
        _text("currency_code", 3, True),
        _text("currency_name", 64),
        _int("decimal_places"),
    ),
    "dim_transaction_status": (
        _int("status_key", True),
        _text("status_code", 32, True),
        _text("status_name", 64),
        _text("status_category", 32),
    ),
    "dim_refund_reason": (
        _int("refund_reason_key", True),
        _text("reason_code", 64, True),
        _text("reason_name", 128),
        _text("reason_category", 32),
    ),
    "dim_chargeback_reason": (
        _int("chargeback_reason_key", True),
        _text("reason_code", 16, True),
        _text("reason_name", 128),
        _text("source_system", 32),
    ),
    "fact_transaction": (
        _long("transaction_key"),
        _text("transaction_id", 64, True),
        _int("date_key", True, "dim_date"),
        _int("merchant_key", references="dim_merchant"),
        _int("currency_key", references="dim_currency"),
        _int("status_key", references="dim_transaction_status"),
        _day("transaction_date"),
        _money("gross_amount", filled_with=0.0),
        _money("refund_amount"),
        _money("chargeback_amount"),
        _money("net_amount"),
        _int("refund_count"),
        _int("chargeback_count"),
        _int("has_refund"),
        _int("has_chargeback"),
        _text("risk_category", 32),
        _text("source_system", 32),
    ),
    "fact_refund": (
        _long("refund_key"),
        _text("refund_id", 64, True),
        _text("transaction_id", 64, True),
        _int("refund_date_key", True, "dim_date"),
        _int("merchant_key", references="dim_merchant"),
        _int("currency_key", references="dim_currency"),
        _int("refund_reason_key", references="dim_refund_reason"),
        _day("refund_date"),
        _money("refund_amount", filled_with=0.0),
        _text("refund_reason_raw", 128),
        _text("source_system", 32),
    ),
    "fact_chargeback": (
        _long("chargeback_key"),
        _text("chargeback_id", 64, True),
        _text("transaction_id", 64, True),
        _int("chargeback_date_key", True, "dim_date"),
        _int("merchant_key", references="dim_merchant"),
        _int("currency_key", references="dim_currency"),
        _int("chargeback_reason_key", references="dim_chargeback_reason"),
        _day("chargeback_date"),
        _money("chargeback_amount", filled_with=0.0),
        _text("reason_code", 16),
        _text("source_system", 32),
    ),
}

# Gold names that change on the way to the warehouse.
PUBLISHED_NAMES = {"fact_refund": {"reason": "refund_reason_raw"}}
