"""Labels and ordered classification rules."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyhouse import fixed_values as fixed
from tallyhouse.functions.money import difference


def first_match(rules: Sequence[tuple[str, Column]], default: str) -> Column:
    """Label of the first rule that holds; a rule that is null does not hold."""
    fallback = F.lit(default)
    return reduce(
        lambda rest, rule: F.when(rule[1], F.lit(rule[0])).otherwise(rest), reversed(rules), fallback
    )


def mapped(column: str, values: dict) -> Column:
    """Value a small fixed dictionary has for a column, null where it has none."""
    pairs = (F.lit(item) for pair in values.items() for item in pair)
    return F.create_map(*pairs)[F.col(column)]


def words(code: Column) -> Column:
    """`item_not_received` -> `Item Not Received`."""
    spaced = F.initcap(F.translate(code, "_", " "))
    return F.replace(spaced, F.lit("  "), F.lit(" "))


def status_category(status: Column) -> Column:
    return first_match(
        [
            ("SUCCESS", status.isin(*fixed.SUCCESS_STATUSES)),
            ("FAILURE", status.isin(*fixed.FAILURE_STATUSES)),
        ],
        "IN_PROGRESS",
    )


def reason_category(reason: Column) -> Column:
    return first_match(
        [
            ("HIGH_RISK", F.contains(F.lower(reason), F.lit("fraud"))),
            ("PRODUCT", reason.isin(*fixed.PRODUCT_REASONS)),
            ("CUSTOMER", reason.isin(*fixed.CUSTOMER_REASONS)),
        ],
        "OPERATIONAL",
    )


def currency_name(code: Column) -> Column:
    return reduce(
        lambda rest, item: F.when(code == item[0], F.lit(item[1])).otherwise(rest),
        fixed.CURRENCY_NAMES.items(),
        code,
    )


def risk_category(amount: Column, gross: Column, refunded: Column, charged_back: Column, status: Column) -> Column:
    """Strongest risk of a transaction; a refund of exactly half the gross is normal."""
    tests = {
        "INVALID_AMOUNT": amount.isNull(),
        "CHARGEBACK": charged_back > 0,
        "HIGH_REFUND": difference(gross, refunded, refunded) < 0,
        "FAILED": status.isin(*fixed.FAILURE_STATUSES),
    }
    *ranked, default = fixed.RISK_CATEGORIES
    return first_match([(name, tests[name]) for name in ranked], default)
