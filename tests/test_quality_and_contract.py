"""Checks and the table contract on hand-made rows."""

import datetime as dt
import re

import pytest

from tallyhouse.fixed_values import GOLD_TABLES, QUALITY_CHECKS
from tallyhouse.operators.contract import (
    ContractError,
    column_violations,
    contract_violations,
    foreign_key_violations,
    prepare,
    primary_key_violations,
)
from tallyhouse.operators.inspect import preview, profile
from tallyhouse.operators.quality import QualityError, quality_report, raw_uniqueness, require, summarize, violations
from tallyhouse.operators.reconcile import match, reconciliation_base
from tests.conftest import plan, rows
from verification.queries import warehouse

DAY, NEXT = dt.date(2024, 1, 5), dt.date(2024, 1, 6)


@pytest.fixture
def entities(spark):
    transactions = spark.createDataFrame(
        [("1", 100.0, NEXT), ("2", 50.0, DAY), ("3", None, DAY), ("4", 0.0, None), ("4", 5.0, DAY), (None, 1.0, DAY)],
        "transaction_id string, amount double, transaction_date date",
    )
    refunds = spark.createDataFrame(
        [
            ("r1", "1", 100.0, DAY),  # before its transaction
            ("r2", "1", 100.01, NEXT),  # too much
            ("r3", "3", 5.0, DAY),  # amount unknown: not counted
            ("r4", None, 5.0, DAY),  # orphan without id
            ("r5", "99", -1.0, DAY),  # orphan, not positive
            ("r6", "2", None, None),  # nulls are not counted
            (None, "2", 1.0, DAY),
            (None, "2", 1.0, DAY),  # second row without key
        ],
        "refund_id string, transaction_id string, refund_amount double, refund_date date",
    )
    chargebacks = spark.createDataFrame(
        [("c1", "2", 60.0, DAY)], "chargeback_id string, transaction_id string, chargeback_amount double, chargeback_date date"
    )
    return transactions, refunds, chargebacks


def test_all_thirteen_checks(entities):
    transactions, refunds, chargebacks = entities
    transactions = transactions.dropDuplicates(["transaction_id"]).where("transaction_id IS NOT NULL")
    # dropDuplicates keeps either row of id 4; both are dated or not, neither is refunded.
    base = reconciliation_base(match(transactions, refunds, chargebacks))
    report = quality_report(transactions, refunds, chargebacks, base)
    assert report.columns == ["name", "description", "metric_value", "status"]
    found = report.collect()
    assert [row["name"] for row in found] == list(QUALITY_CHECKS)
    assert [row["description"] for row in found] == list(QUALITY_CHECKS.values())
    metrics = {row["name"]: row["metric_value"] for row in found}
    positive = metrics.pop("positive_amounts_rule")
    assert positive in (2, 3)
    assert metrics == {
        "transactions_uniqueness": 0,
        "refunds_uniqueness": 1,
        "chargebacks_uniqueness": 0,
        "refunds_referential_integrity": 2,
        "chargebacks_referential_integrity": 0,
        "refund_amount_rule": 1,
        "chargeback_amount_rule": 1,
        "refund_date_rule": 1,
        "chargeback_date_rule": 0,
        "transaction_amount_not_null": 1,
        "reconciled_total_amounts_rule": 2,
        "reconciliation_row_count_integrity": 0,
    }
    assert {row["name"] for row in found if row["status"] == "PASS"} == {
        name for name, metric in metrics.items() if metric == 0
    }


def test_a_base_of_another_size_is_reported(entities):
    transactions, refunds, chargebacks = entities
    base = reconciliation_base(match(transactions, refunds, chargebacks))
    report = quality_report(transactions, refunds, chargebacks, base.where("transaction_id = '1'"))
    metrics = {row["name"]: row["metric_value"] for row in report.collect()}
    assert metrics["reconciliation_row_count_integrity"] == 5
    assert metrics["transactions_uniqueness"] == 1


def test_checks_of_empty_tables_pass(entities):
    empty = [df.where("1 = 0") for df in entities]
    report = quality_report(*empty, reconciliation_base(match(*empty)))
    assert rows(summarize(report)) == [(13, 13, 0, "PASS")]


def test_rows_that_break_a_rule(entities):
    transactions, refunds, _ = entities
    late = violations(refunds, "refunds", transactions, "refund_date_rule")
    assert rows(late.select("refund_id", "transaction_id", "transaction_date")) == [("r1", "1", NEXT)]


def test_summary_and_required_checks(entities):
    transactions, refunds, chargebacks = entities
    report = quality_report(transactions, refunds, chargebacks, reconciliation_base(match(*entities)))
    total, passed, failed, status = rows(summarize(report))[0]
    assert (total, status) == (13, "FAIL") and passed + failed == 13
    require(report, ())
    require(report, ("chargeback_date_rule",))
    with pytest.raises(QualityError, match="refund_amount_rule"):
        require(report, ("refund_amount_rule", "chargeback_date_rule"))
    with pytest.raises(ValueError, match="unknown"):
        require(report, ("no_such_check",))


def test_raw_uniqueness_counts_before_deduplication(entities):
    found = raw_uniqueness(dict(zip(("transactions", "refunds", "chargebacks"), entities, strict=True)))
    assert rows(found) == [
        ("chargebacks_uniqueness", 0, "PASS"),
        ("refunds_uniqueness", 1, "FAIL"),
        ("transactions_uniqueness", 1, "FAIL"),
    ]


def test_profile_counts_nulls_per_column(spark):
    df = spark.createDataFrame([("a", None), (None, None), ("b", 1)], "x string, y int")
    assert rows(profile(df)) == [(1, "x", "string", 3, 1), (2, "y", "int", 3, 2)]
    assert preview(spark.range(250)).count() == 100
    assert preview(df, 2).count() == 2


def refund_fact(spark, *data):
    schema = (
        "refund_key bigint, refund_id string, transaction_id string, refund_date_key string, merchant_key double,"
        " currency_key int, refund_reason_key bigint, refund_date date, refund_amount double, reason string, source_system string"
    )
    return spark.createDataFrame(list(data), schema)


def test_prepare_renames_fills_coerces_and_upper_cases(spark):
    df = refund_fact(
        spark,
        (1, "a", "1", "20240105", 2.0, 1, 3, DAY, None, "why", "S"),
        (2, "b", "1", "soon", 2.5, 1, 2**40, DAY, float("nan"), None, "S"),
        (3, "c", "1", "20240105.0", None, None, None, None, 7.5, "why", None),
    )
    shaped = prepare(df.withColumn("extra", df.refund_id), "fact_refund")
    assert shaped.columns == [field.name.upper() for field in GOLD_TABLES["fact_refund"]]
    assert rows(shaped.select("REFUND_KEY", "REFUND_DATE_KEY", "MERCHANT_KEY", "REFUND_REASON_KEY", "REFUND_AMOUNT", "REFUND_REASON_RAW")) == [
        (1, 20240105, 2, 3, 0.0, "why"),
        (2, None, None, None, 0.0, None),
        (3, 20240105, None, None, 7.5, "why"),
    ]
    assert dict(shaped.dtypes)["REFUND_DATE_KEY"] == "int"


def test_prepare_names_missing_columns(spark):
    df = refund_fact(spark).drop("source_system", "currency_key")
    with pytest.raises(ContractError, match=r"fact_refund.*currency_key.*source_system"):
        prepare(df, "fact_refund")


def test_contract_violations_are_counted_per_column(spark):
    facts = refund_fact(
        spark,
        (1, "a", "1", "20240105", 1.0, 9, 1, DAY, 1.0, "x" * 129, "S"),
        (1, None, "1", None, 1.0, None, 1, DAY, 1e16, None, "S"),
        (2, "y" * 65, "1", "20240105", 7.0, 1, None, DAY, -1e17, None, "S"),
    )
    tables = {
        "dim_date": spark.sql("SELECT 20240105 AS date_key"),
        "dim_merchant": spark.sql("SELECT 1 AS merchant_key"),
        "dim_currency": spark.sql("SELECT 1 AS currency_key"),
        "dim_refund_reason": spark.sql("SELECT 1 AS refund_reason_key"),
        "fact_refund": prepare(facts, "fact_refund", upper_names=False),
    }
    table = tables["fact_refund"]
    own = {(row["rule"], row["column_name"]): row["violations"] for row in column_violations(table, "fact_refund").collect()}
    assert {key: count for key, count in own.items() if count} == {
        ("not_null", "refund_id"): 1,
        ("not_null", "refund_date_key"): 1,
        ("max_length", "refund_reason_raw"): 1,
        ("max_length", "refund_id"): 1,
        ("precision", "refund_amount"): 2,
    }
    columns = ("table_name", "column_name", "violations")
    assert rows(foreign_key_violations(tables).select(*columns)) == [
        ("fact_refund", "currency_key", 1),
        ("fact_refund", "merchant_key", 1),
        ("fact_refund", "refund_date_key", 0),
        ("fact_refund", "refund_reason_key", 0),
    ]
    assert ("fact_refund", "refund_key", 1) in rows(primary_key_violations(tables).select(*columns))


def test_contract_keys_are_shuffled_once(spark):
    keys = "refund_key bigint, refund_date_key int, merchant_key int, currency_key int, refund_reason_key int"
    data = [(1, 1, 5, 1, 1), (1, 1, 5, 1, 1), (None, None, 1, 2, 1), (None, 2, None, 2, 1), (None, 3, 1, 1, 7)]
    fields = {field.name: field.kind for field in GOLD_TABLES["fact_refund"]}
    facts = spark.createDataFrame(data, keys).selectExpr(
        *(name if name.endswith("_key") else f"CAST(NULL AS {kind}) AS {name}" for name, kind in fields.items())
    )
    tables = {
        "dim_date": spark.sql("SELECT explode(array(1, 1, 3, NULL, NULL)) AS date_key"),
        "dim_merchant": spark.sql("SELECT 1 AS merchant_key"),
        "dim_currency": spark.sql("SELECT 1 AS currency_key"),
        "dim_refund_reason": spark.sql("SELECT 1 AS refund_reason_key"),
        "fact_refund": facts,
    }
    columns = ("table_name", "column_name", "violations")
    found = foreign_key_violations(tables)
    assert rows(found.select(*columns)) == [
        ("fact_refund", "currency_key", 2),
        ("fact_refund", "merchant_key", 2),
        ("fact_refund", "refund_date_key", 1),
        ("fact_refund", "refund_reason_key", 1),
    ]
    assert rows(primary_key_violations(tables).select(*columns)) == [
        ("dim_currency", "currency_key", 0),
        ("dim_date", "date_key", 2),
        ("dim_merchant", "merchant_key", 0),
        ("dim_refund_reason", "refund_reason_key", 0),
        ("fact_refund", "refund_key", 3),
    ]
    assert len(re.findall(r"Exchange hashpartitioning\([^)]*\bkey#", plan(found))) == 1


def test_rules_of_empty_tables_are_listed(spark):
    tables = {
        name: spark.createDataFrame([], ", ".join(f"{field.name} {field.kind}" for field in fields))
        for name, fields in GOLD_TABLES.items()
    }
    found = contract_violations(tables).collect()
    expected = sum(
        1 + sum(f.required + (f.length is not None) + (f.kind == "double") + (f.references is not None) for f in fields)
        for fields in GOLD_TABLES.values()
    )
    assert len(found) == expected
    assert {row["violations"] for row in found} == {0}


def test_contract_scans_each_table_once(spark):
    tables = warehouse(spark, "/root/testdata/sf0.001").gold_tables()
    assert plan(contract_violations(tables)).count("FileScan") == len(GOLD_TABLES)
