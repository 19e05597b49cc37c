"""Standardizing, deduplicating and matching on hand-made rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators.dedup import cleaned, deduplicate, keep_first, survivor_order, without_key
from tallyhouse.operators.reconcile import match, reconciliation_base, rollup
from tallyhouse.operators.standardize import ensure_column, standardize
from tests.conftest import plan, rows

DAY = dt.date(2024, 1, 5)


def test_text_dates_and_amounts_become_typed_or_null(spark):
    raw = spark.createDataFrame(
        [(1, "2024-01-05", "10.5"), (2, "bad", "x"), (3, None, None)], "transaction_id int, date string, amount string"
    )
    typed = standardize(raw, "transactions")
    assert dict(typed.dtypes)["amount"] == "double"
    assert rows(typed.select("transaction_id", "transaction_date", "amount")) == [
        ("1", DAY, 10.5),
        ("2", None, None),
        ("3", None, None),
    ]


def test_a_timestamp_is_cut_to_its_day(spark):
    raw = spark.sql("SELECT 'r' refund_id, 1 transaction_id, timestamp_ntz'2024-01-05 23:59:00' date, 2 refund_amount")
    assert rows(standardize(raw, "refunds").select("refund_date", "refund_amount")) == [(DAY, 2.0)]


def test_the_published_date_column_wins_over_date(spark):
    raw = spark.createDataFrame(
        [("c", "1", dt.date(2020, 1, 1), DAY, 1.0)],
        "chargeback_id string, transaction_id string, date date, chargeback_date date, chargeback_amount double",
    )
    assert rows(standardize(raw, "chargebacks").select("chargeback_date")) == [(DAY,)]


def test_ensure_column_adds_a_null_column_only_when_missing(spark):
    df = spark.createDataFrame([("USD",)], "currency string")
    assert ensure_column(df, "currency", "string") is df
    assert rows(ensure_column(df, "other", "string")) == [("USD", None)]


REFUNDS = "refund_id string, transaction_id string, refund_date date, refund_amount double, note string"


def refunds(spark, *data):
    return spark.createDataFrame(list(data), REFUNDS)


def test_latest_date_then_largest_amount_survives(spark):
    df = refunds(
        spark,
        ("a", "1", DAY, 9.0, "older"),
        ("a", "1", DAY + dt.timedelta(1), 1.0, "newer"),
        ("b", "1", DAY, 1.0, "small"),
        ("b", "1", DAY, 2.0, "large"),
        ("c", "1", DAY, 1.0, "copy"),
        ("c", "1", DAY, 1.0, "copy"),
        ("d", "1", None, 5.0, "undated"),
        ("d", "1", DAY, None, "dated"),
    )
    assert rows(deduplicate(df, "refunds").select("refund_id", "note")) == [
        ("a", "newer"),
        ("b", "large"),
        ("c", "copy"),
        ("d", "dated"),
    ]


def test_remaining_ties_are_broken_by_the_other_columns(spark):
    tied = [("a", "1", DAY, 1.0, note) for note in ("z", "m", "b")]
    for order in (tied, tied[::-1], tied[1:] + tied[:1]):
        assert rows(deduplicate(refunds(spark, *order), "refunds").select("note")) == [("b",)]


def test_rows_without_key_are_kept_apart(spark):
    df = refunds(spark, (None, "1", DAY, 1.0, "x"), (None, "2", DAY, 2.0, "y"), ("a", "1", DAY, 1.0, "z"))
    assert rows(deduplicate(df, "refunds").select("note")) == [("z",)]
    assert rows(without_key(df, "refunds").select("note")) == [("x",), ("y",)]


def test_deduplication_is_idempotent(spark):
    df = spark.range(500).select(
        F.concat(F.lit("k"), F.col("id") % 40).alias("refund_id"),
        (F.col("id") % 7).cast("string").alias("transaction_id"),
        F.date_add(F.lit(DAY), (F.col("id") % 11).cast("int")).alias("refund_date"),
        (F.col("id") % 13).cast("double").alias("refund_amount"),
    )
    once = deduplicate(df, "refunds")
    assert once.count() == 40
    assert rows(deduplicate(once, "refunds")) == rows(once)


def test_duplicates_are_trimmed_before_the_shuffle(spark):
    df = refunds(spark, ("a", "1", DAY, 1.0, "x"))
    text = plan(keep_first(df, "refund_id", survivor_order(df, "refunds")))
    before_shuffle = text[text.index("Exchange") :]
    assert "WindowGroupLimit" in before_shuffle and "Partial" in before_shuffle


def shuffled_columns(df, node):
    """Columns that enter the first side of the uppermost `node` of the optimized plan."""
    at = df._jdf.queryExecution().optimizedPlan()
    while at.nodeName() != node:
        at = at.children().head()
    output = at.children().head().output()
    return {output.apply(i).name() for i in range(output.size())}


@pytest.mark.parametrize("kind", ["date", "string", "timestamp"])
def test_cleaned_rows_equal_typed_survivors(spark, kind):
    raw = refunds(spark, ("a", "1", DAY, 1.0, "x"), ("a", "1", DAY, 2.0, "y"), ("a", "2", None, 9.0, "z"), (None, "1", DAY, 1.0, ""), ("b", "1", None, None, ""))
    raw = raw.withColumn("date", F.col("refund_date").cast(kind)).drop("refund_date")
    usual = deduplicate(standardize(raw, "refunds"), "refunds")
    found = cleaned(raw, "refunds")
    assert found.dtypes == usual.dtypes
    assert rows(found) == rows(usual)
    assert ("date" in shuffled_columns(found, "Window")) == (kind != "date")


def test_a_published_date_beside_the_raw_one_is_cleaned_as_it_is(spark):
    raw = refunds(spark, ("a", "1", DAY, 1.0, "x"), ("a", "1", DAY, 1.0, "w")).withColumn("date", F.date_add("refund_date", F.length("note")))
    usual = deduplicate(standardize(raw, "refunds"), "refunds")
    found = cleaned(raw, "refunds")
    assert found.dtypes == usual.dtypes and rows(found) == rows(usual)


@pytest.fixture
def entities(spark):
    transactions = spark.createDataFrame(
        [("1", 100.0, DAY), ("2", 50.0, DAY), ("3", None, DAY), ("4", 10.0, None)],
        "transaction_id string, amount double, transaction_date date",
    )
    given_back = refunds(
        spark,
        ("r1", "1", DAY, 0.1, ""),
        ("r2", "1", DAY + dt.timedelta(2), 0.2, ""),
        ("r3", "2", DAY, None, ""),
        ("r4", None, DAY, 7.0, ""),
        ("r5", "99", DAY, 7.0, ""),
    )
    disputed = spark.createDataFrame(
        [("c1", "3", DAY, 3.0)], "chargeback_id string, transaction_id string, chargeback_date date, chargeback_amount double"
    )
    return transactions, given_back, disputed


def test_rollup_is_exact_and_counts_refunds_without_amount(entities):
    found = {row["transaction_id"]: tuple(row)[1:] for row in rollup(entities[1], "refunds").collect()}
    assert found["1"] == (0.3, DAY + dt.timedelta(2), 2)
    assert found["2"] == (None, DAY, 1)
    assert found[None] == (7.0, DAY, 1)


def test_every_transaction_appears_once_in_the_base(entities):
    base = reconciliation_base(match(*entities))
    assert base.columns == [
        "transaction_id",
        "txn_amount",
        "transaction_date",
        "refund_amount",
        "refund_date",
        "chargeback_amount",
        "chargeback_date",
    ]
    assert rows(base) == [
        ("1", 100.0, DAY, 0.3, DAY + dt.timedelta(2), None, None),
        ("2", 50.0, DAY, None, DAY, None, None),
        ("3", None, DAY, None, None, 3.0, DAY),
        ("4", 10.0, None, None, None, None, None),
    ]


def test_large_rollups_are_not_broadcast(entities):
    usual, large = match(*entities), match(*entities, large=("refunds", "chargebacks"))
    assert "BroadcastHashJoin" not in plan(large)
    assert rows(large) == rows(usual)
