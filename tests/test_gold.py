"""Star-schema details, writing, publishing and reports on hand-made rows."""

import datetime as dt
from decimal import Decimal
from pathlib import Path
from threading import Barrier

import pytest
from pyspark.sql import functions as F

from tallyhouse.fixed_values import ENTITY_MEASURES
from tallyhouse.plans import reports
from tallyhouse.plans.dimensions import dim_date, implausible_dates
from tallyhouse.plans.facts import fact_refund
from tallyhouse.plans.warehouse import FACTS, Warehouse
from tallyhouse.sources.bronze import add_audit_columns
from tallyhouse.sources.gold import clustered, publish, write_fact
from tests.conftest import plan, rows
from verification.queries import warehouse

SMALL = "/root/testdata/sf0.001"
DAY, LATER = dt.date(2024, 1, 30), dt.date(2024, 2, 2)


@pytest.fixture
def tiny(spark, store):
    """Three transactions; merchant m9 and currency JPY only occur in refunds."""
    bronze = {
        "transactions": spark.createDataFrame(
            [
                ("10", "m1", DAY, 100.0, "USD", "settled"),
                ("9", "m2", LATER, None, "EUR", "failed"),
                ("11", "m1", DAY, 40.0, None, "in_review"),
            ],
            "transaction_id string, merchant_id string, date date, amount double, currency string, status string",
        ),
        "refunds": spark.createDataFrame(
            [
                ("r1", "10", "m1", DAY, 20.0, "goodwill", "EUR"),
                ("r2", "10", "m9", LATER, None, None, "JPY"),
                ("r3", "11", None, DAY, None, "goodwill", None),
            ],
            "refund_id string, transaction_id string, merchant_id string, date date, refund_amount double, reason string, currency string",
        ),
        "chargebacks": spark.createDataFrame(
            [("c1", "9", "m2", LATER, 5.0, "10.4")],
            "chargeback_id string, transaction_id string, merchant_id string, date date, chargeback_amount double, reason_code string",
        ),
    }
    return Warehouse(spark, {name: add_audit_columns(df, "run", "CARDS") for name, df in bronze.items()}, store)


def test_transaction_fact(tiny):
    facts = tiny.gold("fact_transaction")
    picked = facts.select(
        "transaction_key", "transaction_id", "date_key", "merchant_key", "currency_key", "status_key",
        "gross_amount", "net_amount", "refund_count", "has_refund", "has_chargeback", "risk_category",
    )
    assert rows(picked) == [
        (1, "10", 20240130, 1, 2, 3, 100.0, 80.0, 2, 1, 0, "NORMAL"),
        (2, "11", 20240130, 1, None, 2, 40.0, 40.0, 1, 0, 0, "NORMAL"),
        (3, "9", 20240202, 2, 1, 1, 0.0, -5.0, 0, 0, 1, "INVALID_AMOUNT"),
    ]


def test_unknown_natural_keys(tiny):
    facts = tiny.gold("fact_refund")
    assert rows(facts.select("refund_id", "merchant_key", "currency_key", "refund_reason_key")) == [
        ("r1", 1, 1, 1),
        ("r2", None, 1, None),
        ("r3", None, 1, 1),
    ]
    honest = fact_refund(tiny.silver["refunds"], tiny.dims, default_currency_key=None)
    assert rows(honest.select("refund_id", "currency_key")) == [("r1", 1), ("r2", None), ("r3", None)]


def test_missing_currency_column_means_default_key(tiny):
    assert rows(tiny.gold("fact_chargeback").select("chargeback_id", "currency_key")) == [("c1", 1)]


def test_dates_cover_all_entities_without_gaps(tiny):
    assert rows(tiny.gold("dim_date").select("date_key")) == [(20240130,), (20240131,), (20240201,), (20240202,)]


def test_long_calendars_are_dealt_over_tasks_and_absurd_ones_refused(spark):
    def days(*dates):
        df = spark.createDataFrame([(d,) for d in dates], "d string").select(F.col("d").cast("date").alias("day"))
        return {entity: df.withColumnRenamed("day", measures[0]) for entity, measures in ENTITY_MEASURES.items()}

    long = dim_date(days("1995-01-01", "9999-12-31"))
    assert long.count() == 2_923_766 and long.rdd.getNumPartitions() > 1
    with pytest.raises(ValueError, match="implausible_dates"):
        dim_date(days("1995-01-01", "+500000-01-01"))
    assert rows(implausible_dates(days("1995-01-01", "9999-12-31", "1812-05-05"))) == [
        ("chargebacks", 2), ("refunds", 2), ("transactions", 2)
    ]


def test_no_dates_give_no_days(spark, store):
    empty = {
        "transactions": "transaction_id string, merchant_id string, date date, amount double, currency string, status string",
        "refunds": "refund_id string, transaction_id string, merchant_id string, date date, refund_amount double, reason string",
        "chargebacks": "chargeback_id string, transaction_id string, merchant_id string, date date, chargeback_amount double, reason_code string",
    }
    nothing = Warehouse(
        spark, {name: add_audit_columns(spark.createDataFrame([], kind), "r", "S") for name, kind in empty.items()}, store
    )
    assert set(nothing.gold_rows().values()) == {0}
    assert reports.kpis(nothing.gold).first()["refund_rate"] is None
    assert nothing.quality_report().count() == 13


def test_large_dimensions_give_the_same_facts(tiny):
    small = fact_refund(tiny.silver["refunds"], tiny.dims)
    large = fact_refund(tiny.silver["refunds"], tiny.dims, broadcast_rows=0)
    assert "__salt" in plan(large) and "__salt" not in plan(small)
    assert rows(small) == rows(large)


def test_a_warehouse_without_broadcasts_builds_the_same_facts(spark, store):
    usual = warehouse(spark, SMALL)
    shuffled = Warehouse(spark, usual.bronze, store, broadcast_rows=0)
    for name in FACTS:
        assert rows(shuffled.gold(name)) == rows(usual.gold(name))


def test_stored_tables_are_packed_tightly(tiny):
    stored = Path(tiny.stored_silver["refunds"].path).glob("*.parquet")
    assert all(file.name.endswith(".zstd.parquet") for file in stored)


def test_facts_of_one_report_are_built_side_by_side(tiny):
    both = Barrier(2)

    def gold(name):
        if name in ("fact_refund", "fact_chargeback"):
            both.wait(60)  # breaks when the other fact is asked for only afterwards
        return tiny.gold(name)

    assert rows(reports.refund_vs_chargeback(gold)) == [(DAY, 2, 0), (LATER, 1, 1)]


def test_rejected_rows_are_counted(spark, tiny):
    keyless = spark.createDataFrame([(None, "1", "m1", DAY, 1.0, "x", "USD")], tiny.bronze["refunds"].drop("load_timestamp", "pipeline_run_id", "source_system").schema)
    tiny.bronze["refunds"] = tiny.bronze["refunds"].unionByName(add_audit_columns(keyless, "run", "CARDS"))
    assert tiny.rejected_rows["refunds"] == 1
    assert tiny.silver["refunds"].count() == 3


def test_facts_are_built_without_a_single_task_step(spark):
    wh = warehouse(spark, SMALL)
    for name in FACTS:
        assert "SinglePartition" not in plan(wh.fact_rows(name))
        assert "SinglePartition" not in plan(wh.gold(name))


def test_reports_join_dimensions_after_aggregating(spark):
    text = plan(reports.executive_summary(warehouse(spark, SMALL).gold))
    assert text.index("Join") < text.index("HashAggregate")
    facts_scan = [line for line in text.splitlines() if "FileScan" in line and "gross_amount" in line]
    assert len(facts_scan) == 1 and "transaction_id" not in facts_scan[0].split("ReadSchema")[1]


def test_facts_are_written_by_month_and_sorted(spark, store, tiny):
    path = store.path("gold/fact_refund")
    assert write_fact(tiny.gold("fact_refund"), "fact_refund", path) == 3
    assert rows(spark.read.parquet(path).select("refund_id", "year_month")) == [("r1", 202401), ("r2", 202402), ("r3", 202401)]
    text = plan(clustered(tiny.gold("fact_refund"), "fact_refund"))
    assert "rangepartitioning(year_month" in text and "refund_key" in text


def test_refreshing_a_month_leaves_the_others(spark, store, tiny):
    path = store.path("gold/fact_refund")
    facts = tiny.gold("fact_refund")
    write_fact(facts, "fact_refund", path)
    february = facts.where("refund_date_key > 20240131").withColumn("refund_amount", F.lit(7.0))
    assert write_fact(february, "fact_refund", path, only_months_present=True) == 1
    assert rows(spark.read.parquet(path).select("refund_id", "refund_amount")) == [("r1", 20.0), ("r2", 7.0), ("r3", None)]


def test_publishing_replaces_the_target_through_a_stage(spark, tiny):
    spark.sql("CREATE DATABASE IF NOT EXISTS gold_test")
    try:
        assert publish(tiny.gold("fact_refund"), "fact_refund", "gold_test") == 3
        assert publish(tiny.gold("fact_refund").where("refund_id <> 'r1'"), "fact_refund", "gold_test") == 2
        assert publish(tiny.gold("dim_merchant"), "dim_merchant", "gold_test") == 2
        published = spark.table("gold_test.fact_refund")
        assert published.columns[:2] == ["REFUND_KEY", "REFUND_ID"]
        assert rows(published.select("REFUND_ID", "REFUND_AMOUNT")) == [("r2", Decimal("0.00")), ("r3", Decimal("0.00"))]
        assert dict(published.dtypes)["REFUND_AMOUNT"] == "decimal(18,2)"
        assert {table.name for table in spark.catalog.listTables("gold_test")} == {"fact_refund", "dim_merchant"}
    finally:
        spark.sql("DROP DATABASE gold_test CASCADE")


def test_failed_publish_leaves_the_target(spark, tiny):
    spark.sql("CREATE DATABASE IF NOT EXISTS gold_test")
    try:
        publish(tiny.gold("fact_refund"), "fact_refund", "gold_test")
        failing = tiny.gold("fact_refund").withColumn("refund_id", F.raise_error(F.lit("boom")).cast("string"))
        with pytest.raises(Exception, match="boom"):
            publish(failing, "fact_refund", "gold_test")
        assert spark.table("gold_test.fact_refund").count() == 3
        publish(tiny.gold("dim_merchant"), "dim_merchant", "gold_test")
        broken = tiny.gold("dim_merchant").withColumn("merchant_id", F.raise_error(F.lit("boom")).cast("string"))
        with pytest.raises(Exception, match="boom"):
            publish(broken, "dim_merchant", "gold_test")
        assert spark.table("gold_test.dim_merchant").count() == 2
    finally:
        spark.sql("DROP DATABASE gold_test CASCADE")


def test_slicers(tiny):
    def picked(**slicers):
        return sorted(row["transaction_id"] for row in reports.sliced_transactions(tiny.gold, **slicers).collect())

    assert picked() == ["10", "11", "9"]
    assert picked(start=dt.date(2024, 1, 31)) == ["9"]
    assert picked(end=dt.date(2024, 1, 31)) == ["10", "11"]
    assert picked(merchants=["m2", "m9"]) == ["9"]
    assert picked(statuses=["settled"]) == ["10"]
    assert picked(risks=["NORMAL"], merchants=["m1"], statuses=["in_review"]) == ["11"]
    assert picked(merchants=[]) == []


def test_reports_leave_out_unknown_merchants_and_keep_totals(tiny):
    assert rows(reports.merchant_risk(tiny.gold).select("merchant_id", "total_txns", "refund_rate_pct", "chargeback_rate_pct")) == [
        ("m1", 2, 50.0, 0.0),
        ("m2", 1, 0.0, 100.0),
    ]
    assert rows(reports.top_risk_merchants(tiny.gold, 1).select("merchant_id")) == [("m2",)]
    assert rows(reports.refund_vs_chargeback(tiny.gold)) == [(DAY, 2, 0), (LATER, 1, 1)]
    assert rows(reports.risk_by_merchant(tiny.gold)) == [("m1", 0, 0, 0, 0, 2), ("m2", 1, 0, 0, 0, 0)]
