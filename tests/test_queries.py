"""Every registered query against its SQL, and the counts the test tables are known to have."""

import os

import pytest

import __spark_entry__ as contract
from tests.conftest import rows
from verification.compare import connect, differences
from verification.oracle import ORACLE
from verification.queries import QUERIES, warehouse

SMALL = "/root/testdata/sf0.001"
FOLDER = os.environ.get("TEST_SF_DIR", SMALL)


@pytest.fixture(scope="module")
def database():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE) <= set(contract.oracle_sql())
    assert len(QUERIES) >= 62


@pytest.mark.parametrize("name", QUERIES)
def test_matches_sql(spark, database, name):
    result = contract.queries()[name](spark, FOLDER)
    assert differences(result, database, contract.oracle_sql()[name]) == []


def test_entry_returns_the_known_risk_counts(spark):
    assert {row["risk_category"]: row["txn_count"] for row in contract.entry(spark).collect()} == {
        "CHARGEBACK": 675,
        "HIGH_REFUND": 189,
        "FAILED": 38,
        "INVALID_AMOUNT": 16,
        "NORMAL": 582,
    }


def test_known_check_results(spark):
    found = {row["name"]: row["metric_value"] for row in warehouse(spark, SMALL).quality_report().collect()}
    assert list(found.values()) == [0, 0, 0, 15, 0, 186, 4, 812, 390, 16, 59, 190, 0]
    raw = contract.queries()["dq_raw_uniqueness"](spark, SMALL)
    assert {row["name"]: row["metric_value"] for row in raw.collect()} == {
        "transactions_uniqueness": 0,
        "refunds_uniqueness": 171,
        "chargebacks_uniqueness": 42,
    }


def test_known_row_counts(spark):
    counts = warehouse(spark, SMALL).gold_rows()
    assert counts["dim_date"] == 2500
    assert (counts["dim_merchant"], counts["dim_currency"], counts["dim_transaction_status"]) == (50, 3, 4)
    assert (counts["fact_transaction"], counts["fact_refund"], counts["fact_chargeback"]) == (1500, 1797, 935)


def test_net_is_gross_less_what_was_given_back(spark):
    facts = warehouse(spark, SMALL).gold("fact_transaction")
    broken = facts.where("abs(gross_amount - refund_amount - chargeback_amount - net_amount) > 0.001")
    assert rows(broken) == []
