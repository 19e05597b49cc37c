"""Labels, risk, calendar and money expressions."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyhouse.functions.calendar import calendar_columns, date_key
from tallyhouse.functions.labels import currency_name, reason_category, risk_category, status_category, words
from tallyhouse.functions.money import amount_of, difference, rate_pct, total, units
from tests.conftest import rows


def test_reason_labels(spark):
    df = spark.createDataFrame(
        [("FRAUD_x",), ("a__b",), ("item_not_received",), ("goodwill",), (None,)], "reason string"
    )
    assert rows(df.select("reason", words(F.col("reason")), reason_category(F.col("reason")))) == [
        ("FRAUD_x", "Fraud X", "HIGH_RISK"),
        ("a__b", "A B", "OPERATIONAL"),
        ("goodwill", "Goodwill", "CUSTOMER"),
        ("item_not_received", "Item Not Received", "PRODUCT"),
        (None, None, "OPERATIONAL"),
    ]


def test_fraud_outranks_the_other_reason_groups(spark):
    df = spark.createDataFrame([("goodwill_fraud",), ("defective_item",), ("Defective_Item",)], "r string")
    assert rows(df.select("r", reason_category(F.col("r")))) == [
        ("Defective_Item", "OPERATIONAL"),
        ("defective_item", "PRODUCT"),
        ("goodwill_fraud", "HIGH_RISK"),
    ]


def test_status_and_currency_labels(spark):
    df = spark.createDataFrame([("settled", "USD"), ("voided", "EUR"), ("pending", None)], "s string, c string")
    assert rows(df.select(status_category(F.col("s")), currency_name(F.col("c")))) == [
        ("FAILURE", "EUR"),
        ("IN_PROGRESS", None),
        ("SUCCESS", "US Dollar"),
    ]


def test_risk_goes_to_the_strongest_category(spark):
    df = spark.createDataFrame(
        [
            ("half", 10.0, 5.0, 0.0, "settled"),
            ("more", 10.0, 5.01, 0.0, "failed"),
            ("invalid", None, 0.0, 3.0, "failed"),
            ("disputed", 10.0, 9.0, 0.01, "failed"),
            ("failed", 10.0, 0.0, 0.0, "voided"),
            ("unknown status", 10.0, 0.0, 0.0, None),
        ],
        "name string, amount double, refunded double, charged double, status string",
    )
    gross = F.coalesce("amount", F.lit(0.0))
    risk = risk_category(F.col("amount"), gross, F.col("refunded"), F.col("charged"), F.col("status"))
    assert dict(rows(df.select("name", risk))) == {
        "half": "NORMAL",
        "more": "HIGH_REFUND",
        "invalid": "INVALID_AMOUNT",
        "disputed": "CHARGEBACK",
        "failed": "FAILED",
        "unknown status": "NORMAL",
    }


def test_iso_weeks_and_weekdays_around_new_year(spark):
    days = spark.sql("SELECT explode(sequence(date'2024-12-28', date'2025-01-02')) AS d")
    columns = calendar_columns("d")
    picked = ("date_key", "year", "week_of_year", "day_of_week", "is_weekend", "year_month")
    assert rows(days.select(*(columns[name] for name in picked))) == [
        (20241228, 2024, 52, 6, 1, "2024-12"),
        (20241229, 2024, 52, 7, 1, "2024-12"),
        (20241230, 2024, 1, 1, 0, "2024-12"),
        (20241231, 2024, 1, 2, 0, "2024-12"),
        (20250101, 2025, 1, 3, 0, "2025-01"),
        (20250102, 2025, 1, 4, 0, "2025-01"),
    ]


def test_names_of_a_day(spark):
    day = spark.createDataFrame([(dt.date(2024, 2, 3),)], "d date")
    columns = calendar_columns("d")
    assert rows(day.select(*(columns[name] for name in ("quarter_name", "month_name", "month_abbr", "day_name", "day_of_month")))) == [
        ("Q1", "February", "Feb", "Saturday", 3)
    ]
    assert rows(spark.sql("SELECT cast(null AS date) d").select(date_key("d"))) == [(None,)]


def test_sums_do_not_depend_on_order(spark):
    df = spark.createDataFrame([(0.1,)] * 10 + [(4e14,), (-4e14,), (-0.0003,)], "x double")
    assert rows(df.agg(total("x"))) == [(0.9997,)]
    assert rows(df.where("1 = 0").agg(total("x"))) == [(None,)]


def test_amounts_off_the_grid_are_added_as_doubles(spark):
    df = spark.createDataFrame([(1e16,), (0.25,), (-3e15,), (0.5,)], "x double")
    assert rows(df.agg(total("x"))) == [(7_000_000_000_000_000.75,)]
    assert rows(df.where("x > 1e15").agg(total("x"))) == [(1e16,)]
    assert rows(spark.sql("SELECT double('Infinity') AS x UNION ALL SELECT 1").agg(total("x"))) == [(float("inf"),)]


def test_differences_are_exact_on_the_grid(spark):
    df = spark.createDataFrame([(0.3, 0.1), (1e16, 1.0), (None, 1.0), (5.0, None)], "a double, b double")
    assert rows(df.select(difference("a", "b"))) == [(0.2,), (1e16 - 1,), (None,), (None,)]


def test_amounts_that_are_no_money_are_off_the_grid(spark):
    df = spark.sql("SELECT explode(array(double('NaN'), double('Infinity'), 1e30, 2.5)) AS x")
    assert [value for (value,) in rows(df.select(units("x"))) if value is not None] == [25_000]


def test_sums_do_not_overflow(spark):
    """The sum of these amounts in ten-thousandths is far beyond 64 bits."""
    df = spark.range(0, 2_200_000, 1, 4).select(F.lit(900_000_000_000_000.0).alias("x"))
    assert rows(df.agg(total("x"))) == [(1.98e21,)]
    assert rows(df.agg(total(-F.col("x")))) == [(-1.98e21,)]


def test_amounts_finer_than_the_grid_are_not_rounded(spark):
    df = spark.range(0, 100_000, 1, 4).select(F.lit(0.00004).alias("x"))
    assert rows(df.agg(total("x"))) == [(4.0,)]
    assert rows(df.select(units("x")).distinct()) == [(None,)]


def test_mixed_amounts_add_alike_in_any_order(spark):
    amounts = [0.00004, 9e14, 1e17, 0.1, -1e17, 0.3, 1e-9, 12.34, -9e14] * 50
    orders = (amounts, amounts[::-1], sorted(amounts))
    found = {rows(spark.createDataFrame([(x,) for x in order], "x double").repartition(n).agg(total("x")))[0] for order in orders for n in (1, 7)}
    assert len(found) == 1
    assert abs(found.pop()[0] - 50 * 12.740040001) < 1e-6


def test_what_is_no_number_shows(spark):
    def of(*values):
        return rows(spark.createDataFrame([(v,) for v in values], "x double").agg(total("x")))[0][0]

    inf = float("inf")
    assert of(1.0, inf, 2.5) == inf and of(-inf, 3.0) == -inf
    assert of(inf, -inf) != of(inf, -inf) and of(float("nan"), 1.0) != of(float("nan"), 1.0)
    assert of(1e300, 1e300) == 2e300 and of(None) is None
    assert of(*[9e27] * 40) == 3.6e29


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-10**11, 10**11), min_size=1, max_size=30))
def test_sums_of_cents_are_exact(spark, cents):
    df = spark.createDataFrame([(value / 100,) for value in cents], "x double")
    assert rows(df.agg(total("x"))) == [(sum(cents) / 100,)]
    assert rows(df.select(amount_of(units("x")))) == sorted(((value / 100,) for value in cents), key=repr)


def test_rate_of_nothing_is_null(spark):
    df = spark.createDataFrame([(1, 3), (0, 0)], "part int, whole int")
    assert rows(df.select(rate_pct(F.col("part"), F.col("whole")))) == [(33.33,), (None,)]
