"""Refreshing from new loads: equal to a full rebuild, keys that stay, and files that are not touched."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators.incremental import entity_specs
from tallyhouse.plans import refresh as plan_module
from tallyhouse.plans.bronze_load import BronzeLoader
from tallyhouse.plans.refresh import refresh
from tallyhouse.plans.warehouse import FACTS, Warehouse
from tallyhouse.sources.buckets import BucketedTable
from tests.conftest import plan, rows

SPECS = entity_specs({entity: {"watermark_column": "updated"} for entity in ("transactions", "refunds", "chargebacks")})
SCHEMAS = {
    "transactions": "transaction_id string, merchant_id string, date date, amount double, currency string, status string, updated int",
    "refunds": "refund_id string, transaction_id string, merchant_id string, date date, refund_amount double, reason string, currency string, updated int",
    "chargebacks": "chargeback_id string, transaction_id string, merchant_id string, date date, chargeback_amount double, reason_code string, updated int",
}
NATURAL = {
    "fact_transaction": ("merchant_id", "currency_code", "status_code"),
    "fact_refund": ("merchant_id", "currency_code", "reason_code"),
    "fact_chargeback": ("merchant_id", "currency_code", "reason_code"),
}


def first_load():
    draw = random.Random(1)
    day = lambda: dt.date(2024, 1, 1) + dt.timedelta(days=draw.randrange(180))
    amount = lambda: draw.randrange(1, 100_000) / 100
    transactions = [(f"t{i:03}", f"m{i % 7}", day(), amount(), ["EUR", "USD"][i % 2], ["settled", "failed"][i % 5 == 0], 1) for i in range(120)]
    refunds = [(f"r{i:03}", f"t{draw.randrange(130):03}", f"m{i % 9}", day(), amount(), ["fraud", "goodwill"][i % 2], "USD", 1) for i in range(90)]
    chargebacks = [(f"c{i:03}", f"t{draw.randrange(130):03}", f"m{i % 7}", day(), amount(), f"10.{i % 3}", 1) for i in range(40)]
    return {"transactions": transactions, "refunds": refunds, "chargebacks": chargebacks}


def later(loads):
    """New rows, corrections that move rows between months and transactions, a new merchant, and rows that are no news."""
    tx, rf, cb = (loads[entity] for entity in SCHEMAS)
    return {
        "transactions": [
            ("t500", "m8", dt.date(2024, 3, 5), 50.0, "USD", "settled", 2),  # m8 was only known from refunds
            ("t125", "m1", dt.date(2024, 2, 5), 10.0, "EUR", "voided", 2),  # refunds may have been there before it
            (*tx[3][:2], dt.date(2024, 2, 11), *tx[3][3:6], 2),
            (*tx[4][:3], 1.5, *tx[4][4:6], 2),
            (*tx[9][:6], 2),  # as it was
            (None, "m1", dt.date(2024, 2, 5), 10.0, "EUR", "failed", 2),
        ],
        "refunds": [
            ("r500", "t500", "m8", dt.date(2024, 3, 6), 5.0, "goodwill", "USD", 2),
            ("r501", None, "m1", dt.date(2024, 3, 6), 5.0, "lost__parcel", None, 2),
            (rf[5][0], "t077", *rf[5][2:7], 2),  # another transaction
            (*rf[6][:3], None, *rf[6][4:7], 2),  # no date any more
            (*rf[7][:7], 2),  # as it was
        ],
        "chargebacks": [("c500", "t125", "m1", dt.date(2024, 2, 7), 3.0, "10.1", 2), (*cb[0][:4], 0.25, cb[0][5], 2)],
    }


def source_of(spark, loads, *more):
    def source(entity):
        data = [row for load in (loads, *more) for row in load.get(entity, [])]
        return spark.createDataFrame(data, SCHEMAS[entity])

    return source


def readable(tables, name):
    """A fact without surrogate keys: codes in place of keys."""
    fact = tables(name)
    reason = {"fact_refund": "dim_refund_reason", "fact_chargeback": "dim_chargeback_reason"}.get(name, "dim_transaction_status")
    for dim, code in zip(("dim_merchant", "dim_currency", reason), NATURAL[name], strict=True):
        key = next(column for column in tables(dim).columns if column.endswith("_key"))
        pairs = tables(dim).select(key, F.col(code).alias(f"code_of_{dim}"))
        fact = fact.join(pairs, key, "left").drop(key)
    own = {"fact_transaction": "transaction_key", "fact_refund": "refund_key", "fact_chargeback": "chargeback_key"}[name]
    fact = fact.drop(own, "year_month")
    return rows(fact.select(*sorted(fact.columns)))


def assert_like_a_rebuild(spark, lake):
    loader = BronzeLoader(spark, f"{lake}/bronze", None, "CARDS", specs=SPECS)
    full = Warehouse(spark, {entity: loader.bronze(entity) for entity in SCHEMAS})
    stored = lambda name: spark.read.parquet(f"{lake}/gold/{name}")
    for name in FACTS:
        assert readable(stored, name) == readable(full.gold, name), name
        key = full.gold(name).columns[0]
        assert sorted(row[0] for row in stored(name).select(key).collect()) == list(range(1, stored(name).count() + 1))
    assert rows(stored("dim_date")) == rows(full.gold("dim_date"))
    for entity, table in tables_of(spark, lake).items():
        columns = full.silver[entity].columns
        assert rows(table.read().select(*columns)) == rows(full.silver[entity]), entity


def tables_of(spark, lake, buckets=8):
    keys = {"transactions": "transaction_id", "refunds": "refund_id", "chargebacks": "chargeback_id"}
    return {entity: BucketedTable(spark, f"{lake}/buckets", entity, key, buckets) for entity, key in keys.items()}


def files(folder):
    found = {}
    for path, _, names in os.walk(folder):
        for name in names:
            if name.endswith(".parquet"):
                with open(os.path.join(path, name), "rb") as file:
                    found[os.path.relpath(os.path.join(path, name), folder)] = file.read()
    return found


def bring(spark, lake, source, run_id, **more):
    return refresh(spark, source, lake, "CARDS", buckets=8, run_id=run_id, specs=SPECS, **more)


def test_a_second_load_touches_only_its_months_and_keeps_keys(spark, store):
    lake, loads = store.path("lake"), first_load()
    assert bring(spark, lake, source_of(spark, loads), "one").rebuilt
    assert_like_a_rebuild(spark, lake)
    before = {name: files(f"{lake}/gold/{name}") for name in FACTS}
    keys = {name: dict(rows(spark.read.parquet(f"{lake}/gold/{name}").select(id_, key))) for name, (id_, key) in plan_module.facts.FACT_KEYS.items()}
    dims = {name: set(rows(spark.read.parquet(f"{lake}/gold/{name}"))) for name in plan_module.CODED}

    result = bring(spark, lake, source_of(spark, loads, later(loads)), "two")
    assert not result.rebuilt and result.loaded == {"transactions": 6, "refunds": 5, "chargebacks": 2}
    assert_like_a_rebuild(spark, lake)
    for name in FACTS:
        after, touched = files(f"{lake}/gold/{name}"), {f"year_month={month}" for month in result.months[name]}
        untouched = {path for path in before[name] if path.split("/")[0] not in touched}
        assert untouched == {path for path in after if path.split("/")[0] not in touched | {"year_month=__HIVE_DEFAULT_PARTITION__"}}
        assert all(before[name][path] == after[path] for path in untouched)
        id_, key = plan_module.facts.FACT_KEYS[name]
        now = dict(rows(spark.read.parquet(f"{lake}/gold/{name}").select(id_, key)))
        assert all(now[natural] == number for natural, number in keys[name].items())
    assert len({path.split("/")[0] for path in before["fact_chargeback"]}) > len(result.months["fact_chargeback"])
    for name, known in dims.items():
        assert known <= set(rows(spark.read.parquet(f"{lake}/gold/{name}")))
    assert rows(spark.read.parquet(f"{lake}/silver/rejected_transactions").select("merchant_id")) == [("m1",)]

    unchanged = files(f"{lake}/gold")
    nothing = bring(spark, lake, source_of(spark, loads, later(loads)), "three")
    assert nothing.loaded == {"transactions": 0, "refunds": 0, "chargebacks": 0} and nothing.months == {}
    assert files(f"{lake}/gold") == unchanged


def test_rows_loaded_again_change_nothing(spark, store):
    lake, loads = store.path("lake"), first_load()
    bring(spark, lake, source_of(spark, loads), "one")
    before = files(f"{lake}/gold")
    again = bring(spark, lake, source_of(spark, loads), "two", incremental=False)
    assert again.loaded["transactions"] == 120 and again.months == {}
    assert files(f"{lake}/gold") == before
    assert_like_a_rebuild(spark, lake)


@pytest.mark.parametrize("step", ["_merge", "_write_fact"])
def test_a_refresh_that_failed_is_made_up_for_by_the_next(spark, store, monkeypatch, step):
    lake, loads = store.path("lake"), first_load()
    bring(spark, lake, source_of(spark, loads), "one")
    calls = []
    whole = getattr(plan_module.Refresh, step)

    def fails_later(self, *rest):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("lost")
        return whole(self, *rest)

    monkeypatch.setattr(plan_module.Refresh, step, fails_later)
    with pytest.raises(RuntimeError, match="lost"):
        bring(spark, lake, source_of(spark, loads, later(loads)), "two")
    monkeypatch.setattr(plan_module.Refresh, step, whole)
    bring(spark, lake, source_of(spark, loads, later(loads)), "three")
    loader = BronzeLoader(spark, f"{lake}/bronze", None, "CARDS", specs=SPECS)
    full = Warehouse(spark, {entity: loader.bronze(entity) for entity in SCHEMAS})
    stored = lambda name: spark.read.parquet(f"{lake}/gold/{name}")
    for name in FACTS:
        assert readable(stored, name) == readable(full.gold, name), name


def test_a_month_that_loses_its_last_row_goes(spark, store):
    lake = store.path("lake")
    day = lambda month: dt.date(2024, month, 1)
    tx = [("a", "m", day(1), 1.0, "USD", "settled", 1), ("b", "m", day(2), 1.0, "USD", "settled", 1)]
    bring(spark, lake, source_of(spark, {"transactions": tx}), "one")
    moved = {"transactions": [("a", "m", day(2), 1.0, "USD", "settled", 2)]}
    assert bring(spark, lake, source_of(spark, {"transactions": tx}, moved), "two").months["fact_transaction"] == [202401, 202402]
    assert {path.split("/")[0] for path in files(f"{lake}/gold/fact_transaction")} == {"year_month=202402"}
    found = spark.read.parquet(f"{lake}/gold/fact_transaction").select("transaction_id", "transaction_key")
    assert rows(found) == [("a", 1), ("b", 2)]


def test_untouched_buckets_are_not_read(spark, store):
    table = BucketedTable(spark, store.root, "t", "id", 8)
    table.replace(spark.range(100).selectExpr("id", "id * 2 AS twice"))
    keys = spark.createDataFrame([(3,)], "id long")
    bucket = table.touched(keys)
    read = table.read(bucket)
    seen = {row[0].split("/")[-2] for row in read.select(F.input_file_name()).distinct().collect()}
    assert len(bucket) == 1 and seen == {f"key_bucket={bucket[0]}"}
    assert "PartitionFilters: [key_bucket" in plan(read) or "PartitionFilters: [isnotnull(key_bucket" in plan(read)
    before = files(table.path)
    fresh = read.where("id <> 3").selectExpr("id", "twice", "'x' AS note").union(spark.sql("SELECT 3L, 7L, 'y'"))
    table.replace(store.save(fresh, "staged").df, bucket)
    same = {path: data for path, data in before.items() if f"key_bucket={bucket[0]}/" not in path}
    assert same.items() <= files(table.path).items()
    assert rows(table.read().where("id in (3, 4)")) == sorted([(3, 7, "y"), (4, 8, None if table.touched(spark.createDataFrame([(4,)], "id long")) != bucket else "x")])
    # A column keeps its first type.
    table.replace(spark.sql("SELECT 3L AS id, 'many' AS twice"), bucket)
    assert rows(table.read(bucket)) == [(3, None, None)]


def test_a_refresh_compares_an_entity_with_its_buckets_in_one_pass(spark, store, monkeypatch):
    lake, loads = store.path("lake"), first_load()
    bring(spark, lake, source_of(spark, loads), "one")
    reads, saved = [], []
    read, save = BucketedTable.read, plan_module.TableStore.save
    monkeypatch.setattr(BucketedTable, "read", lambda self, *some: reads.extend([self.path.split("/")[-1]] * len(some)) or read(self, *some))
    monkeypatch.setattr(plan_module.TableStore, "save", lambda self, df, name, *rest: saved.append(name) or save(self, df, name, *rest))
    more = {"refunds": [(*row[:4], row[4] + 1, *row[5:7], 2) for row in loads["refunds"][:20]]}
    bring(spark, lake, source_of(spark, loads, more), "two")
    assert reads.count("refunds") == 1  # not once more to merge
    assert [name for name in saved if name.endswith("/refunds")] == ["rejected/refunds", "change/refunds", "merged_lines/refunds"]
    monkeypatch.undo()
    assert_like_a_rebuild(spark, lake)
