"""Dense keys, key lookups and joins with hot keys."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyhouse.operators.dense_key import with_dense_key
from tallyhouse.operators.lookup import lookup_key
from tallyhouse.operators.skew import heavy_keys, join_unique
from tallyhouse.sources.storage import Stored, TableStore
from tests.conftest import plan, rows


@pytest.mark.parametrize("size", [0, 1, 2, 5_000])
def test_dense_keys_equal_a_global_row_number(spark, store, size):
    df = spark.range(size).select(F.xxhash64("id").cast("string").alias("id"), F.col("id").alias("payload"))
    keyed = with_dense_key(df, "id", "key", store, "keyed")
    expected = df.withColumn("key", F.row_number().over(Window.orderBy("id")).cast("long")).select("key", "id", "payload")
    assert keyed.rows == size
    assert rows(keyed.df) == rows(expected)


def test_dense_keys_over_several_tasks(spark, store):
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(coalesce, "false")
    try:
        df = spark.range(0, 3_000, 1, 6).select(F.xxhash64("id").cast("string").alias("id"))
        keyed = with_dense_key(df, "id", "key", store, "keyed")
        stored = spark.read.parquet(keyed.path)
        assert stored.select(F.shiftright("__place", 33)).distinct().count() > 4
        assert rows(keyed.df) == rows(df.withColumn("key", F.row_number().over(Window.orderBy("id"))).select("key", "id"))
    finally:
        spark.conf.set(coalesce, "true")


def test_dense_key_plan_has_no_single_task_step(spark, store):
    df = spark.range(100).select(F.col("id").cast("string").alias("id"))
    text = plan(with_dense_key(df, "id", "key", store, "keyed").df)
    assert "SinglePartition" not in text and "Window" not in text


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.sets(st.text(alphabet="aZ09é-_ ", min_size=1, max_size=6), max_size=25))
def test_dense_keys_follow_binary_string_order(spark, ids):
    df = spark.createDataFrame([(value,) for value in ids], "id string")
    keyed = with_dense_key(df, "id", "key", TableStore(spark), "keyed").df
    expected = sorted(ids, key=lambda value: value.encode())
    assert [row["id"] for row in keyed.orderBy("key").collect()] == expected


@pytest.fixture
def skewed(spark):
    """A third of the rows on one key, a fifth without key, the rest spread out."""
    n = F.col("id")
    key = F.when(n % 3 == 0, F.lit("hot")).when(n % 5 == 1, F.lit(None)).otherwise(F.concat(F.lit("k"), n % 500))
    return spark.range(0, 30_000, 1, 6).select(n.alias("row_id"), key.alias("code"))


@pytest.fixture
def partners(spark):
    some = spark.range(450).select(F.concat(F.lit("k"), F.col("id")).alias("code"), F.col("id").cast("int").alias("code_key"))
    return some.union(spark.sql("SELECT 'hot', 9999"))


def test_heavy_keys_finds_the_hot_key_only(skewed):
    found = heavy_keys(skewed, "code", 64).collect()
    assert [row["code"] for row in found] == ["hot"]
    assert found[0]["__copies"] == pytest.approx(64 * 10_000 / 26_000, abs=2)


def test_heavy_keys_of_nothing(skewed):
    assert heavy_keys(skewed.where("1 = 0"), "code", 64).collect() == []
    assert heavy_keys(skewed.where("code IS NULL"), "code", 64).collect() == []


@pytest.mark.parametrize("how", ["left", "inner", "left_anti"])
def test_splitting_hot_keys_changes_nothing(skewed, partners, how):
    split = join_unique(skewed, partners, "code", ["row_id"], how)
    plain = skewed.join(partners, "code", how)
    assert sorted(split.columns) == sorted(plain.columns)
    assert rows(split.select(*plain.columns)) == rows(plain)


def test_hot_rows_end_up_in_many_tasks(spark, skewed, partners):
    settings_ = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "32",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {key: spark.conf.get(key) for key in settings_}
    try:
        for key, value in settings_.items():
            spark.conf.set(key, value)
        for joined, fewest in (
            (join_unique(skewed, partners, "code", ["row_id"], "left"), 8),
            (skewed.join(partners, "code", "left"), 1),
        ):
            tasks = joined.where("code = 'hot'").select(F.spark_partition_id().alias("task")).distinct().count()
            assert tasks == 1 if fewest == 1 else tasks >= fewest
            nulls = joined.where("code IS NULL").select(F.spark_partition_id().alias("task")).distinct().count()
            assert nulls == 1 if fewest == 1 else nulls >= fewest
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_lookup_broadcasts_only_below_the_limit(skewed, partners):
    dimension = Stored(partners.withColumnRenamed("code", "natural"), 451, "")
    small = lookup_key(skewed, dimension, "code", "natural", "code_key", ["row_id"])
    large = lookup_key(skewed, dimension, "code", "natural", "code_key", ["row_id"], broadcast_rows=450)
    assert "__salt" not in plan(small) and "BroadcastHashJoin" in plan(small)
    assert "__salt" in plan(large)
    assert rows(small.select("row_id", "code", "code_key")) == rows(large.select("row_id", "code", "code_key"))
