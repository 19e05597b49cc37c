"""Incremental loading, the raw layer, a full run, and streaming ingestion."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators.dedup import deduplicate
from tallyhouse.operators.incremental import Checkpoint, EntitySpec, checkpoint_of, entity_specs, newer_rows
from tallyhouse.operators.standardize import standardize
from tallyhouse.plans.bronze_load import BronzeLoader
from tallyhouse.plans.daily_run import gold_from_silver, publish_stored, run
from tallyhouse.sources.audit import audit_frame, audit_row, loaded_records
from tallyhouse.sources.bronze import add_audit_columns, append_bronze, read_bronze, read_loads, read_parts, schema_name, union_by_name
from tallyhouse.sources.jdbc import bounds_query, jdbc_options
from tallyhouse.sources.sample_tables import ENTITIES
from tallyhouse.sources.state import LoadState
from tallyhouse.sources.storage import TableStore, if_present, observed_write, shared_folder
from tallyhouse.streaming.file_ingest import append_available, drop_repeats, file_stream, late_rows
from tests.conftest import plan, rows
from verification.queries import QUERIES, warehouse

SMALL = "/root/testdata/sf0.001"
SPEC = EntitySpec("items", "date", "id")
D = [dt.date(2024, 1, day) for day in range(1, 10)]


def items(spark, *data):
    return spark.createDataFrame(list(data), "id int, date date")


def ids(df):
    return sorted(row["id"] for row in df.collect())


def test_slice_takes_later_rows_and_larger_keys_at_the_watermark(spark):
    df = items(spark, (8, D[1]), (9, D[1]), (10, D[1]), (1, D[2]), (99, D[0]), (5, None))
    assert ids(newer_rows(df, SPEC, None)) == [1, 5, 8, 9, 10, 99]
    # The row without a watermark comes every time.
    assert ids(newer_rows(df, SPEC, Checkpoint(D[1], 9))) == [1, 5, 10]
    assert ids(newer_rows(df, SPEC, Checkpoint(D[1]))) == [1, 5]
    assert ids(newer_rows(df, SPEC, Checkpoint(D[1], 9), dt.timedelta(days=1))) == [1, 5, 8, 9, 10, 99]


def test_lookback_fits_the_kind_of_watermark(spark):
    numbers = spark.createDataFrame([(1, 5), (2, 8), (3, 9), (4, None)], "id int, n int")
    spec = EntitySpec("numbers", "n", "id")
    assert ids(newer_rows(numbers, spec, Checkpoint(9, 3), 1)) == [2, 3, 4]
    with pytest.raises(ValueError, match="does not fit"):
        newer_rows(numbers, spec, Checkpoint(9, 3), dt.timedelta(days=1))
    with pytest.raises(ValueError, match="text has no distance"):
        newer_rows(numbers.withColumn("n", F.col("n").cast("string")), spec, Checkpoint("9", 3), 1)


def test_a_correction_loaded_later_wins(spark, store):
    """Through the real loader: the same transaction comes again by lookback, settled and with a lower amount."""
    for status, amount, day in (("pending", 100.0, 2), ("settled", 90.0, 3)):
        source = spark.createDataFrame([("t1", "m", D[2], amount, "USD", status)], "transaction_id string, merchant_id string, date date, amount double, currency string, status string")
        rest = source.select(F.concat(F.lit("x"), F.lit(day)).alias("transaction_id"), "merchant_id", F.lit(D[day]).alias("date"), "amount", "currency", "status")
        load = loader(spark, store, lambda entity, df=source.union(rest): df, lookback=dt.timedelta(days=2))
        load.load("transactions")
    cleaned = deduplicate(standardize(load.bronze("transactions"), "transactions"), "transactions")
    assert rows(cleaned.where("transaction_id = 't1'").select("status", "amount")) == [("settled", 90.0)]


def test_loads_of_unlike_columns_and_types_are_all_read(spark, store):
    """A column gone, a column new, text to double, and a time with and without zone, on one day of loading."""
    first = "SELECT 'a' refund_id, 't1' transaction_id, 'm' merchant_id, timestamp_ntz'2024-01-01 10:00:00' date, '7.5' refund_amount, 'r' reason, 'EUR' currency"
    second = "SELECT 'b' refund_id, 't2' transaction_id, 'm' merchant_id, timestamp'2024-01-02 10:00:00' date, 2.5D refund_amount, 'r' reason, 1 extra"
    for sql in (first, second, second.replace("'b'", "'c'").replace("01-02", "01-03")):
        load = loader(spark, store, lambda entity, sql=sql: spark.sql(sql))
        load.state = LoadState(spark, store.path(f"state_{len(sql)}"))
        load.load("refunds")
    everything = load.bronze("refunds")
    assert rows(everything.select("refund_id", "refund_amount", "currency", "extra")) == [
        ("a", "7.5", "EUR", None), ("b", "2.5", None, 1), ("c", "2.5", None, 1)
    ]
    assert plan(everything).count("FileScan") == 2
    assert "PartitionFilters" in plan(everything.where("load_date = '2024-01-02'"))
    typed = standardize(everything, "refunds")
    assert rows(typed.select("refund_id", "refund_amount", F.col("refund_date").cast("string"))) == [
        ("a", 7.5, "2024-01-01"), ("b", 2.5, "2024-01-02"), ("c", 2.5, "2024-01-03")
    ]


def test_bounds_are_asked_of_the_source():
    assert bounds_query("refunds", "id") == "SELECT MIN(id) AS low, MAX(id) AS high FROM refunds"


def test_slice_is_pushed_into_the_scan(spark):
    df = spark.read.parquet(f"{SMALL}/orders.parquet")
    spec = EntitySpec("orders", "o_orderdate", "o_orderkey")
    text = plan(newer_rows(df, spec, Checkpoint(dt.datetime(1998, 6, 15), 700)))
    assert "GreaterThanOrEqual(o_orderdate,1998-06-15" in text
    audited = newer_rows(add_audit_columns(df, "run", "S"), spec, Checkpoint(dt.datetime(1998, 6, 15), 700))
    assert "GreaterThanOrEqual(o_orderdate,1998-06-15" in plan(audited)


def test_keys_are_compared_in_their_own_type(spark):
    df = items(spark, (9, D[1]), (10, D[1]), (50, D[0]), (7, None))
    assert rows(checkpoint_of(df, SPEC)) == [("items", "date", "id", D[1], 10)]
    assert rows(checkpoint_of(df.where("date IS NULL"), SPEC)) == []


def test_specs_can_be_overridden():
    specs = entity_specs({"refunds": {"watermark_column": "updated"}})
    assert specs["refunds"] == EntitySpec("refunds", "updated", "refund_id")
    assert specs["transactions"] == EntitySpec("transactions", "date", "transaction_id")


@pytest.mark.parametrize("kind", ["date", "timestamp", "timestamp_ntz", "bigint", "string"])
def test_state_keeps_types(spark, store, kind):
    state = LoadState(spark, store.path("state"))
    value = "2024" if kind == "bigint" else "2024-03-31 01:30:00.123456"
    types = spark.createDataFrame([], f"date {kind}, id bigint").schema
    assert state.latest(SPEC) is None
    state.save(SPEC, value, "9", types, "run", 5)
    state.save(SPEC, value, "10", types, "run", 5)
    latest = state.latest(SPEC)
    assert latest.key == 10
    expected = {
        "date": dt.date(2024, 3, 31),
        "bigint": 2024,
        "string": value,
        "timestamp": dt.datetime(2024, 3, 31, 1, 30, 0, 123456),
        "timestamp_ntz": dt.datetime(2024, 3, 31, 1, 30, 0, 123456),
    }[kind]
    assert latest.watermark == expected
    assert state.history(SPEC).count() == 2


def payments(spark, upto: dt.date):
    """A source whose rows appear day by day."""

    def source(entity):
        key = {"transactions": "transaction_id", "refunds": "refund_id", "chargebacks": "chargeback_id"}[entity]
        days = (upto - D[0]).days + 1
        return spark.range(days * 3).select(
            F.format_string("%05d", "id").alias(key), F.date_add(F.lit(D[0]), (F.col("id") / 3).cast("int")).alias("date")
        )

    return source


def loader(spark, store, source, **options):
    return BronzeLoader(spark, store.path("bronze"), source, "CARDS", **options)


def test_loading_in_steps_equals_loading_at_once(spark, store, tmp_path):
    for day, expected in ((2, 9), (2, 0), (5, 9)):
        assert loader(spark, store, payments(spark, D[day])).load_all() == dict.fromkeys(ENTITIES, expected)
    stepwise = loader(spark, store, payments(spark, D[5])).bronze("refunds")
    other = TableStore(spark, str(tmp_path / "other"))
    at_once = loader(spark, other, payments(spark, D[5]))
    at_once.load_all()
    assert rows(stepwise.select("refund_id", "date")) == rows(at_once.bronze("refunds").select("refund_id", "date"))
    assert {"load_timestamp", "pipeline_run_id", "source_system", "load_date"} <= set(stepwise.columns)


def test_checkpoint_is_rebuilt_from_loaded_data_when_state_is_lost(spark, store):
    first = loader(spark, store, payments(spark, D[2]))
    first.load("refunds")
    second = loader(spark, store, payments(spark, D[3]))
    second.state = LoadState(spark, store.path("lost_state"))
    assert second.load("refunds") == 3
    history = second.state.history(second.specs["refunds"])
    assert rows(history.select("records_loaded", "bootstrapped_from_bronze")) == [(0, True), (3, False)]


def test_full_load_ignores_the_checkpoint(spark, store):
    loader(spark, store, payments(spark, D[1])).load("refunds")
    assert loader(spark, store, payments(spark, D[1]), incremental=False).load("refunds") == 6


def test_lookback_reloads_late_rows(spark, store):
    loader(spark, store, payments(spark, D[2])).load("refunds")
    assert loader(spark, store, payments(spark, D[3]), lookback=dt.timedelta(days=1)).load("refunds") == 9


def test_failure_keeps_earlier_progress_and_is_audited(spark, store):
    def broken(entity):
        if entity == "refunds":
            raise RuntimeError("source is down")
        return payments(spark, D[0])(entity)

    failing = loader(spark, store, broken)
    with pytest.raises(RuntimeError, match="source is down"):
        failing.load_all(store.path("audit"))
    assert failing.state.latest(failing.specs["transactions"]) is not None
    audit = spark.read.option("header", True).csv(store.path("audit/bronze_load_audit"))
    assert rows(audit.select("source_table", "status", "records_inserted", "message")) == [
        ("refunds", "FAILED", "0", "source is down"),
        ("transactions", "SUCCESS", "3", None),
    ]
    assert rows(loaded_records(failing.audit())) == [(3,)]
    after = loader(spark, store, payments(spark, D[0]))
    assert after.load_all(store.path("audit")) == {"transactions": 0, "refunds": 3, "chargebacks": 3}
    assert spark.read.option("header", True).csv(store.path("audit/bronze_load_audit")).count() == 5
    assert spark.read.option("header", True).csv(store.path("audit/bronze_load_last_run")).count() == 3


def test_only_successful_loads_are_summed(spark):
    audit = audit_frame(spark, [audit_row("r", "S", "refunds", "p", n, s) for n, s in ((5, "SUCCESS"), (7, "FAILED"), (1, "SUCCESS"))])
    assert rows(loaded_records(audit)) == [(6,)]
    assert rows(loaded_records(audit.where("1 = 0"))) == [(0,)]


def test_parts_with_other_columns_and_zoneless_times(spark, store):
    a = store.save(spark.sql("SELECT 1 id, timestamp'2024-01-01 10:00:00' load_timestamp"), "a").path
    b = store.save(spark.sql("SELECT 2 id, timestamp_ntz'2024-01-02 10:00:00' load_timestamp, 'x' extra"), "b").path
    c = store.save(spark.sql("SELECT 3 id, timestamp'2024-01-03 10:00:00' load_timestamp"), "c").path
    both = read_parts(spark, [a, b, c])
    assert dict(both.dtypes) == {"id": "int", "load_timestamp": "timestamp", "extra": "string"}
    assert rows(both.select("id", "extra")) == [(1, None), (2, "x"), (3, None)]
    assert plan(both).count("FileScan") == 2


def test_bronze_scan_with_a_schema_fills_missing_columns_and_prunes_loads(spark, store):
    path = store.path("bronze")
    spark.sql("SELECT 1 id, timestamp'2024-01-01 10:00:00' load_timestamp, '2024-01-01' load_date").write.partitionBy("load_date").parquet(path)
    spark.sql("SELECT 2 id, timestamp_ntz'2024-01-02 10:00:00' load_timestamp, 'x' extra, '2024-01-02' load_date").write.mode("append").partitionBy("load_date").parquet(path)
    schema = spark.createDataFrame([], "id int, load_timestamp timestamp, extra string").schema
    df = read_bronze(spark, path, schema)
    assert rows(df.select("id", "extra", F.date_format("load_timestamp", "dd HH"))) == [(1, None, "01 10"), (2, "x", "02 10")]
    assert "PartitionFilters: [isnotnull(load_date" in plan(df.where("load_date = '2024-01-02'"))


def test_union_by_name_fills_missing_columns(spark):
    left, right = spark.sql("SELECT 1 a, 2 b"), spark.sql("SELECT 3 b")
    assert rows(union_by_name([left, right])) == [(1, 2), (None, 3)]


def test_jdbc_options():
    plain = jdbc_options("jdbc:x", "refunds", {"user": "u"})
    assert plain == {"url": "jdbc:x", "dbtable": "refunds", "fetchsize": "10000", "user": "u"}
    split = jdbc_options("jdbc:x", "refunds", {}, "date", ("2024-01-01", "2024-02-01"), 16)
    assert (split["partitionColumn"], split["numPartitions"]) == ("date", "16")
    with pytest.raises(ValueError, match="bound"):
        jdbc_options("jdbc:x", "refunds", {}, "date")


def test_observed_write_measures_in_the_same_pass(spark, store):
    df = spark.range(10)
    seen = observed_write(df, lambda rows_: rows_.write.parquet(store.path("x")), top=F.max("id"))
    assert seen == {"rows": 10, "top": 9}
    assert observed_write(df.where("id > 99"), lambda rows_: rows_.write.parquet(store.path("y")), top=F.max("id"))["rows"] == 0


def test_storage_helpers(spark, store):
    assert if_present(lambda: spark.read.parquet(store.path("nowhere"))) is None
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    assert named is None or shared_folder(spark) == named.rstrip("/")


def test_only_temporary_stores_can_be_dropped(spark, store):
    scratch = TableStore(spark)
    path = scratch.save(spark.range(3), "x").path
    scratch.drop()
    assert if_present(lambda: spark.read.parquet(path)) is None
    with pytest.raises(ValueError, match="not dropped"):
        store.drop()


def test_loads_of_the_old_layout_are_read_beside_new_ones(spark, store):
    """Loads once lay straight under their date, without a folder for their schema."""
    path, old = store.path("mixed"), items(spark, (1, D[0]), (2, D[1])).selectExpr("string(id) AS id", "date")
    old.withColumn("load_date", F.lit("2024-01-01")).write.partitionBy("load_date").parquet(path)
    new = items(spark, (3, D[1]), (4, D[2]), (5, None)).withColumn("extra", F.lit("x"))
    append_bronze(new, path, dt.date(2024, 1, 2))
    found = read_loads(spark, path, {schema_name(new.schema): new.schema})
    assert rows(found.select("id", "extra")) == [("1", None), ("2", None), ("3", "x"), ("4", "x"), ("5", "x")]
    assert found.where("load_date = '2024-01-02'").count() == 3
    nothing = read_loads(spark, store.path("none"), {schema_name(new.schema): new.schema})
    assert nothing.count() == 0 and nothing.columns == ["id", "date", "extra", "load_date"]


def test_full_run(spark, store):
    lake = store.path("lake")

    def source(entity):
        return ENTITIES[entity](spark, SMALL)

    result = run(spark, source, lake, "CARDS", run_id="one")
    assert result.loaded == {"transactions": 1500, "refunds": 1968, "chargebacks": 977}
    assert result.rejected == {"transactions": 0, "refunds": 0, "chargebacks": 0}
    assert result.gold_rows == warehouse(spark, SMALL).gold_rows()
    facts = spark.read.parquet(f"{lake}/gold/fact_transaction")
    expected = warehouse(spark, SMALL).gold("fact_transaction")
    assert rows(facts.select(*expected.columns)) == rows(expected)
    report = spark.read.json(f"{lake}/reports/dq_report")
    assert report.count() == 13

    again = run(spark, source, lake, "CARDS", run_id="two")
    assert again.loaded == {"transactions": 0, "refunds": 0, "chargebacks": 0}
    assert again.gold_rows == result.gold_rows
    metrics = spark.read.option("header", True).csv(f"{lake}/reports/pipeline_metrics")
    assert rows(metrics.select("records_processed", "status")) == [("0", "SUCCESS"), ("4445", "SUCCESS")]

    # Single layers from what is stored: the raw layer is not needed for either.
    before = rows(spark.read.parquet(f"{lake}/gold/fact_refund").drop("refund_key"))
    assert gold_from_silver(spark, lake) == result.gold_rows
    assert rows(spark.read.parquet(f"{lake}/gold/fact_refund").drop("refund_key")) == before
    spark.sql("CREATE DATABASE IF NOT EXISTS stored_gold_test")
    try:
        assert publish_stored(spark, lake, "stored_gold_test") == result.gold_rows
    finally:
        spark.sql("DROP DATABASE stored_gold_test CASCADE")


def test_failed_run_leaves_metrics(spark, store):
    lake = store.path("lake")
    with pytest.raises(RuntimeError, match="refund_amount_rule"):
        run(spark, lambda entity: ENTITIES[entity](spark, SMALL), lake, "CARDS", fail_on=("refund_amount_rule",))
    metrics = spark.read.option("header", True).csv(f"{lake}/reports/pipeline_metrics")
    assert rows(metrics.select("records_processed", "status")) == [("4445", "FAILED")]


def test_stream_loads_each_file_once(spark, store):
    landing, target, progress = store.path("landing"), store.path("out"), store.path("progress")
    events = spark.read.parquet(f"{SMALL}/events.parquet")
    schema = events.schema

    def ingest():
        append_available(file_stream(spark, landing, schema, files_per_batch=1), target, progress)
        return spark.read.parquet(target).count()

    events.where("event_id % 2 = 0").write.mode("append").parquet(landing)
    assert ingest() == events.where("event_id % 2 = 0").count()
    assert ingest() == events.where("event_id % 2 = 0").count()
    events.where("event_id % 2 = 1").write.mode("append").parquet(landing)
    assert ingest() == events.count()
    assert rows(spark.read.parquet(target)) == rows(events)


def test_stream_drops_repeats_within_the_bound(spark, store):
    landing = store.path("landing")
    events = spark.read.parquet(f"{SMALL}/events.parquet")
    events.union(events).coalesce(1).write.parquet(landing)
    stream = drop_repeats(file_stream(spark, landing, events.schema), "event_id", "ts", "2 days")
    append_available(stream, store.path("out"), store.path("progress"))
    result = spark.read.parquet(store.path("out"))
    assert result.count() == events.count()
    assert dict(result.dtypes)["ts"] == "timestamp"


def test_rows_later_than_the_bound_are_counted(spark, store):
    landing = store.path("landing")
    schema = "event_id long, ts timestamp"

    def arrive(*events):
        spark.createDataFrame([(i, dt.datetime(2024, 1, day)) for i, day in events], schema).coalesce(1).write.mode("append").parquet(landing)
        stream = drop_repeats(file_stream(spark, landing, spark.createDataFrame([], schema).schema), "event_id", "ts", "1 day")
        return late_rows(append_available(stream, store.path("out"), store.path("progress")))

    assert arrive((1, 1), (2, 10)) == 0
    assert arrive((3, 2), (4, 11)) == 1
    assert ids(spark.read.parquet(store.path("out")).withColumnRenamed("event_id", "id")) == [1, 2, 4]


def test_registered_streams_take_a_folder_of_part_files(spark, store):
    events = spark.read.parquet(f"{SMALL}/events.parquet")
    events.repartition(3).write.parquet(store.path("events.parquet"))
    for name in ("stream_events_ingest", "stream_events_dedup"):
        assert rows(QUERIES[name](spark, store.root)) == rows(events)
