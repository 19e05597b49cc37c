"""Every registered query: a callable from (session, table folder) to a DataFrame.

Queries over cleaned or star-schema tables share one warehouse per session and
folder: its layers are built from the given tables on first use and read back
afterwards, the way a scheduled run builds them once for all reports.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.fixed_values import ENTITY_KEYS, ENTITY_MEASURES, GOLD_TABLES
from tallyhouse.operators.contract import contract_violations, prepare
from tallyhouse.operators.dedup import deduplicate
from tallyhouse.operators.dense_key import with_dense_key
from tallyhouse.operators.incremental import Checkpoint, EntitySpec, checkpoint_of, newer_rows
from tallyhouse.operators.inspect import profile
from tallyhouse.operators.lookup import lookup_key
from tallyhouse.operators.quality import over_refunded, raw_uniqueness, summarize, violations
from tallyhouse.operators.reconcile import rollup
from tallyhouse.operators.standardize import standardize
from tallyhouse.plans.bronze_load import BronzeLoader
from tallyhouse.plans import reports
from tallyhouse.plans.dimensions import date_bounds, implausible_dates
from tallyhouse.plans.refresh import refresh
from tallyhouse.plans.warehouse import Warehouse
from tallyhouse.sources import sample_tables
from tallyhouse.sources.audit import audit_frame, audit_row, loaded_records
from tallyhouse.sources.bronze import PARTITION, add_audit_columns, append_bronze, read_loads, schema_name, union_by_name
from tallyhouse.sources.storage import TableStore, observed_write
from tallyhouse.streaming.file_ingest import append_available, drop_repeats, file_stream
from tallyhouse.streaming.raw_stream import RawStream

Query = Callable[[SparkSession, str], DataFrame]

SOURCE_SYSTEM = "CARDS"
RUN_ID = "run-0001"
LOADED_AT = "2024-02-01 06:30:00"

ORDERS = EntitySpec("orders", "o_orderdate", "o_orderkey")
EVENTS = EntitySpec("events", "ts", "event_id")
ORDERS_AT = Checkpoint(datetime(1998, 6, 15), 7_000)
EVENTS_AT = Checkpoint(datetime(2024, 1, 16, 12), 5_000)

SLICERS = {
    "start": date(1996, 1, 1),
    "end": date(1999, 12, 31),
    "merchants": ["M003", "M007", "M011", "M019", "M023", "M031", "M042"],
    "statuses": ["settled", "completed"],
    "risks": ["NORMAL", "HIGH_REFUND", "CHARGEBACK"],
}

#: Rows dated earlier come with the first load, all others with the second.
SECOND_LOAD = date(1997, 7, 1)

_LAKES: dict[tuple[str, str], str] = {}
_WAREHOUSES: dict[tuple[str, str], Warehouse] = {}


def _raw(spark: SparkSession, folder: str, entity: str) -> DataFrame:
    return sample_tables.ENTITIES[entity](spark, folder)


def _bronze(spark: SparkSession, folder: str, entity: str) -> DataFrame:
    loaded_at = F.lit(LOADED_AT).cast("timestamp")
    return add_audit_columns(_raw(spark, folder, entity), RUN_ID, SOURCE_SYSTEM, loaded_at)


def new_warehouse(spark: SparkSession, folder: str) -> Warehouse:
    return Warehouse(spark, {entity: _bronze(spark, folder, entity) for entity in ENTITY_KEYS})


def warehouse(spark: SparkSession, folder: str) -> Warehouse:
    place = (spark.sparkContext.applicationId, folder)
    if place not in _WAREHOUSES:
        _WAREHOUSES[place] = new_warehouse(spark, folder)
    return _WAREHOUSES[place]


def forget_warehouses() -> None:
    """Make the next query build its layers anew."""
    _WAREHOUSES.clear()
    _LAKES.clear()


def refreshed_lake(spark: SparkSession, folder: str) -> str:
    """A lake built from a first load and refreshed from a second one."""
    place = (spark.sparkContext.applicationId, folder)
    if place not in _LAKES:
        lake = TableStore(spark).path("lake")
        for early in (True, False):

            def source(entity: str, early: bool = early) -> DataFrame:
                rows = _raw(spark, folder, entity)
                return rows.where(F.col("date") < F.lit(SECOND_LOAD)) if early else rows

            refresh(spark, source, lake, SOURCE_SYSTEM, buckets=8)
        _LAKES[place] = lake
    return _LAKES[place]


def _report(build: Callable[..., DataFrame], **options) -> Query:
    return lambda spark, folder: build(warehouse(spark, folder).gold, **options)


def _gold(name: str) -> Query:
    return lambda spark, folder: warehouse(spark, folder).gold(name)


def _standardized(entity: str) -> Query:
    return lambda spark, folder: standardize(_raw(spark, folder, entity), entity)


def _survivors(entity: str) -> Query:
    """Cleaned rows without the columns that only say when they were loaded."""
    return lambda spark, folder: warehouse(spark, folder).silver[entity].drop(
        "load_timestamp", "pipeline_run_id", "source_system"
    )


def _rollup(entity: str, *columns: str) -> Query:
    return lambda spark, folder: rollup(warehouse(spark, folder).silver[entity], entity).select(*columns)


def _broken(entity: str, rule: str) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        silver = warehouse(spark, folder).silver
        return violations(silver[entity], entity, silver["transactions"], rule)

    return query


def _orphans(entity: str) -> Query:
    key, amount = ENTITY_KEYS[entity][1], ENTITY_MEASURES[entity][1]
    rows = _broken(entity, f"{entity}_referential_integrity")
    return lambda spark, folder: rows(spark, folder).select(key, "transaction_id", amount)


def _scan_bronze_union(spark: SparkSession, folder: str) -> DataFrame:
    """Two loads with different columns and layouts: filled orders came without a priority, before folders named a schema."""
    orders = sample_tables.table(spark, folder, "orders").select(
        "o_orderkey", "o_orderstatus", F.col("o_orderdate").cast("date").alias("o_orderdate"), "o_totalprice", "o_orderpriority"
    )
    filled, path = F.col("o_orderstatus").eqNullSafe("F"), TableStore(spark).path("bronze/orders")
    old = orders.where(filled).drop("o_orderpriority").withColumn(PARTITION, F.lit("2024-02-01"))
    old.write.mode("append").partitionBy(PARTITION).parquet(path)
    new = orders.where(~filled)
    append_bronze(new, path, date(2024, 2, 2))
    return read_loads(spark, path, {schema_name(new.schema): new.schema}).drop(PARTITION)


def _audit_columns(spark: SparkSession, folder: str) -> DataFrame:
    return _bronze(spark, folder, "transactions").withColumn("load_timestamp", F.col("load_timestamp").cast("timestamp_ntz"))


def _contract(table: str, **options) -> Query:
    return lambda spark, folder: prepare(warehouse(spark, folder).gold(table), table, **options)


def _slice(spec: EntitySpec, at: Checkpoint) -> Query:
    return lambda spark, folder: newer_rows(sample_tables.table(spark, folder, spec.name), spec, at)


def _checkpoint(spec: EntitySpec) -> Query:
    return lambda spark, folder: checkpoint_of(sample_tables.table(spark, folder, spec.name), spec)


def _lookup_merchant_key(spark: SparkSession, folder: str) -> DataFrame:
    wh = warehouse(spark, folder)
    rows = wh.silver["refunds"].select("refund_id", "merchant_id")
    return lookup_key(rows, wh.dims["dim_merchant"], "merchant_id", "merchant_id", "merchant_key", ["refund_id"])


def _lookup_date_key(spark: SparkSession, folder: str) -> DataFrame:
    wh = warehouse(spark, folder)
    rows = wh.silver["refunds"].select("refund_id", "refund_date")
    return lookup_key(rows, wh.dims["dim_date"], "refund_date", "full_date", "date_key", ["refund_id"])


def _surrogate_key_orders(spark: SparkSession, folder: str) -> DataFrame:
    ids = sample_tables.table(spark, folder, "orders").select(F.col("o_orderkey").cast("string").alias("order_id"))
    store = warehouse(spark, folder).scratch
    return with_dense_key(ids, "order_id", "order_key", store, "keys/orders").df


def _reconciled_total(spark: SparkSession, folder: str) -> DataFrame:
    return warehouse(spark, folder).reconciliation_base.where(over_refunded())


def _audit_total_records(spark: SparkSession, folder: str) -> DataFrame:
    """Audit rows of three loads of the raw entities; the last one is marked as failed."""
    store = TableStore(spark)
    rows = []
    for entity, status in zip(ENTITY_KEYS, ("SUCCESS", "SUCCESS", "FAILED"), strict=True):
        path = store.path(f"bronze/{entity}")
        loaded = observed_write(_raw(spark, folder, entity), lambda df, path=path: df.write.parquet(path))["rows"]
        rows.append(audit_row(RUN_ID, SOURCE_SYSTEM, entity, path, loaded, status))
    return loaded_records(audit_frame(spark, rows))


def _events_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The events table as a stream, whether it is one file or a folder of part files."""
    events = sample_tables.table(spark, folder, "events")
    if events.inputFiles()[0].endswith("/events.parquet"):
        return file_stream(spark, folder, events.schema, only="events.parquet")
    return file_stream(spark, f"{folder}/events.parquet", events.schema)


def _stream_events_ingest(spark: SparkSession, folder: str) -> DataFrame:
    store = TableStore(spark)
    append_available(_events_stream(spark, folder), store.path("events"), store.path("events_checkpoint"))
    return store.read("events")


def _stream_events_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every event arrives twice and is let through once; the bound is wider than the data, so nothing is late."""
    store = TableStore(spark)
    twice = _events_stream(spark, folder).unionByName(_events_stream(spark, folder))
    once = drop_repeats(twice, "event_id", "ts", "60 days")
    append_available(once, store.path("events"), store.path("events_checkpoint"))
    return store.read("events").withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def _stream_events_raw(spark: SparkSession, folder: str) -> DataFrame:
    """Events landed in the raw layer; the stream then starts anew, and batches that were finished add nothing."""
    store = TableStore(spark)
    loader = BronzeLoader(spark, store.path("raw"), lambda entity: sample_tables.table(spark, folder, entity), SOURCE_SYSTEM, specs={"events": EVENTS})
    landing = RawStream(loader, "events", "landing")
    for attempt in (1, 2):
        landing.land_available(_events_stream(spark, folder), store.path(f"progress{attempt}"))
    return loader.bronze("events").drop(PARTITION, "load_timestamp", "pipeline_run_id", "source_system")


def _dedup_updated_transactions(spark: SparkSession, folder: str) -> DataFrame:
    """Two loads of all transactions; the second, later one corrects every seventh: settled, and a lower amount."""
    rows = _raw(spark, folder, "transactions")
    corrected = rows.where(F.col("transaction_id").cast("long") % 7 == 0).withColumns(
        {"status": F.lit("settled"), "amount": F.floor(F.col("amount") / 2)}
    )
    loads = [
        add_audit_columns(part, run, SOURCE_SYSTEM, F.lit(at).cast("timestamp"))
        for part, run, at in ((rows, RUN_ID, LOADED_AT), (corrected, "run-0002", "2024-02-02 06:30:00"))
    ]
    kept = deduplicate(standardize(union_by_name(loads), "transactions"), "transactions")
    return kept.drop("load_timestamp", "source_system")


def _slice_null_watermarks(spark: SparkSession, folder: str) -> DataFrame:
    """Orders of which every fiftieth has no date: those come with every load."""
    undated = F.when(F.col("o_orderkey") % 50 != 0, F.col("o_orderdate"))
    return newer_rows(sample_tables.table(spark, folder, "orders").withColumn("o_orderdate", undated), ORDERS, ORDERS_AT)


def _refreshed(fact: str, dims: dict[str, str], drop: str) -> Query:
    """A refreshed fact with codes in place of the keys that depend on the order of arrival."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        lake = refreshed_lake(spark, folder)
        rows = spark.read.parquet(f"{lake}/gold/{fact}").drop(drop, "year_month")
        for dim, code in dims.items():
            stored = spark.read.parquet(f"{lake}/gold/{dim}")
            key = next(name for name in stored.columns if name.endswith("_key"))
            rows = rows.join(stored.select(key, F.col(code).alias(f"{dim}_code")), key, "left").drop(key)
        return rows

    return query


def _refreshed_keys(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{refreshed_lake(spark, folder)}/gold/fact_transaction").select("transaction_id", "transaction_key")


REFRESHED_DIMS = {
    "fact_transaction": {"dim_merchant": "merchant_id", "dim_currency": "currency_code", "dim_transaction_status": "status_code"},
    "fact_refund": {"dim_merchant": "merchant_id", "dim_refund_reason": "reason_code"},
}

QUERIES: dict[str, Query] = {
    # Sources and raw layer
    "scan_transactions": lambda spark, folder: _raw(spark, folder, "transactions"),
    "scan_bronze_union": _scan_bronze_union,
    "audit_columns": _audit_columns,
    "incremental_slice_orders": _slice(ORDERS, ORDERS_AT),
    "incremental_slice_events": _slice(EVENTS, EVENTS_AT),
    "incremental_slice_null_watermarks": _slice_null_watermarks,
    "checkpoint_orders": _checkpoint(ORDERS),
    "checkpoint_events": _checkpoint(EVENTS),
    "audit_total_records": _audit_total_records,
    "stream_events_ingest": _stream_events_ingest,
    "stream_events_dedup": _stream_events_dedup,
    "stream_events_raw": _stream_events_raw,
    # Cleaning and matching
    "standardize_transactions": _standardized("transactions"),
    "standardize_refunds": _standardized("refunds"),
    "standardize_chargebacks": _standardized("chargebacks"),
    "dedup_transactions": _survivors("transactions"),
    "dedup_updated_transactions": _dedup_updated_transactions,
    "dedup_refunds": _survivors("refunds"),
    "dedup_chargebacks": _survivors("chargebacks"),
    "refund_agg": _rollup("refunds", "transaction_id", "refund_amount", "refund_date"),
    "chargeback_agg": _rollup("chargebacks", "transaction_id", "chargeback_amount", "chargeback_date"),
    "refund_counts": _rollup("refunds", "transaction_id", "refund_amount", "refund_count"),
    "chargeback_counts": _rollup("chargebacks", "transaction_id", "chargeback_amount", "chargeback_count"),
    "reconciliation_base": lambda spark, folder: warehouse(spark, folder).reconciliation_base,
    "profile_reconciliation_base": lambda spark, folder: profile(warehouse(spark, folder).reconciliation_base),
    # Quality
    "dq_report": lambda spark, folder: warehouse(spark, folder).quality_report(),
    "dq_summary": lambda spark, folder: summarize(warehouse(spark, folder).quality_report()),
    "dq_raw_uniqueness": lambda spark, folder: raw_uniqueness({e: _raw(spark, folder, e) for e in ENTITY_KEYS}),
    "orphan_refunds": _orphans("refunds"),
    "orphan_chargebacks": _orphans("chargebacks"),
    "rule_refund_amount": _broken("refunds", "refund_amount_rule"),
    "rule_chargeback_amount": _broken("chargebacks", "chargeback_amount_rule"),
    "rule_refund_date": _broken("refunds", "refund_date_rule"),
    "rule_chargeback_date": _broken("chargebacks", "chargeback_date_rule"),
    "rule_reconciled_total": _reconciled_total,
    # Star schema
    "implausible_dates": lambda spark, folder: implausible_dates(warehouse(spark, folder).silver, last="2001-06-30"),
    "date_bounds": lambda spark, folder: date_bounds(warehouse(spark, folder).silver),
    **{name: _gold(name) for name in GOLD_TABLES},
    "surrogate_key_orders": _surrogate_key_orders,
    "lookup_merchant_key": _lookup_merchant_key,
    "lookup_date_key": _lookup_date_key,
    "contract_fact_refund": _contract("fact_refund"),
    "contract_fact_transaction": _contract("fact_transaction"),
    "contract_fact_transaction_decimal": _contract("fact_transaction", decimal_money=True),
    "contract_violations": lambda spark, folder: contract_violations(warehouse(spark, folder).gold_tables()),
    "row_counts": _report(reports.row_counts, tables=tuple(GOLD_TABLES)),
    # A first load and a refresh from a second one
    "refreshed_fact_transaction": _refreshed("fact_transaction", REFRESHED_DIMS["fact_transaction"], "transaction_key"),
    "refreshed_fact_refund": _refreshed("fact_refund", REFRESHED_DIMS["fact_refund"], "refund_key"),
    "refreshed_transaction_keys": _refreshed_keys,
    # Reports
    "risk_summary": _report(reports.risk_summary),
    "vw_executive_summary": _report(reports.executive_summary),
    "vw_merchant_risk": _report(reports.merchant_risk),
    "bi_kpis": _report(reports.kpis),
    "bi_revenue_trend": _report(reports.revenue_trend),
    "bi_merchant_performance": _report(reports.merchant_performance),
    "bi_risk_by_merchant": _report(reports.risk_by_merchant),
    "bi_chargeback_reasons": _report(reports.chargeback_reasons),
    "bi_chargeback_trend": _report(reports.chargeback_trend),
    "bi_top_risk_merchants": _report(reports.top_risk_merchants),
    "bi_operational_metrics": _report(reports.operational_metrics),
    "bi_status_breakdown": _report(reports.status_breakdown),
    "bi_refund_vs_chargeback": _report(reports.refund_vs_chargeback),
    "bi_sliced_summary": _report(reports.sliced_summary, **SLICERS),
}
