"""One full run: load, clean, match, check, build the star schema."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession

from tallyhouse.fixed_values import ENTITY_KEYS
from tallyhouse.operators.quality import require
from tallyhouse.plans.bronze_load import BronzeLoader, Source
from tallyhouse.plans.warehouse import DIMENSIONS, FACTS, Warehouse, together
from tallyhouse.sources.audit import loaded_records, write_metrics, write_quality
from tallyhouse.sources.gold import publish, write_dimension, write_fact
from tallyhouse.sources.storage import Stored, TableStore


def gold_from_silver(spark: SparkSession, lake: str) -> dict[str, int]:
    """Build the star schema from the cleaned tables a run has stored, without touching the raw layer."""
    scratch = TableStore(spark)
    try:
        warehouse = Warehouse(spark, {}, TableStore(spark, lake), scratch)
        for entity in ENTITY_KEYS:
            path = warehouse.store.path(f"silver/{entity}")
            silver = spark.read.parquet(path)
            warehouse.stored_silver[entity] = Stored(silver, silver.count(), path)
        return star_layer(warehouse, f"{lake}/gold")
    finally:
        scratch.drop()


def publish_stored(spark: SparkSession, lake: str, database: str) -> dict[str, int]:
    """Load the star schema a run has stored into a catalog database, dimensions first."""
    return {name: publish(spark.read.parquet(f"{lake}/gold/{name}"), name, database) for name in DIMENSIONS + FACTS}


@dataclass
class RunResult:
    """What a run loaded and built."""

    run_id: str
    loaded: dict[str, int]
    rejected: dict[str, int]
    gold_rows: dict[str, int] = field(default_factory=dict)


def clean_layer(warehouse: Warehouse, reports: str, fail_on: tuple[str, ...] = ()) -> DataFrame:
    """Silver tables, matched base, quality report and rejected rows; returns the stored report."""
    steps = [lambda entity=entity: warehouse.rejected_rows[entity] for entity in warehouse.bronze]
    together(warehouse.spark, [*steps, lambda: warehouse.stored_match])
    write_quality(warehouse.quality_report(), reports)
    report = warehouse.spark.read.json(f"{reports}/dq_report")
    require(report, fail_on)
    return report


def star_layer(warehouse: Warehouse, folder: str) -> dict[str, int]:
    """Write all gold tables under `folder`; returns their row counts."""
    warehouse.build_gold()
    rows: dict[str, int] = {}

    def write(name: str) -> None:
        path = f"{folder}/{name}"
        table = warehouse.gold(name)
        rows[name] = write_fact(table, name, path) if name in FACTS else write_dimension(table, path)

    together(warehouse.spark, (lambda name=name: write(name) for name in DIMENSIONS + FACTS))
    return {name: rows[name] for name in DIMENSIONS + FACTS}


def publish_all(warehouse: Warehouse, database: str) -> dict[str, int]:
    """Load all gold tables into a catalog database, dimensions first."""
    return {name: publish(warehouse.gold(name), name, database) for name in DIMENSIONS + FACTS}


def run(
    spark: SparkSession,
    source: Source,
    lake: str,
    source_system: str,
    fail_on: tuple[str, ...] = (),
    **loading,
) -> RunResult:
    """Bring the lake under `lake` up to date from `source` (entity name -> DataFrame).

    Metrics are written for failed runs too, and intermediate tables are dropped
    either way. `loading` is passed to the loader (incremental, lookback, run_id,
    specs).
    """
    started = datetime.now(UTC)
    reports = f"{lake}/reports"
    loader = BronzeLoader(spark, f"{lake}/bronze", source, source_system, **loading)
    status = "FAILED"
    scratch = TableStore(spark)
    try:
        loaded = loader.load_all(reports)
        bronze = {entity: loader.bronze(entity) for entity in loader.specs}
        warehouse = Warehouse(spark, bronze, TableStore(spark, lake), scratch)
        clean_layer(warehouse, reports, fail_on)
        gold_rows = star_layer(warehouse, f"{lake}/gold")
        status = "SUCCESS"
    finally:
        scratch.drop()
        records = loaded_records(loader.audit()).first()["total_records"] if loader.audit_rows else 0
        write_metrics(spark, reports, started, datetime.now(UTC), records, status)
    return RunResult(loader.run_id, loaded, dict(warehouse.rejected_rows), gold_rows)
