"""Incremental load of the source entities into the raw layer."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import UTC, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tallyhouse.operators.incremental import Checkpoint, EntitySpec, checkpoint_of, entity_specs, furthest, newer_rows
from tallyhouse.sources.audit import audit_frame, audit_row, write_audit
from tallyhouse.sources.bronze import (
    add_audit_columns,
    append_bronze,
    known_schemas,
    read_bronze,
    read_loads,
    remember_schema,
)
from tallyhouse.sources.state import LoadState
from tallyhouse.sources.storage import if_present, observed_write

Source = Callable[[str], DataFrame]


@dataclass
class BronzeLoader:
    """Loads entities under `root`; progress is saved per entity, right after its write."""

    spark: SparkSession
    root: str
    source: Source
    source_system: str
    run_id: str = field(default_factory=lambda: str(uuid.uuid4()))
    incremental: bool = True
    lookback: timedelta | float | None = None
    specs: dict[str, EntitySpec] = field(default_factory=entity_specs)

    def __post_init__(self) -> None:
        self.state = LoadState(self.spark, f"{self.root}/_state")
        self.audit_rows: list[tuple] = []

    def path(self, entity: str) -> str:
        return f"{self.root}/{entity}"

    def _schemas(self, entity: str) -> str:
        return f"{self.root}/_schemas/{entity}"

    def bronze(self, entity: str) -> DataFrame:
        """Everything loaded so far, also where columns or types have changed between loads."""
        schemas = known_schemas(self.spark, self._schemas(entity))
        return read_loads(self.spark, self.path(entity), schemas) if schemas else read_bronze(self.spark, self.path(entity))

    def _rebuilt_checkpoint(self, spec: EntitySpec, schema: StructType) -> Checkpoint | None:
        """Progress read off the loaded data, for when the state was lost."""
        loaded = if_present(lambda: self.bronze(spec.name))
        if loaded is None:
            return None
        found = checkpoint_of(loaded, spec)
        row = found.selectExpr("string(last_watermark) as watermark", "string(last_key) as key").first()
        if row is None:
            return None
        self.state.save(spec, row["watermark"], row["key"], schema, self.run_id, 0, bootstrapped=True)
        return self.state.latest(spec)

    def checkpoint(self, spec: EntitySpec, schema: StructType) -> Checkpoint | None:
        if not self.incremental:
            return None
        return self.state.latest(spec) or self._rebuilt_checkpoint(spec, schema)

    def load(self, entity: str) -> int:
        """Append the new rows of one entity and advance its checkpoint; returns how many.

        The source is read once: row count and furthest watermark are measured while
        writing. A failure after the write only means the rows come again next time.
        """
        spec = self.specs[entity]
        rows = 0
        try:
            audited = add_audit_columns(self.source(entity), self.run_id, self.source_system)
            remember_schema(self.spark, self._schemas(entity), audited.schema)
            new = newer_rows(audited, spec, self.checkpoint(spec, audited.schema), self.lookback)
            today = datetime.now(UTC).date()
            reached = furthest(spec)
            measured = observed_write(
                new,
                lambda df: append_bronze(df, self.path(entity), today),
                watermark=reached["last_watermark"].cast("string"),
                key=reached["last_key"].cast("string"),
            )
            rows = measured["rows"]
            if rows and measured["watermark"] is not None:
                self.state.save(spec, measured["watermark"], measured["key"], audited.schema, self.run_id, rows)
        except Exception as error:
            self._note(entity, rows, "FAILED", str(error))
            raise
        self._note(entity, rows, "SUCCESS")
        return rows

    def _note(self, entity: str, rows: int, status: str, message: str = "") -> None:
        self.audit_rows.append(
            audit_row(self.run_id, self.source_system, entity, self.path(entity), rows, status, message)
        )

    def load_all(self, audit_folder: str | None = None) -> dict[str, int]:
        """Load every entity; the audit is written even if one of them fails."""
        try:
            return {entity: self.load(entity) for entity in self.specs}
        finally:
            if audit_folder is not None and self.audit_rows:
                write_audit(self.audit(), audit_folder)

    def audit(self) -> DataFrame:
        return audit_frame(self.spark, self.audit_rows)
