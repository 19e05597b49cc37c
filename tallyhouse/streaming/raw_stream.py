"""A stream of one entity into the raw layer, each micro-batch once, with its progress and audit."""

from __future__ import annotations

import re
from dataclasses import dataclass
from datetime import UTC, date, datetime

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyhouse.operators.incremental import furthest
from tallyhouse.plans.bronze_load import BronzeLoader
from tallyhouse.sources.audit import audit_frame, audit_row
from tallyhouse.sources.bronze import add_audit_columns, append_bronze, remember_schema
from tallyhouse.sources.storage import if_present, observed_write


@dataclass(frozen=True)
class RawStream:
    """Lands micro-batches beside the loads of `loader`, which reads them like any other.

    A batch owns one folder, named by the stream and the number of the batch under the day
    it was first tried on. That day is noted before the batch is written, so a batch that
    comes again after a failure replaces what it left behind, on a later day too, and one
    that was finished is left out. All rows are loaded, in whatever order their files
    arrive; the checkpoint of the entity only moves forward.

    `name` must stay with the stream's checkpoint folder: another stream needs another name.
    """

    loader: BronzeLoader
    entity: str
    name: str

    def __post_init__(self) -> None:
        if not re.fullmatch("[A-Za-z0-9_-]+", self.name):
            raise ValueError(f"the name of a stream becomes a folder: {self.name!r} has other signs than letters, digits, - and _")

    def _notes(self, batch_id: int | str, what: str) -> str:
        return f"{self.loader.root}/_batches/{self.entity}/{self.name}/{batch_id}/{what}"

    def _noted(self, batch_id: int, what: str) -> Row | None:
        """What was noted on a batch; a note whose writing failed counts for nothing."""
        kept = if_present(lambda: self.loader.spark.read.parquet(f"{self._notes(batch_id, what)}/*.parquet"))
        return None if kept is None else kept.first()

    def _load_date(self, batch_id: int) -> date:
        begun = self._noted(batch_id, "begun")
        if begun is not None:
            return begun["load_date"]
        today = datetime.now(UTC).date()
        note = self.loader.spark.range(0, 1, 1, 1).select(F.lit(today).alias("load_date"))
        note.write.mode("overwrite").parquet(self._notes(batch_id, "begun"))
        return today

    def land(self, batch: DataFrame, batch_id: int) -> None:
        """Write one batch, move the checkpoint, and note the batch as finished."""
        if self._noted(batch_id, "done") is not None:
            return
        loader, spec = self.loader, self.loader.specs[self.entity]
        run_id, path = f"{self.name}-{batch_id}", loader.path(self.entity)
        audited = add_audit_columns(batch, run_id, loader.source_system)
        remember_schema(loader.spark, f"{loader.root}/_schemas/{self.entity}", audited.schema)
        known = loader.checkpoint(spec, audited.schema)
        day, reached = self._load_date(batch_id), furthest(spec)
        measured = observed_write(
            audited,
            lambda df: append_bronze(df, path, day, part=run_id),
            reached=reached,
            watermark=reached["last_watermark"].cast("string"),
            key=reached["last_key"].cast("string"),
        )
        here = measured["reached"]
        if here is not None and (known is None or tuple(here) > (known.watermark, known.key)):
            loader.state.save(spec, measured["watermark"], measured["key"], audited.schema, run_id, measured["rows"])
        row = audit_row(run_id, loader.source_system, self.entity, path, measured["rows"], "SUCCESS")
        audit_frame(loader.spark, [row]).coalesce(1).write.mode("overwrite").parquet(self._notes(batch_id, "done"))

    def land_available(self, stream: DataFrame, checkpoint: str) -> StreamingQuery:
        """Land everything that has arrived and stop; the stream's own progress lives in `checkpoint`."""
        writer = stream.writeStream.foreachBatch(self.land).option("checkpointLocation", checkpoint)
        query = writer.trigger(availableNow=True).start()
        query.awaitTermination()
        return query

    def audit(self) -> DataFrame:
        """One audit row per finished batch."""
        loader = self.loader
        kept = if_present(lambda: loader.spark.read.parquet(f"{self._notes('*', 'done')}/*.parquet"))
        return audit_frame(loader.spark, []) if kept is None else kept
