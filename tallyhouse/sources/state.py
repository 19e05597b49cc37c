"""Load progress per entity, kept as an append-only Parquet table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyhouse.operators.incremental import Checkpoint, EntitySpec
from tallyhouse.sources.storage import if_present


class LoadState:
    """One folder per entity, so each keeps its watermark and key in their own types.

    A run appends one row; the newest row is the checkpoint. Nothing is rewritten,
    so a failure while saving leaves the previous checkpoint valid.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _path(self, spec: EntitySpec) -> str:
        return f"{self.root}/{spec.name}"

    def history(self, spec: EntitySpec) -> DataFrame | None:
        """All saved rows, none before the first load."""
        return if_present(lambda: self.spark.read.parquet(self._path(spec)))

    def latest(self, spec: EntitySpec) -> Checkpoint | None:
        history = self.history(spec)
        if history is None:
            return None
        newest = history.agg(F.max_by(F.struct("last_watermark", "last_key"), "updated_at").alias("row")).first()["row"]
        return None if newest is None else Checkpoint(newest["last_watermark"], newest["last_key"])

    def save(
        self,
        spec: EntitySpec,
        last_watermark: str,
        last_key: str | None,
        types: StructType,
        run_id: str,
        rows: int,
        bootstrapped: bool = False,
    ) -> None:
        """Append a checkpoint given as text; `types` is the schema its columns come from.

        Text to type and back loses nothing. The one ambiguous case, a local time
        repeated when clocks go back, reads as the earlier one, so rows are loaded
        twice (and deduplicated) rather than missed.
        """
        row = self.spark.range(0, 1, 1, 1).select(
            F.lit(spec.watermark_column).alias("watermark_column"),
            F.lit(spec.primary_key).alias("primary_key"),
            F.lit(last_watermark).cast(types[spec.watermark_column].dataType).alias("last_watermark"),
            F.lit(last_key).cast(types[spec.primary_key].dataType).alias("last_key"),
            F.current_timestamp().alias("updated_at"),
            F.lit(run_id).alias("pipeline_run_id"),
            F.lit(rows).cast("bigint").alias("records_loaded"),
            F.lit(bootstrapped).alias("bootstrapped_from_bronze"),
        )
        row.write.mode("append").parquet(self._path(spec))
