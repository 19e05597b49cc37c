"""Audit rows of loads and metrics of whole runs."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.fixed_values import AUDIT_FIELDS, METRIC_FIELDS

_NUMBERS = {"records_inserted", "records_processed"}


def _schema(fields: Sequence[str]) -> str:
    return ", ".join(f"{name} {'bigint' if name in _NUMBERS else 'string'}" for name in fields)


def audit_row(
    run_id: str, source_system: str, entity: str, bronze_path: str, rows: int, status: str, message: str = ""
) -> tuple:
    now = datetime.now(UTC).replace(tzinfo=None).isoformat()
    return (now, run_id, source_system, entity, entity, bronze_path, int(rows), status, message)


def audit_frame(spark: SparkSession, rows: Sequence[tuple]) -> DataFrame:
    return spark.createDataFrame(list(rows), _schema(AUDIT_FIELDS))


def write_audit(df: DataFrame, folder: str) -> None:
    """Append to the history and replace the last run."""
    for name, mode in (("bronze_load_audit", "append"), ("bronze_load_last_run", "overwrite")):
        df.coalesce(1).write.mode(mode).option("header", True).csv(f"{folder}/{name}")


def loaded_records(audit: DataFrame) -> DataFrame:
    """Rows brought in by the loads that succeeded."""
    succeeded = F.when(F.col("status") == "SUCCESS", F.col("records_inserted"))
    return audit.agg(F.coalesce(F.sum(succeeded), F.lit(0)).alias("total_records"))


def write_metrics(
    spark: SparkSession, folder: str, started: datetime, finished: datetime, records: int, status: str
) -> None:
    """Append one row per run."""
    row = (str(started), str(finished), int(records), status)
    df = spark.createDataFrame([row], _schema(METRIC_FIELDS))
    df.coalesce(1).write.mode("append").option("header", True).csv(f"{folder}/pipeline_metrics")


def write_quality(report: DataFrame, folder: str) -> None:
    """Thirteen rows of JSON, replaced each run."""
    report.coalesce(1).write.mode("overwrite").json(f"{folder}/dq_report")
