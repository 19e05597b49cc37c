"""The raw layer: audit columns, partitioned append, and reading it back."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Mapping, Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType, TimestampNTZType, TimestampType

from tallyhouse.sources.storage import if_present

LOADED_AT = "load_timestamp"
PARTITION = "load_date"
# Second level of the folders: loads of unlike columns or types never share one.
SCHEMA_PARTITION = "load_schema"


def add_audit_columns(df: DataFrame, run_id: str, source_system: str, loaded_at: Column | None = None) -> DataFrame:
    """Load time, run id and source system on every row."""
    return df.withColumns(
        {
            LOADED_AT: F.current_timestamp() if loaded_at is None else loaded_at,
            "pipeline_run_id": F.lit(run_id),
            "source_system": F.lit(source_system),
        }
    )


def append_bronze(df: DataFrame, path: str, load_date: date, part: str | None = None) -> None:
    """Append one load as a partition; an empty load leaves no partition behind.

    With a `part`, the load has a folder of that name to itself and replaces what is in it.
    """
    folder = schema_name(df.schema) + (f".{part}" if part else "")
    writer = df.withColumns({PARTITION: F.lit(load_date.isoformat()), SCHEMA_PARTITION: F.lit(folder)}).write
    writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic") if part else writer.mode("append")
    writer.partitionBy(PARTITION, SCHEMA_PARTITION).parquet(path)


def schema_name(schema: StructType) -> str:
    """A short name for the columns and types of a load; nullability does not count."""
    columns = ",".join(f"{field.name} {field.dataType.simpleString()}" for field in schema)
    return f"s{hashlib.sha256(columns.encode()).hexdigest()[:16]}"


def remember_schema(spark: SparkSession, folder: str, schema: StructType) -> None:
    """Append a schema to the list kept in `folder`, unless it is there."""
    if schema_name(schema) not in known_schemas(spark, folder):
        row = spark.createDataFrame([(schema_name(schema), schema.json())], "name string, columns string")
        row.coalesce(1).write.mode("append").parquet(folder)


def known_schemas(spark: SparkSession, folder: str) -> dict[str, StructType]:
    """All schemas loads have had so far, by name; as many rows as the source has changed."""
    kept = if_present(lambda: spark.read.schema("name string, columns string").parquet(folder))
    if kept is None:
        return {}
    return {row["name"]: StructType.fromJson(json.loads(row["columns"])) for row in kept.distinct().collect()}


def read_loads(spark: SparkSession, path: str, schemas: Mapping[str, StructType]) -> DataFrame:
    """All loads, whatever columns each had: one scan per layout and schema, prunable by load date.

    Loads written before folders were told apart by schema lie straight under their date;
    they are one scan more. A column that a load lacks is null there. Where loads disagree
    on a type, times come as zoned timestamps and all else as text, which cleaning casts to
    the published type. Without any load there are no rows.
    """

    def found(folders: str, schema: StructType | None = None) -> DataFrame | None:
        reader = spark.read.option("basePath", path)
        return if_present(lambda: (reader if schema is None else reader.schema(schema)).parquet(f"{path}/{PARTITION}=*/{folders}"))

    scans = [found(f"{SCHEMA_PARTITION}={name}*", schema) for name, schema in sorted(schemas.items())] + [found("*.parquet")]
    loads = [scan.drop(SCHEMA_PARTITION) for scan in scans if scan is not None]
    if not loads:
        nothing = [spark.createDataFrame([], schema).withColumn(PARTITION, F.lit(None).cast("date")) for schema in schemas.values()]
        return union_by_name(nothing)
    kinds: dict[str, set] = {}
    for load in loads:
        for field in load.schema:
            kinds.setdefault(field.name, set()).add(field.dataType)

    def agreed(name: str) -> Column:
        times = {TimestampType(), TimestampNTZType()}
        if len(kinds[name]) == 1:
            return F.col(name)
        return F.col(name).cast("timestamp" if kinds[name] <= times else StringType())

    return union_by_name([_zoned_load_time(load.select(*(agreed(name).alias(name) for name in load.columns))) for load in loads])


def _zoned_load_time(df: DataFrame) -> DataFrame:
    """Loads written by different tools disagree on whether the load time carries a zone."""
    return df.withColumn(LOADED_AT, F.col(LOADED_AT).cast("timestamp")) if LOADED_AT in df.columns else df


def read_bronze(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """All loads in one scan, prunable by load date.

    With a schema, columns a load does not have come back as null and no footers
    are read on the driver. Without one, Spark infers it from the files.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    return _zoned_load_time(reader.parquet(path))


def union_by_name(parts: Sequence[DataFrame]) -> DataFrame:
    """Rows of all parts; a column missing from a part is null there."""
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), parts)


def read_parts(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Read folders whose schemas differ.

    Folders with the same schema share one scan, so the plan grows with the number
    of schemas, not with the number of folders.
    """
    by_schema: dict[str, list[str]] = {}
    for path in paths:
        by_schema.setdefault(spark.read.parquet(path).schema.json(), []).append(path)
    return union_by_name([_zoned_load_time(spark.read.parquet(*same)) for same in by_schema.values()])
