"""Loading files as they arrive, each exactly once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def file_stream(
    spark: SparkSession, folder: str, schema: StructType, only: str | None = None, files_per_batch: int | None = None
) -> DataFrame:
    """Parquet files of a folder as a stream; `only` is a name pattern."""
    reader = spark.readStream.schema(schema)
    if only is not None:
        reader = reader.option("pathGlobFilter", only)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def drop_repeats(stream: DataFrame, key: str, event_time: str, within: str) -> DataFrame:
    """Drop rows whose key was seen within `within` of event time; state is kept only that long.

    Rows arriving later than `within` are dropped by the watermark, so this is for
    sources with a known bound on lateness. Without such a bound leave repeats in:
    deduplication of the cleaned layer removes them and loses nothing. `late_rows`
    tells how many were dropped.
    """
    timed = stream.withColumn(event_time, F.col(event_time).cast("timestamp"))
    return timed.withWatermark(event_time, within).dropDuplicatesWithinWatermark([key])


def late_rows(query: StreamingQuery) -> int:
    """Rows a finished query has dropped because they came later than its bound allows."""
    steps = (step for progress in query.recentProgress for step in progress["stateOperators"])
    return sum(step["numRowsDroppedByWatermark"] for step in steps)


def append_available(stream: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Write everything that has arrived and stop; progress lives in `checkpoint`."""
    query = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(target)
    )
    query.awaitTermination()
    return query
