"""Session settings the library expects. An existing session is used as it is."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A shuffled join hashes instead of sorting once every partition is known to be this small.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    "spark.sql.parquet.compression.codec": "snappy",
}


def get_session(app_name: str = "tallyhouse", master: str | None = None, **extra: str) -> SparkSession:
    """Get or create a session; pass further settings as `**{"spark.some.key": "value"}`.

    Shuffle partitions are left to the cluster: AQE merges small ones, so a large
    number is safe, while a number tuned to a laptop would not be.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
