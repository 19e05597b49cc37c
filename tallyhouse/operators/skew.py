"""Joins that stay balanced when a few keys hold most of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SALT = "__salt"
_COPIES = "__copies"

# Keys above this share of the rows are split by hand; AQE splits what is left.
_MAX_HEAVY = 10_000
_MERGE_GROUPS = 512


def spread_of(df: DataFrame) -> int:
    """How many tasks hot rows may be spread over: as many as a shuffle has."""
    return max(8, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def heavy_keys(rows: DataFrame, key: str, spread: int) -> DataFrame:
    """Keys holding a large share of the rows, with the number of tasks each deserves.

    At most `limit` keys can hold more than 1/limit of the rows, so the result is
    small whatever the data. It comes from a frequent-items sketch: one pass over
    one column, and a shuffle of sketches that are merged in two steps so that no
    task receives one from every map task. The sketch steers balance; it never
    decides which rows are in a result.
    """
    limit = min(spread, _MAX_HEAVY)
    tracked = F.lit(8 * limit)
    sketches = (
        rows.where(F.col(key).isNotNull())
        .select(key, F.pmod(F.spark_partition_id(), F.lit(_MERGE_GROUPS)).alias("part"))
        .groupBy("part")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.call_function("approx_top_k_accumulate", F.col(key), tracked).alias("sketch"),
        )
    )
    # Grouping by a constant gives no row, instead of an invalid sketch, on empty input.
    merged = sketches.groupBy(F.lit(0).alias("all")).agg(
        F.sum("n").alias("n"),
        F.call_function("approx_top_k_combine", F.col("sketch"), tracked).alias("sketch"),
    )
    top = F.call_function("approx_top_k_estimate", F.col("sketch"), F.lit(limit))
    return (
        merged.select("n", F.explode(top).alias("entry"))
        .select(
            F.col("entry.item").alias(key),
            F.ceil(F.col("entry.count") * F.lit(spread) / F.col("n")).cast("int").alias(_COPIES),
        )
        .where(F.col(_COPIES) > 1)
    )


def join_unique(
    many: DataFrame,
    one: DataFrame,
    key: str,
    spread_by: Sequence[str],
    how: str = "left",
) -> DataFrame:
    """Join rows to a table that has at most one row per key, splitting hot keys.

    A hot key's rows are dealt over several tasks by a hash of `spread_by` (columns
    that tell the rows apart), and its single partner row is repeated once per
    task. Rows with a null key have no partner and are dealt over all tasks. The
    hash is a function of the row, so a retried task deals the same way.

    The hot keys are fetched first: a sketch may come out a little different each
    time it is computed, and both sides must deal by the same one.
    """
    spread = spread_of(many)
    heavy = heavy_keys(many, key, spread)
    found = heavy.collect()  # at most _MAX_HEAVY rows
    dealt = F.pmod(F.xxhash64(*spread_by), F.lit(spread)).cast("int")
    if found:
        fixed = F.broadcast(many.sparkSession.createDataFrame(found, heavy.schema))
        copies = F.coalesce(F.col(_COPIES), F.lit(1))
        left, right = many.join(fixed, key, "left"), one.join(fixed, key, "left")
    else:
        copies, left, right = F.lit(1), many, one
    salt = F.when(F.col(key).isNull(), dealt).otherwise(F.pmod(dealt, copies))
    repeats = F.explode(F.sequence(F.lit(0), copies - 1)) if found else F.lit(0)
    left = left.withColumn(_SALT, salt).select(*many.columns, _SALT)
    right = right.withColumn(_SALT, repeats).select(*one.columns, _SALT)
    return left.join(right, [key, _SALT], how).drop(_SALT)
