"""Gap-free surrogate keys 1..n in the order of an id, without a single-task sort."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.sources.storage import Stored, TableStore

PLACE = "__place"
# monotonically_increasing_id() holds the task number above this bit and the row's
# position inside the task below it.
_POSITION_BITS = 33


def placed(df: DataFrame, order_by: str) -> DataFrame:
    """Rows in ranges of `order_by`, each with its task and position in `__place`.

    To find the range bounds Spark runs `df` a second time for a sample of the ids,
    so give it a plain scan and do further work (such as key lookups) on the result.
    """
    ranged = df.repartitionByRange(F.col(order_by)).sortWithinPartitions(order_by)
    return ranged.withColumn(PLACE, F.monotonically_increasing_id())


def numbered(rows: DataFrame, key: str, store: TableStore, name: str, kind: str = "bigint") -> Stored:
    """Turn the places into keys.

    Range bounds are sampled, so the rows are written with their places and read
    back, and places are never computed twice. A row's key is its position plus the
    rows in earlier tasks; those counts are one number per task, the only thing the
    driver sees.
    """
    stored = store.save(rows, name)
    task = F.shiftright(F.col(PLACE), _POSITION_BITS)
    sizes = stored.df.groupBy(task.alias("task")).agg(F.count(F.lit(1)).alias("n")).collect()
    size_of = {row["task"]: row["n"] for row in sizes}
    starts, seen = [], 0
    for number in range(max(size_of, default=0) + 1):
        starts.append(f"{seen}L")
        seen += size_of.get(number, 0)
    before = F.expr(f"array({','.join(starts)})")[task.cast("int")]
    position = F.col(PLACE).bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    keyed = stored.df.withColumn(key, (before + position + 1).cast(kind)).drop(PLACE)
    return stored._replace(df=keyed.select(key, *(column for column in rows.columns if column != PLACE)))


def with_dense_key(df: DataFrame, order_by: str, key: str, store: TableStore, name: str, kind: str = "bigint") -> Stored:
    """Number the rows of `df` by `order_by` (unique, not null), as row_number() would."""
    return numbered(placed(df, order_by), key, store, name, kind)
