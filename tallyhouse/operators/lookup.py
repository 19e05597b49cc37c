"""Replacing natural keys by the surrogate keys of a dimension."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.operators.skew import join_unique
from tallyhouse.sources.storage import Stored

# A dimension is sent to every executor only up to this many (code, key) pairs,
# roughly 50 MB; the number of rows is known from writing it.
BROADCAST_ROWS = 500_000


def lookup_key(
    rows: DataFrame,
    dimension: Stored,
    code: str,
    dimension_code: str,
    key: str,
    spread_by: Sequence[str],
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Add `key` where `code` equals `dimension_code`; null where there is no match.

    A small dimension is broadcast. Beyond the limit the rows are shuffled by code
    with hot codes split, so one merchant with a third of all rows is no bottleneck.
    """
    pairs = dimension.df.select(F.col(dimension_code).alias(code), F.col(key))
    if dimension.rows <= broadcast_rows:
        return rows.join(F.broadcast(pairs), code, "left")
    return join_unique(rows, pairs, code, spread_by, "left")
