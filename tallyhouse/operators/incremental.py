"""High-watermark loading: which rows are new, and how far a batch got."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timedelta
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.fixed_values import ENTITY_KEYS


@dataclass(frozen=True)
class EntitySpec:
    """What is loaded and by which columns progress is measured."""

    name: str
    watermark_column: str
    primary_key: str


@dataclass(frozen=True)
class Checkpoint:
    """Last loaded watermark and the largest key at that watermark, in their own types."""

    watermark: date | datetime | int | str
    key: Any = None


def entity_specs(overrides: dict[str, dict[str, str]] | None = None) -> dict[str, EntitySpec]:
    """The three entities, with configured watermark columns or keys where given."""
    specs = {}
    for name, (watermark, key) in ENTITY_KEYS.items():
        given = (overrides or {}).get(name, {})
        specs[name] = EntitySpec(name, given.get("watermark_column", watermark), given.get("primary_key", key))
    return specs


def _literal(df: DataFrame, column: str, value: Any) -> Column:
    """Literal of the column's own type; zone-less timestamps must not pass through a time zone."""
    if isinstance(value, datetime) and dict(df.dtypes)[column] == "timestamp_ntz":
        return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")
    return F.lit(value)


def newer_rows(
    df: DataFrame, spec: EntitySpec, checkpoint: Checkpoint | None, lookback: timedelta | float | None = None
) -> DataFrame:
    """Rows after the checkpoint: a later watermark, the same one with a larger key, or none at all.

    A row without a watermark cannot be told to be old, so it comes with every load;
    deduplication removes what was read twice, and nothing is lost. `lookback` rereads
    that much before the watermark (a timedelta, or a number for numeric watermarks) to
    catch late rows. Without a checkpoint everything is new. The predicates are plain
    comparisons, so they reach the Parquet or JDBC scan.
    """
    if checkpoint is None:
        return df
    watermark = F.col(spec.watermark_column)
    reached = _literal(df, spec.watermark_column, checkpoint.watermark)
    if lookback is not None:
        newer = watermark >= _literal(df, spec.watermark_column, _before(checkpoint.watermark, lookback))
    elif checkpoint.key is None:
        newer = watermark > reached
    else:
        past_key = F.col(spec.primary_key) > _literal(df, spec.primary_key, checkpoint.key)
        newer = (watermark >= reached) & ((watermark > reached) | past_key)
    return df.where(newer | watermark.isNull())


def _before(watermark: Any, lookback: timedelta | float) -> Any:
    """The watermark that much earlier; kinds that do not go together are refused by name."""
    is_time, is_span = isinstance(watermark, date), isinstance(lookback, timedelta)
    if is_time != is_span or isinstance(watermark, str):
        raise ValueError(
            f"a lookback of {lookback!r} does not fit the watermark {watermark!r}:"
            " time needs a timedelta, numbers need a number, and text has no distance"
        )
    return watermark - lookback


def furthest(spec: EntitySpec) -> Column:
    """Aggregate giving the largest (watermark, key) of a batch in one pass; keys compare in their own type."""
    watermark = F.col(spec.watermark_column)
    pair = F.struct(watermark.alias("last_watermark"), F.col(spec.primary_key).alias("last_key"))
    return F.max(F.when(watermark.isNotNull(), pair))


def checkpoint_of(df: DataFrame, spec: EntitySpec) -> DataFrame:
    """One row with the checkpoint of a dataset, none if it has no watermark."""
    return (
        df.agg(furthest(spec).alias("reached"))
        .where(F.col("reached").isNotNull())
        .select(
            F.lit(spec.name).alias("entity"),
            F.lit(spec.watermark_column).alias("watermark_column"),
            F.lit(spec.primary_key).alias("primary_key"),
            "reached.last_watermark",
            "reached.last_key",
        )
    )
