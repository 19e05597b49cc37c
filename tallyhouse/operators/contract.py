"""The published table contract: shaping a table to it, and counting what breaks it."""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.fixed_values import GOLD_TABLES, MONEY_DIGITS, PUBLISHED_NAMES, Field
from tallyhouse.functions.labels import mapped


class ContractError(ValueError):
    """A table lacks a published column."""


def prepare(df: DataFrame, table: str, upper_names: bool = True, decimal_money: bool = False) -> DataFrame:
    """Rename, select in order, fill required measures, coerce whole numbers, upper-case names.

    A key or count that is no whole number becomes null; a missing measure (null or
    not a number) becomes the contract's default. With `decimal_money`, amounts have the
    contract's digits, rounded half up; one that does not fit becomes null, as the
    contract's own checks report.
    """
    df = df.withColumnsRenamed(PUBLISHED_NAMES.get(table, {}))
    fields = GOLD_TABLES[table]
    missing = [field.name for field in fields if field.name not in df.columns]
    if missing:
        raise ContractError(f"{table} lacks published columns: {missing}")
    kinds = dict(df.dtypes)

    def shaped(field: Field):
        column = F.col(field.name)
        if field.kind in ("int", "bigint") and kinds[field.name] != field.kind:
            column = _whole(column, kinds[field.name], field.kind)
        if field.filled_with is not None:
            column = F.coalesce(F.when(~F.isnan(column), column), F.lit(field.filled_with))
        if decimal_money and field.kind == "double":
            column = column.try_cast("decimal({},{})".format(*MONEY_DIGITS))
        return column.alias(field.name.upper() if upper_names else field.name)

    return df.select(*(shaped(field) for field in fields))


def _whole(column: Column, given: str, wanted: str) -> Column:
    """The value as an integer, null when it has a fraction, is no number or does not fit."""
    if given in ("tinyint", "smallint", "int", "bigint"):
        return column.try_cast(wanted)
    number = column.try_cast("double")
    rounded = F.when(number == F.floor(number), number.try_cast(wanted))
    return F.coalesce(column.try_cast(wanted), rounded) if given == "string" else rounded


class Check(NamedTuple):
    """One rule on one column of one table."""

    table_name: str
    rule: str
    column_name: str


_KEYED = ("primary_key", "foreign_key")


def _checks(table: str) -> list[Check]:
    """All rules of a table."""
    fields = GOLD_TABLES[table]
    found = [Check(table, "primary_key", fields[0].name)]
    for field in fields:
        applies = {
            "not_null": field.required,
            "max_length": field.length is not None,
            "foreign_key": field.references is not None,
            "precision": field.kind == "double",
        }
        found += [Check(table, rule, field.name) for rule, holds in applies.items() if holds]
    return found


def _breaks(check: Check) -> Column:
    """Whether a row breaks a rule that a single row can break."""
    column = F.col(check.column_name)
    field = next(field for field in GOLD_TABLES[check.table_name] if field.name == check.column_name)
    limit = float(10 ** (MONEY_DIGITS[0] - MONEY_DIGITS[1]))
    return {
        "not_null": column.isNull,
        "max_length": lambda: F.length(column) > field.length,
        "precision": lambda: F.abs(F.round(column, MONEY_DIGITS[1])) >= limit,
    }[check.rule]()


def _entries(df: DataFrame, places: dict[Check, tuple[int, int]], table: str) -> DataFrame:
    """(target, slot, key) from one scan of a table: its keys, each row once per key, and the rules its rows break."""
    keyed = [check for check in places if check.table_name == table and check.rule in _KEYED]
    plain = [check for check in places if check.table_name == table and check.rule not in _KEYED]
    none = F.lit(None).cast("bigint")

    def entry(check: Check, key: Column) -> Column:
        target, slot = places[check]
        return F.struct(F.lit(target).alias("target"), F.lit(slot).alias("slot"), key.alias("key"))

    found = [entry(check, F.col(check.column_name).cast("bigint")) for check in keyed]
    found += [F.when(_breaks(check), entry(check, none)) for check in plain]
    return df.select(F.explode(F.array_compact(F.array(*found))).alias("found")).select("found.*")


def _violations(tables: dict[str, DataFrame], checks: list[Check]) -> DataFrame:
    """One row per check with the number of rows that break it, zeros included.

    Every table is scanned once. Keys are counted inside the map tasks, so a hot key weighs
    as much as any other, and shuffled once: the counts of a dimension's own keys and of the
    facts' references to them lie in slots of one row per key. So neither facts nor
    dimensions are joined.
    """
    owner = {check: Check(target, "primary_key", GOLD_TABLES[target][0].name) for check in checks for target in [_target(check)] if target}
    everything = list(dict.fromkeys([*owner.values(), *checks]))
    sharing: dict[Check, list[Check]] = {}
    for check in everything:
        sharing.setdefault(owner.get(check, check), []).append(check)
    # The slot of a target's own keys, or of the rows that break a plain rule, is the first.
    places = {check: (number, slot) for number, alike in enumerate(sharing.values()) for slot, check in enumerate(alike)}
    width = max(map(len, sharing.values()))
    names = list(dict.fromkeys(check.table_name for check in everything))
    counts = (F.count_if(F.col("slot") == slot).alias(f"n{slot}") for slot in range(width))
    per_key = (
        reduce(DataFrame.unionByName, (_entries(tables[name], places, name) for name in names))
        .groupBy("target", "key")
        .agg(*counts)
    )
    unique = [places[check][0] for check in everything if check.rule == "primary_key"]
    own = F.col("n0")
    repeated = F.when(F.col("target").isin(unique) & (own > 0), own - 1).otherwise(own)
    missing = F.col("key").isNotNull() & (own == 0)
    broken = [repeated] + [F.when(missing, F.col(f"n{slot}")).otherwise(0) for slot in range(1, width)]
    number = {check: target * width + slot for check, (target, slot) in places.items()}
    spark = tables[names[0]].sparkSession
    listed = [number[check] for check in checks]
    zeros = spark.range(1).select(F.explode(F.array(*map(F.lit, listed))).alias("check"), F.lit(0).cast("bigint").alias("broken"))
    found = (
        per_key.groupBy("target")
        .agg(F.array(*(F.sum(value) for value in broken)).alias("sums"))
        .select("target", F.posexplode("sums").alias("slot", "broken"))
        .select((F.col("target") * width + F.col("slot")).alias("check"), "broken")
    )
    return (
        found.union(zeros)
        .where(F.col("check").isin(listed))
        .groupBy("check")
        .agg(F.sum("broken").alias("violations"))
        .select(*(mapped("check", {number[c]: c[at] for c in checks}).alias(name) for at, name in enumerate(Check._fields)), "violations")
    )


def _target(check: Check) -> str | None:
    """The dimension a foreign key points to."""
    if check.rule != "foreign_key":
        return None
    return next(field.references for field in GOLD_TABLES[check.table_name] if field.name == check.column_name)


def column_violations(df: DataFrame, table: str) -> DataFrame:
    """Not null, text length and money precision of one table."""
    return _violations({table: df}, [check for check in _checks(table) if check.rule not in _KEYED])


def primary_key_violations(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows beyond the first of each primary key."""
    return _violations(tables, [check for table in tables for check in _checks(table) if check.rule == "primary_key"])


def foreign_key_violations(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows whose key is missing from the dimension."""
    return _violations(tables, [check for table in tables for check in _checks(table) if check.rule == "foreign_key"])


def contract_violations(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table, rule and column with the number of rows that break it, zeros included."""
    return _violations(tables, [check for table in tables for check in _checks(table)])
