"""Bringing the star schema up to date from new loads only.

What a load can change follows from its keys: the rows of these keys, the transactions
they refer to now and before, and the months these are dated in. Only those are worked on:

* cleaned tables are kept in buckets by key; a new load is merged into the buckets of its keys
* refunds and chargebacks are kept a second time, narrow and in buckets by transaction, so
  that the totals of a touched transaction are added up anew from its own bucket
* new codes and new rows get the surrogate keys after the last one; given keys never change
* facts are rewritten for the months touched, all other months stay as they are, file by file

Facts are written before the cleaned tables, and a load counts as merged when all is
written. A run that fails in between is repeated by the next one: rows already placed are
found with their keys in the months that are read again.

Differences to a full rebuild: surrogate keys follow the order of arrival, codes that no
longer occur keep their row in a dimension, and the calendar only grows. The quality
checks are left to the full run.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyhouse.fixed_values import ENTITY_KEYS, ENTITY_MEASURES
from tallyhouse.functions.calendar import date_key
from tallyhouse.operators.dedup import deduplicate, survivor_order, without_key
from tallyhouse.operators.dense_key import with_dense_key
from tallyhouse.operators.reconcile import match
from tallyhouse.operators.standardize import ensure_column, standardize
from tallyhouse.plans import dimensions, facts
from tallyhouse.plans.bronze_load import BronzeLoader, Source
from tallyhouse.plans.daily_run import star_layer
from tallyhouse.plans.warehouse import DIMENSIONS, FACTS, Warehouse, together
from tallyhouse.sources.bronze import LOADED_AT, PARTITION, union_by_name
from tallyhouse.sources.buckets import BucketedTable, among, remove_folder
from tallyhouse.sources.gold import CLUSTERING, MONTH, month_of, write_fact
from tallyhouse.sources.storage import Stored, TableStore, if_present

_LOAD_COLUMNS = (LOADED_AT, "pipeline_run_id", PARTITION)
_DETAILS = ("refunds", "chargebacks")
_NEW, _STATE = "__new", "__state"
FACT_ENTITIES = {"fact_transaction": "transactions", "fact_refund": "refunds", "fact_chargeback": "chargebacks"}
CODED = tuple(name for name in DIMENSIONS if name != "dim_date")


class Change(NamedTuple):
    """What new loads do to an entity."""

    buckets: list[int]  # of the keys loaded
    merged: DataFrame  # surviving rows of these buckets
    changed: DataFrame  # keys whose surviving row differs in more than when it was loaded
    was: DataFrame  # their rows before
    now: DataFrame  # their rows after


@dataclass
class RefreshResult:
    """What a refresh loaded, and the months of each fact that it wrote anew."""

    run_id: str
    loaded: dict[str, int]
    rebuilt: bool = False
    months: dict[str, list] = field(default_factory=dict)
    added_rows: dict[str, int] = field(default_factory=dict)


class Progress:
    """Runs merged and surrogate keys given, in tables that are only appended to."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def merged(self) -> DataFrame | None:
        return if_present(lambda: self.spark.read.schema("run string, day date").parquet(f"{self.root}/merged"))

    def save_merged(self, runs: DataFrame) -> None:
        runs.coalesce(1).write.mode("append").parquet(f"{self.root}/merged")

    def last_key(self, table: str, kind: str = "keys") -> int:
        given = self.spark.read.schema("table string, last_key long").parquet(f"{self.root}/{kind}")
        return given.where(F.col("table") == table).agg(F.max("last_key").alias("n")).first()["n"]

    def save_keys(self, last_keys: dict[str, int], kind: str = "keys") -> None:
        rows = self.spark.createDataFrame(list(last_keys.items()), "table string, last_key long")
        rows.coalesce(1).write.mode("append").parquet(f"{self.root}/{kind}")

    def settle(self, dims: tuple[str, ...]) -> None:
        """The codes known by now are used wherever they occur."""
        self.save_keys({name: self.last_key(name) for name in dims}, "settled")


def _line_columns(entity: str) -> list[str]:
    date_column, amount = ENTITY_MEASURES[entity]
    return ["transaction_id", ENTITY_KEYS[entity][1], amount, date_column]


class Refresh:
    """One refresh of the lake under `lake`; `scratch` holds what only this refresh needs."""

    def __init__(self, spark: SparkSession, lake: str, loader: BronzeLoader, scratch: TableStore, buckets: int):
        self.spark, self.lake, self.loader, self.scratch = spark, lake, loader, scratch
        self.progress = Progress(spark, f"{lake}/_refresh")
        root = f"{lake}/buckets"
        self.silver = {entity: BucketedTable(spark, root, entity, key, buckets) for entity, (_, key) in ENTITY_KEYS.items()}
        self.lines = {entity: BucketedTable(spark, root, f"{entity}_lines", "transaction_id", buckets) for entity in _DETAILS}
        self.result = RefreshResult(loader.run_id, {})

    def _staged(self, df: DataFrame, name: str) -> DataFrame:
        return self.scratch.save(df, name).df

    def _gold(self, name: str) -> str:
        return f"{self.lake}/gold/{name}"

    # Loads ----------------------------------------------------------------

    def pending(self) -> dict[str, DataFrame]:
        """Rows of runs not merged yet; folders of days before the last merged one are not read."""
        merged = self.progress.merged()
        if merged is None:
            return {entity: self.loader.bronze(entity) for entity in ENTITY_KEYS}
        floor = merged.agg(F.max("day").alias("day")).first()["day"]
        done = [row["run"] for row in merged.where(F.col("day") == F.lit(floor)).select("run").distinct().collect()]
        new = (F.col(PARTITION).cast("date") >= F.lit(floor)) & ~F.col("pipeline_run_id").isin(*done)
        return {entity: self.loader.bronze(entity).where(new) for entity in ENTITY_KEYS}

    def _runs(self, rows: dict[str, DataFrame]) -> DataFrame:
        found = [
            df.select(F.col("pipeline_run_id").alias("run"), F.col(PARTITION).cast("date").alias("day")) for df in rows.values()
        ]
        return reduce(DataFrame.union, found).distinct()

    # The first time -------------------------------------------------------

    def rebuild(self, bronze: dict[str, DataFrame]) -> None:
        """All layers from the whole raw layer, and the buckets that later refreshes start from."""
        warehouse = Warehouse(self.spark, bronze, TableStore(self.spark, self.lake), self.scratch)
        for kind in ("keys", "settled"):
            remove_folder(self.spark, f"{self.progress.root}/{kind}")
        self.progress.save_keys(star_layer(warehouse, f"{self.lake}/gold"))
        for entity, table in self.silver.items():
            table.replace(warehouse.silver[entity])
        for entity, table in self.lines.items():
            lines = warehouse.silver[entity].select(*_line_columns(entity))
            table.replace(lines.where(F.col("transaction_id").isNotNull()))
        self.result.rebuilt = True

    # Changes --------------------------------------------------------------

    def change(self, entity: str, loaded: DataFrame) -> Change:
        key, table = ENTITY_KEYS[entity][1], self.silver[entity]
        typed = standardize(loaded, entity)
        self.scratch.save(without_key(typed, entity), f"rejected/{entity}")
        new = table.conformed(typed.where(F.col(key).isNotNull()))
        buckets = table.touched(new)
        both = union_by_name(
            [table.read(buckets).withColumn(_NEW, F.lit(False)), deduplicate(new, entity).withColumn(_NEW, F.lit(True))]
        )
        # One shuffle by key tells everything: a key has at most its stored row and its best new one.
        # It comes first, so that the texts that are compared do not travel.
        both, plain = both.repartition(F.col(key)), both.drop(_NEW)
        best_first = Window.partitionBy(key).orderBy(*survivor_order(plain, entity), F.asc(_NEW))
        all_rows = best_first.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        content = F.to_json(F.struct(*(name for name in plain.columns if name not in _LOAD_COLUMNS)))
        compared = both.withColumns(
            {
                "__first": F.row_number().over(best_first) == 1,
                "__loaded": F.max(_NEW).over(all_rows),
                "__now": F.first(content).over(all_rows),
                "__was": F.max(F.when(~F.col(_NEW), content)).over(all_rows),
            }
        )
        differs = F.col("__loaded") & ~F.col("__now").eqNullSafe(F.col("__was"))
        state = F.when(F.col("__first"), F.when(differs, "now").otherwise("same")).when(differs & ~F.col(_NEW), "was")
        told = compared.withColumn(_STATE, state).where(F.col(_STATE).isNotNull()).select(*plain.columns, _STATE)
        rows = self.scratch.save(told, f"change/{entity}", [_STATE]).df
        was, now = (rows.where(F.col(_STATE) == name).drop(_STATE) for name in ("was", "now"))
        return Change(buckets, rows.where(F.col(_STATE) != "was").drop(_STATE), now.select(key), was, now)

    def _transactions(self, changes: dict[str, Change]) -> DataFrame:
        """Ids of the transactions that are changed or that a changed row belongs to, or belonged to."""
        parts = [changes["transactions"].changed]
        for entity in _DETAILS:
            parts += [rows.select("transaction_id") for rows in (changes[entity].was, changes[entity].now)]
        ids = reduce(DataFrame.union, parts).where(F.col("transaction_id").isNotNull())
        return self._staged(ids.distinct(), "touched")

    # Dimensions -----------------------------------------------------------

    def _add_codes(self, changes: dict[str, Change]) -> dict[str, DataFrame]:
        """Append codes not met before; returns, where there are any, the rows that no finished refresh has used yet.

        Those may be more than the rows added now: a refresh may have failed after it added some.
        """
        unused = {}
        for name in CODED:
            path, change = self._gold(name), changes[dimensions.entity_of(name)]
            last = self.progress.last_key(name)
            rows = dimensions.added_codes(name, change.now, self.spark.read.parquet(path), last, self.scratch)
            if rows.rows:
                self.progress.save_keys({name: last + rows.rows})
                rows.df.write.mode("append").parquet(path)
                self.result.added_rows[name] = rows.rows
            settled = self.progress.last_key(name, "settled")
            if last + rows.rows > settled:
                unused[name] = self.spark.read.parquet(path).where(F.col(rows.df.columns[0]) > settled)
        return unused

    def _extend_calendar(self, changes: dict[str, Change]) -> None:
        path = self._gold("dim_date")
        known = self.spark.read.parquet(path).select(F.col("full_date").alias("day"))
        dated = [change.now.select(F.col(ENTITY_MEASURES[entity][0]).alias("day")) for entity, change in changes.items()]

        def bounds(df: DataFrame):
            return df.agg(F.unix_date(F.min("day")).alias("low"), F.unix_date(F.max("day")).alias("high")).first()

        old, new = bounds(known), bounds(reduce(DataFrame.union, dated))
        if new["low"] is None:
            return
        low = min(new["low"], new["low"] if old["low"] is None else old["low"])
        high = max(new["high"], new["high"] if old["high"] is None else old["high"])
        if (low, high) != (old["low"], old["high"]):
            dimensions.calendar(self.spark, low, high).write.mode("overwrite").parquet(path)

    def _dims(self) -> dict[str, Stored]:
        return {
            name: Stored(self.spark.read.parquet(self._gold(name)), self.progress.last_key(name), self._gold(name)) for name in CODED
        }

    # Facts ----------------------------------------------------------------

    def _matched(self, changes: dict[str, Change], ids: DataFrame) -> tuple[DataFrame, DataFrame]:
        """The touched transactions as they were, and with their totals as they are."""
        buckets = self.silver["transactions"].touched(ids)
        was = self._staged(self.silver["transactions"].read(buckets).join(ids, "transaction_id", "left_semi"), "was_matched")
        change = changes["transactions"]
        now = union_by_name([was.join(change.changed, "transaction_id", "left_anti"), change.now])
        lines = []
        for entity in _DETAILS:
            key, change = ENTITY_KEYS[entity][1], changes[entity]
            stored = self.lines[entity].read(buckets).join(change.changed, key, "left_anti")
            fresh = change.now.where(F.col("transaction_id").isNotNull()).select(*_line_columns(entity))
            # Last, so that the totals are added up where this shuffle has put the lines.
            lines.append(stored.unionByName(fresh).join(ids, "transaction_id", "left_semi"))
        return was, self._staged(match(now.select(*facts.TRANSACTION_COLUMNS), *lines), "matched")

    def _details(self, entity: str, change: Change, added: dict[str, DataFrame]) -> tuple[DataFrame, DataFrame]:
        """Refunds (or chargebacks) as they were and as they are: the changed ones, and those whose code got a key just now."""
        key, parts = ENTITY_KEYS[entity][1], []
        for dimension, code, column in (("dim_merchant", "merchant_id", "merchant_id"), ("dim_currency", "currency_code", "currency")):
            stored = self.silver[entity].read()
            if dimension in added and column in stored.columns:
                codes = added[dimension].select(F.col(code).alias(column))
                parts.append(stored.join(codes, column, "left_semi").join(change.changed, key, "left_anti"))
        if not parts:
            return change.was, change.now
        resolved = self._staged(union_by_name(parts).dropDuplicates([key]), f"resolved/{entity}")
        return union_by_name([change.was, resolved]), union_by_name([change.now, resolved])

    def _write_fact(self, name: str, was: DataFrame, now: DataFrame, rows: DataFrame) -> None:
        """Replace the rows of the ids in `was` and `now` by `rows`, in the months these are dated in."""
        natural, key = facts.FACT_KEYS[name]
        day, path = ENTITY_MEASURES[FACT_ENTITIES[name]][0], self._gold(name)
        dated = was.select(natural, day).union(now.select(natural, day)).select(natural, month_of(date_key(day)).alias(MONTH))
        months = [row[MONTH] for row in dated.select(MONTH).distinct().collect()]
        self.result.months[name] = sorted(months, key=lambda month: month or 0)
        if not months:
            return
        ids = self._staged(dated.select(natural).distinct(), f"ids/{name}")
        old = self.spark.read.parquet(path).where(among(MONTH, months)).drop(MONTH)
        given = self._staged(old.join(ids, natural, "left_semi").select(natural, key), f"given/{name}")
        unplaced = now.select(natural).join(given, natural, "left_anti")
        last = self.progress.last_key(name)
        numbered = with_dense_key(unplaced, natural, key, self.scratch, f"numbers/{name}")
        if numbered.rows:
            self.progress.save_keys({name: last + numbered.rows})  # before they are used: a key is never given twice
        self.result.added_rows[name] = numbered.rows
        keys = given.union(numbered.df.select(natural, (F.col(key) + F.lit(last)).alias(key)))
        fresh = rows.join(keys, natural).select(*old.columns)
        content = self._staged(old.join(ids, natural, "left_anti").unionByName(fresh), f"content/{name}")
        left = {row[MONTH] for row in content.select(month_of(CLUSTERING[name][0]).alias(MONTH)).distinct().collect()}
        write_fact(content, name, path, only_months_present=True)
        for month in set(months) - left:
            remove_folder(self.spark, f"{path}/{MONTH}={'__HIVE_DEFAULT_PARTITION__' if month is None else month}")

    # Cleaned tables -------------------------------------------------------

    def _merge(self, entity: str, change: Change) -> None:
        """Put the surviving rows into their buckets."""
        if change.buckets:
            self.silver[entity].replace(change.merged, change.buckets)

    def _merge_lines(self, entity: str, change: Change) -> None:
        key, table, columns = ENTITY_KEYS[entity][1], self.lines[entity], _line_columns(entity)
        fresh = change.now.where(F.col("transaction_id").isNotNull()).select(*columns)
        moved = change.was.where(F.col("transaction_id").isNotNull()).select("transaction_id").union(fresh.select("transaction_id"))
        buckets = table.touched(moved)
        if buckets:
            others = table.read(buckets).join(change.changed, key, "left_anti")
            table.replace(self._staged(others.unionByName(fresh), f"merged_lines/{entity}"), buckets)

    def update(self, loaded: dict[str, DataFrame]) -> None:
        """Merge new loads and refresh what they touch."""
        changes: dict[str, Change] = {}

        def compare(entity: str) -> None:
            changes[entity] = self.change(entity, loaded[entity])

        together(self.spark, (lambda entity=entity: compare(entity) for entity in loaded))
        changes = {entity: changes[entity] for entity in loaded}
        if any(not change.changed.isEmpty() for change in changes.values()):
            added = self._add_codes(changes)
            self._extend_calendar(changes)
            dims = self._dims()
            was, now = self._matched(changes, self._transactions(changes))
            self._write_fact("fact_transaction", was, now, facts.fact_transaction(now, dims))
            for entity, name, build in zip(_DETAILS, FACTS[1:], (facts.fact_refund, facts.fact_chargeback), strict=True):
                was, now = self._details(entity, changes[entity], added)
                self._write_fact(name, was, now, build(ensure_column(now, "currency", "string"), dims))
        together(self.spark, (lambda entity=entity: self._merge_lines(entity, changes[entity]) for entity in _DETAILS))
        together(self.spark, (lambda entity=entity: self._merge(entity, changes[entity]) for entity in changes))
        for entity in changes:
            rejected = self.scratch.read(f"rejected/{entity}")
            rejected.write.mode("append").parquet(f"{self.lake}/silver/rejected_{entity}")


def refresh(spark: SparkSession, source: Source, lake: str, source_system: str, buckets: int = 64, **loading) -> RefreshResult:
    """Load what is new and bring the star schema under `lake` up to date; the first time everything is built.

    `buckets` is how finely cleaned tables are cut, some hundred megabytes a bucket being
    enough; it must stay the same for a lake. `loading` is passed to the loader.
    """
    loader = BronzeLoader(spark, f"{lake}/bronze", source, source_system, **loading)
    loaded = loader.load_all(f"{lake}/reports")
    scratch = TableStore(spark)
    try:
        work = Refresh(spark, lake, loader, scratch, buckets)
        work.result.loaded = loaded
        pending = work.pending()
        runs = scratch.save(work._runs(pending), "runs")
        if work.progress.merged() is None:
            work.rebuild(pending)
        elif runs.rows:
            work.update(pending)
        if runs.rows:
            work.progress.settle(CODED)
            work.progress.save_merged(runs.df)
        return work.result
    finally:
        scratch.drop()
