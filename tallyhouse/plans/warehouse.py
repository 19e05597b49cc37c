"""The cleaned (silver) and star-schema (gold) tables over a set of raw entities.

Each table is built on first use, written once, and read back by everything above
it, so nothing expensive is computed twice and a report touches only the layers it
needs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from threading import Lock

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from tallyhouse.fixed_values import ENTITY_KEYS, GOLD_TABLES
from tallyhouse.operators.dedup import cleaned, without_key
from tallyhouse.operators.dense_key import PLACE, numbered, placed
from tallyhouse.operators.lookup import BROADCAST_ROWS
from tallyhouse.operators.quality import quality_report
from tallyhouse.operators.reconcile import match, reconciliation_base
from tallyhouse.operators.standardize import standardize
from tallyhouse.plans import dimensions, facts
from tallyhouse.sources.storage import Stored, TableStore

DIMENSIONS = tuple(name for name in GOLD_TABLES if name.startswith("dim_"))
FACTS = tuple(name for name in GOLD_TABLES if name.startswith("fact_"))


def together(spark: SparkSession, steps: Iterable[Callable[[], object]]) -> None:
    """Run independent steps side by side, so that the tail of one job leaves no executor idle."""
    steps = list(steps)
    if len(steps) < 2:
        for step in steps:
            step()
        return
    with ThreadPoolExecutor(len(steps)) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]
        for result in running:
            result.result()


class _Tables(dict):
    """Looks tables up by name and builds a missing one, once even if two threads ask for it."""

    def __init__(self, build):
        self._build = build
        self._guard = Lock()
        self._building: dict[str, Lock] = {}

    def __missing__(self, name):
        with self._guard:
            lock = self._building.setdefault(name, Lock())
        with lock:
            if name not in self:
                self[name] = self._build(name)
            return self[name]


class Warehouse:
    """Layers over `bronze` (entity name -> raw DataFrame), stored under `store`.

    `scratch` holds tables that only cut lineage; it defaults to `store`. Dimensions
    of more than `broadcast_rows` rows are joined by shuffle.
    """

    def __init__(
        self,
        spark: SparkSession,
        bronze: dict[str, DataFrame],
        store: TableStore | None = None,
        scratch: TableStore | None = None,
        broadcast_rows: int = BROADCAST_ROWS,
    ):
        self.spark = spark
        self.bronze = bronze
        self.store = store or TableStore(spark)
        self.scratch = scratch or self.store
        self.broadcast_rows = broadcast_rows
        self.stored_silver: dict[str, Stored] = _Tables(self._build_silver)
        self.silver: dict[str, DataFrame] = _Tables(lambda name: self.stored_silver[name].df)
        self._matched: dict[str, Stored] = _Tables(self._build_match)
        self.dims: dict[str, Stored] = _Tables(self._build_dimension)
        self.stored_facts: dict[str, Stored] = _Tables(self._build_fact)
        self.rejected_rows: dict[str, int] = _Tables(self._keep_rejects)

    # Silver ---------------------------------------------------------------

    def _build_silver(self, entity: str) -> Stored:
        if entity not in ENTITY_KEYS:
            raise KeyError(entity)
        return self.store.save(cleaned(self.bronze[entity], entity), f"silver/{entity}")

    def rejects(self, entity: str) -> DataFrame:
        """Rows that cannot be matched because their primary key is null."""
        return without_key(standardize(self.bronze[entity], entity), entity)

    def _keep_rejects(self, entity: str) -> int:
        return self.store.save(self.rejects(entity), f"silver/rejected_{entity}").rows

    def build_silver(self) -> None:
        """All entities, side by side."""
        together(self.spark, (lambda name=name: self.stored_silver[name] for name in ENTITY_KEYS))

    def _build_match(self, name: str) -> Stored:
        self.build_silver()
        transactions = self.silver["transactions"].select(*facts.TRANSACTION_COLUMNS)
        large = [entity for entity, stored in self.stored_silver.items() if stored.rows > self.broadcast_rows]
        matched = match(transactions, self.silver["refunds"], self.silver["chargebacks"], large)
        return self.store.save(matched, f"silver/{name}")

    @property
    def stored_match(self) -> Stored:
        return self._matched["matched"]

    @property
    def reconciliation_base(self) -> DataFrame:
        return reconciliation_base(self.stored_match.df)

    def quality_report(self) -> DataFrame:
        """The checks; the base is counted as matched from stored tables."""
        base = self.reconciliation_base
        return quality_report(*(self.silver[entity] for entity in ENTITY_KEYS), base)

    # Gold -----------------------------------------------------------------

    def _build_dimension(self, name: str) -> Stored:
        if name == "dim_date":
            return self.scratch.save(dimensions.dim_date(self.silver), "keys/dim_date")
        return dimensions.coded_dimension(name, self.silver, self.scratch)

    def _fact_source(self, name: str) -> DataFrame:
        """The stored rows a fact has one row for each of."""
        entity = {"fact_refund": "refunds", "fact_chargeback": "chargebacks"}.get(name)
        return self.stored_match.df if entity is None else self.silver[entity]

    def fact_rows(self, name: str) -> DataFrame:
        """Rows of a fact, each with its place in the order of its id.

        Places come first, on a plain scan, when all lookups are broadcasts. A lookup
        by shuffle would have to run the ranging again to find its hot keys, so then
        they come last.
        """
        self._build_needs(name)
        source, order = self._fact_source(name), facts.FACT_KEYS[name][0]
        shuffled = any(self.dims[dim].rows > self.broadcast_rows for dim in facts.FACT_DIMENSIONS[name])
        build = {
            "fact_transaction": facts.fact_transaction,
            "fact_refund": facts.fact_refund,
            "fact_chargeback": facts.fact_chargeback,
        }[name]
        if shuffled:
            return placed(build(source, self.dims, broadcast_rows=self.broadcast_rows), order)
        return build(placed(source, order), self.dims, keep=(PLACE,))

    def _build_fact(self, name: str) -> Stored:
        return numbered(self.fact_rows(name), facts.FACT_KEYS[name][1], self.scratch, f"keys/{name}")

    def _build_needs(self, name: str) -> None:
        """What a fact is made of, in two rounds: cleaned entities, then dimensions and the match."""
        entities = {"fact_refund": ("transactions", "refunds"), "fact_chargeback": ("transactions", "chargebacks")}
        needed = entities.get(name, ENTITY_KEYS)
        together(self.spark, (lambda entity=entity: self.stored_silver[entity] for entity in needed))
        steps = [lambda dimension=dimension: self.dims[dimension] for dimension in facts.FACT_DIMENSIONS[name]]
        if name == "fact_transaction":
            steps.append(lambda: self.stored_match)
        together(self.spark, steps)

    def build_gold(self) -> None:
        """All dimensions and facts; tables that do not depend on each other side by side."""
        self.build_silver()
        steps = [lambda name=name: self.dims[name] for name in DIMENSIONS]
        together(self.spark, [*steps, lambda: self.stored_match])
        together(self.spark, (lambda name=name: self.stored_facts[name] for name in FACTS))

    def gold(self, name: str) -> DataFrame:
        """A published table by name."""
        return self.dims[name].df if name in DIMENSIONS else self.stored_facts[name].df

    def gold_tables(self) -> dict[str, DataFrame]:
        self.build_gold()
        return {name: self.gold(name) for name in GOLD_TABLES}

    def gold_rows(self) -> dict[str, int]:
        """Row counts, known from writing the tables."""
        self.build_gold()
        return {name: (self.dims if name in DIMENSIONS else self.stored_facts)[name].rows for name in GOLD_TABLES}
