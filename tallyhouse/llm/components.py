"""Connected components of a graph given as edges, by alternating large and small stars.

Each round points every node's neighbours at the smallest node seen, once over larger
and once over smaller neighbours, until every node points straight at the smallest one
of its component. Rounds grow with the logarithm of the longest chain. Nothing is
collected; each round is a table in the shared folder. A node with very many neighbours
is met by an aggregate, which combines in the map tasks, and by a plain sort-merge join,
which adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm._shared import staged


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    return row["n"], row["x"]


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("v", "u"))
    smallest = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.join(smallest, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    smallest = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(smallest, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(smallest).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node on an edge (a, b); the component is its smallest node."""
    now = staged(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges"
    )
    state = _state(now)
    while True:
        now = staged(_small_star(_large_star(now)), "edges")
        before, state = state, _state(now)
        if state == before:
            break
    roots = now.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
