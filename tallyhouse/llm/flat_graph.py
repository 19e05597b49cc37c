"""Near-duplicate vectors by a robust-pruned flat graph.

1. Equal vectors are one class with a weight. Cluster centres are fitted on a bounded
   sample; every class goes into the shards of its nearest centres, so shards overlap.
2. In a shard, overlapping leaves are made the same way. In each leaf a vector's
   candidates are its nearest vectors and some random ones, pruned robustly: a candidate
   goes when a kept one is `alpha` times nearer to it than the vector is. Adjacency lists of
   a vector from all its leaves are united, and edges run both ways.
   A shard of more than `Graph.most` vectors is cut into blocks, and every pair of blocks
   is searched as a shard of its own, so no task grows with a group.
3. Every vector searches in the shard of its nearest centre: greedily, with a beam, from
   the medoids; then its range is expanded, from every vector found within the range over
   its neighbours, until nothing new is within. There is no cap on what is found.
4. What is found is verified by the cosine in double precision. Links of a shard are
   counted per vector, also for the vector found where it cannot find the other, and passed
   on as a spanning forest, never as all pairs.
5. The recall is audited: sample vectors are compared with all rows, in blocks. Below
   `Graph.recall`, everything is repeated with twice as many shards per vector; below
   `Graph.least_recall` after the last round there is no result but an error.

Defined results: vectors that are null, empty or zero, or hold null or non-finite
components, link with nothing; vectors of unlike lengths never link; rows without `vec_id`
link with nothing and have a null component; repeated rows count as vectors; other
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm._shared import staged
from tallyhouse.llm.components import components
from tallyhouse.llm.ngram_join import Union


class Graph(NamedTuple):
    cosine: float = 0.95
    #: Vectors the centres are fitted on, and the most centres.
    sample: int = 20_000
    centres: int = 5_000
    #: Vectors of one shard, with overlap, on average; and of one leaf.
    shard: int = 4_000
    leaf: int = 800
    #: Vectors of a shard from which on it is cut into blocks of half as many.
    most: int = 16_000
    #: Shards a vector goes to.
    overlap: int = 4
    nearest: int = 32
    random: int = 12
    degree: int = 24
    alpha: float = 1.2
    beam: int = 32
    #: How far below the threshold a vector still has its neighbours looked at.
    slack: float = 0.05
    #: Vectors the recall is audited on, of those with no, few and many links found each;
    #: the recall aimed at, how often to try, and the recall below which there is no result.
    audit: int = 500
    recall: float = 0.98
    tries: int = 3
    least_recall: float = 0.9


#: Links from which on a vector has many.
FEW = 8


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one, in double precision; scaled first, so that squares stay finite."""
    vectors = vectors.astype(np.float64)
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def fit_centres(units: np.ndarray, count: int, rounds: int = 8) -> np.ndarray:
    """Spherical k-means, the same for the same rows."""
    if count >= len(units):
        return units
    draw = np.random.default_rng(7)
    centres = units[draw.choice(len(units), count, replace=False)]
    for _ in range(rounds):
        own = np.concatenate([(units[a : a + 4096] @ centres.T).argmax(axis=1) for a in range(0, len(units), 4096)])
        sums = np.zeros_like(centres)
        np.add.at(sums, own, units)
        size = np.sqrt((sums * sums).sum(axis=1, keepdims=True))
        centres = np.where(size > 1e-12, sums / np.maximum(size, 1e-12), centres)
    return centres


def nearest_centres(units: np.ndarray, centres: np.ndarray, count: int) -> np.ndarray:
    """Indices of the `count` nearest centres of each row, nearest first."""
    count = min(count, len(centres))
    out = np.empty((len(units), count), np.int64)
    for at in range(0, len(units), 4096):
        near = units[at : at + 4096] @ centres.T
        some = np.argpartition(-near, count - 1, axis=1)[:, :count]
        order = np.argsort(-np.take_along_axis(near, some, 1), axis=1, kind="stable")
        out[at : at + 4096] = np.take_along_axis(some, order, 1)
    return out


def robust_prune(near: np.ndarray, candidates: np.ndarray, graph: Graph) -> np.ndarray:
    """Kept candidates of each row of a leaf, -1 where there are fewer. `near`: cosines in the leaf."""
    rows = np.arange(len(near))[:, None]
    order = np.argsort(-near[rows, candidates], axis=1, kind="stable")
    candidates = np.take_along_axis(candidates, order, 1)
    distance = 1.0 - near[rows, candidates]
    alive = candidates != rows
    kept = np.full((len(near), graph.degree), -1, np.int64)
    for turn in range(graph.degree):
        some = alive.any(axis=1)
        if not some.any():
            break
        pick = alive.argmax(axis=1)
        chosen = candidates[rows[:, 0], pick]
        kept[some, turn] = chosen[some]
        between = 1.0 - near[chosen[:, None], candidates]
        alive &= ~((graph.alpha * between <= distance) | (candidates == chosen[:, None]))
    return kept


def build_graph(units: np.ndarray, graph: Graph) -> tuple[np.ndarray, np.ndarray]:
    """Adjacency (rows of indices, padded with the row's own) and medoids."""
    n = len(units)
    draw = np.random.default_rng(11)
    centres = fit_centres(units[draw.choice(n, min(n, 4000), replace=False)], max(1, -(-2 * n // graph.leaf)), 4)
    member = nearest_centres(units, centres, 2)
    tails, heads, medoids = [], [], []
    for centre in range(len(centres)):
        leaf = np.flatnonzero((member == centre).any(axis=1))
        for low in range(0, len(leaf), 2 * graph.leaf):  # a leaf that is far too large is cut up
            part = leaf[low : low + 2 * graph.leaf]
            near = units[part] @ units[part].T
            medoids.append(part[near.sum(axis=1).argmax()])
            if len(part) < 2:
                continue
            top = min(graph.nearest + 1, len(part))
            closest = np.argpartition(-near, top - 1, axis=1)[:, :top]
            chance = draw.integers(0, len(part), (len(part), graph.random))
            kept = robust_prune(near, np.concatenate([closest, chance], axis=1), graph)
            tail, slot = np.nonzero(kept >= 0)
            tails.append(part[tail])
            heads.append(part[kept[tail, slot]])
    medoids = np.unique(medoids)
    # The medoids know each other, so that every leaf is within reach of any other.
    tails.append(np.repeat(medoids, len(medoids)))
    heads.append(np.tile(medoids, len(medoids)))
    tail, head = np.concatenate(tails), np.concatenate(heads)
    pairs = np.unique(np.concatenate([tail * n + head, head * n + tail]))
    tail, head = pairs // n, pairs % n
    begin = np.searchsorted(tail, np.arange(n + 1))
    width = int(np.diff(begin).max())
    adjacency = np.repeat(np.arange(n)[:, None], width, axis=1)
    adjacency[tail, np.arange(len(tail)) - begin[tail]] = head
    return adjacency, medoids


def beam_search(units: np.ndarray, adjacency: np.ndarray, medoids: np.ndarray, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """Greedy search for many queries at once: (ids, cosines) of the beam, best first, -1 where empty."""
    q = units[queries]
    count = len(queries)
    near = q @ units[medoids].T
    if len(medoids) > beam:
        start = np.argsort(-near, axis=1)[:, :beam]
    else:
        start = np.argsort(-near, axis=1)
    ids = np.full((count, beam), -1, np.int64)
    score = np.full((count, beam), -2.0)
    ids[:, : start.shape[1]] = medoids[start]
    score[:, : start.shape[1]] = np.take_along_axis(near, start, 1)
    done = ids < 0
    rows = np.arange(count)
    for _ in range(4 * beam):
        todo = ~done
        active = np.flatnonzero(todo.any(axis=1))
        if not len(active):
            break
        pick = todo[active].argmax(axis=1)
        done[active, pick] = True
        step = adjacency[ids[active, pick]]
        found = np.einsum("cd,crd->cr", q[active], units[step])
        known = (step[:, :, None] == ids[active][:, None, :]).any(axis=2)
        step_sorted = np.sort(step, axis=1)
        if (step_sorted[:, 1:] == step_sorted[:, :-1]).any():  # padding repeats the row itself
            known |= step == ids[active, pick][:, None]
        found[known] = -2.0
        all_ids = np.concatenate([ids[active], step], axis=1)
        all_score = np.concatenate([score[active], found], axis=1)
        all_done = np.concatenate([done[active], known], axis=1)
        best = np.argsort(-all_score, axis=1, kind="stable")[:, :beam]
        ids[active] = np.take_along_axis(all_ids, best, 1)
        score[active] = np.take_along_axis(all_score, best, 1)
        done[active] = np.take_along_axis(all_done, best, 1) | (score[active] < -1.5)
    ids[score < -1.5] = -1
    return ids, score


def in_range(units: np.ndarray, adjacency: np.ndarray, query: int, start: np.ndarray, graph: Graph, seen: np.ndarray) -> np.ndarray:
    """All vectors within the range that are reached from `start`, without the query itself."""
    q = units[query]
    touched, hits = [start], []
    seen[start] = True
    front = start
    cosines = units[front] @ q
    while len(front):
        hits.append(front[cosines >= graph.cosine])
        front = front[cosines >= graph.cosine - graph.slack]
        near = np.unique(adjacency[front])
        front = near[~seen[near]]
        seen[front] = True
        touched.append(front)
        cosines = units[front] @ q
    seen[np.concatenate(touched)] = False
    found = np.concatenate(hits)
    return found[found != query]


def shard_links(units: np.ndarray, asks: np.ndarray, graph: Graph, chunk: int = 256) -> Iterator[tuple[int, np.ndarray]]:
    """(query, vectors linked to it) for each of the rows `asks` that has any."""
    adjacency, medoids = build_graph(units, graph)
    seen = np.zeros(len(units), bool)
    for at in range(0, len(asks), chunk):
        own = asks[at : at + chunk]
        ids, score = beam_search(units, adjacency, medoids, own, graph.beam)
        for row, query in enumerate(own.tolist()):
            start = ids[row][(ids[row] >= 0) & (score[row] >= graph.cosine - graph.slack)]
            if len(start) > 1 or (len(start) and start[0] != query):
                found = in_range(units, adjacency, query, start, graph, seen)
                if len(found):
                    yield query, found


class Mutual:
    """Links among the vectors at home in a shard, one bit each, to be counted from both sides."""

    def __init__(self, home: np.ndarray):
        self.home = home
        self.place = np.cumsum(home) - 1
        self.count = int(home.sum())
        self.bits = np.zeros((self.count, -(-self.count // 8)), np.uint8)

    def add(self, query: int, found: np.ndarray) -> None:
        row = np.zeros(self.count, bool)
        row[self.place[found[self.home[found]]]] = True
        self.bits[self.place[query]] |= np.packbits(row)

    def links(self, weight: np.ndarray, step: int = 256) -> np.ndarray:
        """Weight of the vectors at home that found each vector or were found by it."""
        out = np.zeros(len(self.home), np.int64)
        asks = np.flatnonzero(self.home)
        for at in range(0, self.count, step):
            to = min(at + step, self.count)
            there = np.unpackbits(self.bits[at:to], axis=1, count=self.count)
            back = np.unpackbits(self.bits[:, at // 8 : -(-to // 8)], axis=1, count=to - at)
            out[asks[at:to]] = (there | back.T) @ weight[asks].astype(np.float64)
        return out


def _usable(embedding: Column) -> Column:
    bad = F.exists(embedding, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return embedding.isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.exists(embedding, lambda x: x != 0)


def _matrix(column: pa.Array) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(column), -1) if len(column) else values.reshape(0, 0)


def deal(near: np.ndarray, node: np.ndarray, blocks: np.ndarray) -> tuple[np.ndarray, ...]:
    """(row, shard, low, high, block) for every pair of blocks, of each shard of a row, that has the row's own block."""
    shard = near.ravel()
    rows = np.repeat(np.arange(len(near)), near.shape[1])
    dealt = node.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)
    pairs = blocks[shard]
    block = dealt[rows].astype(np.int64) % pairs
    other = np.arange(pairs.sum()) - np.repeat(np.cumsum(pairs) - pairs, pairs)
    rows, shard, block = np.repeat(rows, pairs), np.repeat(shard, pairs), np.repeat(block, pairs).astype(np.int32)
    return rows, shard, np.minimum(block, other).astype(np.int32), np.maximum(block, other).astype(np.int32), block


def _search(classes: DataFrame, size: int, total: int, overlap: int, graph: Graph) -> DataFrame:
    """(kind, a, b): per class `links` found for it, and `edge`s of a spanning forest. All of one length."""
    spark = classes.sparkSession
    count = max(1, min(graph.centres, -(-total * overlap // graph.shard)))
    count = 1 if total <= graph.shard else count
    drawn = classes.orderBy(F.xxhash64("node")).limit(graph.sample).select("embedding").toArrow()
    sample = unit(_matrix(drawn.column("embedding").combine_chunks()))
    centres = spark.sparkContext.broadcast(fit_centres(sample, count))

    def count_members(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        members = np.zeros(len(centres.value), np.int64)
        for batch in batches:
            if batch.num_rows:
                near = nearest_centres(unit(_matrix(batch.column("embedding"))), centres.value, overlap)
                members += np.bincount(near.ravel(), minlength=len(members))
        filled = np.flatnonzero(members)
        yield pa.RecordBatch.from_arrays([pa.array(filled.astype(np.int32)), pa.array(members[filled])], ["shard", "n"])

    counted = classes.select("embedding").mapInArrow(count_members, "shard int, n long").groupBy("shard").agg(F.sum("n").alias("n"))
    blocks = np.ones(len(centres.value), np.int64)
    for row in counted.collect():  # one row per centre
        if row["n"] > graph.most:
            blocks[row["shard"]] = -(-2 * row["n"] // graph.most)

    def assign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            near = nearest_centres(unit(_matrix(batch.column("embedding"))), centres.value, overlap).astype(np.int32)
            rows, shard, low, high, block = deal(near, batch.column("node").to_numpy(), blocks)
            for at in range(0, len(rows), 10_000):
                here = rows[at : at + 10_000]
                ends = np.arange(0, near.shape[1] * len(here) + 1, near.shape[1], dtype=np.int32)
                visits = pa.ListArray.from_arrays(ends, near[here].ravel())
                names = [pa.array(x[at : at + 10_000]) for x in (shard, low, high, block)]
                yield pa.RecordBatch.from_arrays(
                    [*names, visits, *batch.take(pa.array(here)).columns], ["shard", "low", "high", "block", "visits", *batch.schema.names]
                )

    kind = classes.schema["embedding"].dataType.simpleString()
    shards = classes.select("node", "weight", "embedding").mapInArrow(
        assign, f"shard int, low int, high int, block int, visits array<int>, node long, weight long, embedding {kind}"
    )

    def link(table: pa.Table) -> pa.Table:
        units = unit(_matrix(table.column("embedding").combine_chunks()))
        node, weight = table.column("node").to_numpy(), table.column("weight").to_numpy()
        block = table.column("block").to_numpy()
        visits = table.column("visits").combine_chunks().flatten().to_numpy().reshape(len(units), -1)
        home = visits[:, 0] == table.column("shard")[0].as_py()
        crossed = table.column("low")[0].as_py() != table.column("high")[0].as_py()
        asks = np.flatnonzero(home)
        union = Union(len(units))
        links = np.zeros(len(units), np.int64)
        mutual = Mutual(home)
        edges: list[tuple[int, int]] = []
        if len(units) > 1 and len(asks):
            for query, found in shard_links(units, asks, graph):
                if crossed:  # those of one block meet in a task of their own
                    found = found[block[found] != block[query]]
                mutual.add(query, found)
                guests = found[~home[found]]
                links[query] += weight[guests].sum()
                # A guest in whose home shard the query is not cannot find it there.
                unseen = guests[~(visits[guests, :1] == visits[query]).any(axis=1)]
                links[unseen] += weight[query]
                for other in found.tolist():
                    if union.join(query, other):
                        edges.append((query, other))
            links += mutual.links(weight)
        linked = np.flatnonzero(links)
        tail, head = np.array(edges, np.int64).reshape(-1, 2).T
        kinds = ["links"] * len(linked) + ["edge"] * len(edges)
        a, b = np.concatenate([node[linked], node[tail]]), np.concatenate([links[linked], node[head]])
        return pa.table({"kind": pa.array(kinds, pa.string()), "a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return shards.groupBy("shard", "low", "high").applyInArrow(link, "kind string, a long, b long")


def audit_recall(classes: DataFrame, found: DataFrame, graph: Graph) -> float:
    """Mean share of a linked vector's links that were found; of vectors with few and with many links, the lower.

    Vectors are drawn by how many links were found for them (none, few, many) and count for
    all vectors drawn from, so that neither a large group nor unlinked vectors hide a miss.
    """
    have = found.where("kind = 'links'").groupBy("a").agg(F.sum("b").alias("have"))
    stratum = F.when(F.col("have").isNull(), 0).when(F.col("have") < FEW, 1).otherwise(2)
    ranked = classes.join(have, classes["node"] == have["a"], "left").select("node", "embedding", "have", stratum.alias("stratum"))
    sizes = {row["stratum"]: row["n"] for row in ranked.groupBy("stratum").agg(F.count(F.lit(1)).alias("n")).collect()}
    names, reached, stands_for, queries = [], [], [], []
    for one, size in sorted(sizes.items()):
        drawn = ranked.where(F.col("stratum") == one).orderBy(F.col("node") % 100 != 0, F.xxhash64("node")).limit(graph.audit).toArrow()
        names += drawn.column("node").to_pylist()
        reached += [n or 0 for n in drawn.column("have").to_pylist()]
        stands_for += [size / drawn.num_rows] * drawn.num_rows
        queries.append(unit(_matrix(drawn.column("embedding").combine_chunks())))
    spark = classes.sparkSession
    shared = spark.sparkContext.broadcast((np.array(names, np.int64), np.concatenate(queries)))

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, queries = shared.value
        total = np.zeros(len(names), np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                near = queries @ unit(_matrix(part.column("embedding"))).T >= graph.cosine
                near &= names[:, None] != part.column("node").to_numpy()[None, :]
                total += (near * part.column("weight").to_numpy()[None, :]).sum(axis=1)
        yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(total)], ["a", "n"])

    there = classes.select("node", "weight", "embedding").mapInArrow(compare, "a long, n long").groupBy("a").agg(F.sum("n").alias("n"))
    true = {row["a"]: row["n"] for row in there.collect()}  # as many rows as were drawn
    audited = [(true[name], min(1.0, n / true[name]), weight) for name, n, weight in zip(names, reached, stands_for) if true[name]]
    means = []
    for many in (False, True):
        of = [(share, weight) for n, share, weight in audited if (n >= FEW) == many]
        if of:
            means.append(sum(share * weight for share, weight in of) / sum(weight for _, weight in of))
    return min(means, default=1.0)


def near_duplicates(vectors: DataFrame, graph: Graph = Graph()) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept, and the audited recall."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    usable = rows.where(F.col("vec_id").isNotNull() & _usable(F.col("embedding")))
    classes = staged(
        usable.groupBy("embedding").agg(F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("weight")), "vector-classes"
    )
    sizes = {row["size"]: row["n"] for row in classes.groupBy(F.size("embedding").alias("size")).agg(F.count(F.lit(1)).alias("n")).collect()}
    schema = "kind string, a long, b long"
    found, recall = None, 1.0
    for size, total in sorted(sizes.items()):
        own = classes.where(F.size("embedding") == size)
        for attempt in range(graph.tries):
            part = staged(_search(own, size, total, graph.overlap << attempt, graph), "vector-links")
            reached = audit_recall(own, part, graph)
            if reached >= graph.recall:
                break
        if reached < graph.least_recall:
            raise RuntimeError(f"recall {reached:.3f} of links after {graph.tries} rounds; {graph.least_recall} is asked for")
        found, recall = part if found is None else found.union(part), min(recall, reached)
    if found is None:
        found = vectors.sparkSession.createDataFrame([], schema)
    linked = components(found.where("kind = 'edge'").select("a", "b"))
    counts = found.where("kind = 'links'").groupBy(F.col("a").alias("node")).agg(F.sum("b").alias("links"))
    known = (
        classes.join(counts, "node", "left")
        .join(linked, "node", "left")
        .select(
            F.col("embedding").alias("same"),
            (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
            F.coalesce("component", "node").alias("component_id"),
        )
    )
    usable_row = F.col("vec_id").isNotNull() & _usable(F.col("embedding"))
    result = rows.join(known, F.when(usable_row, F.col("embedding")) == F.col("same"), "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id")
    )
    kept = F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))
    return result.select("*", kept.alias("kept"), F.lit(recall).alias("audited_recall"))
