"""Jaccard join of n-gram sets over prefix trees.

1. Every text becomes its set of hashed word n-grams. Equal sets are one class.
2. Candidates: two similar sets differ in at most d elements. With the elements dealt to
   d + 1 + spare parts by their hash, similar sets agree on more than `spare` parts, so
   each set is filed under a hash of each of its parts. Weak parts (empty ones, and with
   few parts those of one element) say little, as do those on which more than `HOT` sets
   agree (a passage that many documents share): a set with no more than `spare` of both
   together is sure to meet its like elsewhere and is taken out of them; only sets with
   more stay there, such as large groups of copies. In the other parts the agreements of
   each pair are counted, and a pair is a candidate only with as many as two similar sets
   must have after their weak and hot parts are taken off: sets that share a passage agree
   on a part or two, and do not chain.
   Sets are filed for their own range of sizes and for the next, so that similar sets of
   unlike sizes meet. The filing loses no pair; sets that meet nobody are done.
3. Candidates, directly or over others, are one family. In a family, sets ordered by
   how common their elements are stand in a trie. A set walks down the trie, common
   beginnings are counted once, and a branch is left when the overlap so far plus what
   can still come, by the lengths that remain on both sides, falls short of the threshold.
   A branch whose sets are all in the walker's component already is not walked again, so
   a group of copies costs about one walk each and never all pairs.
4. Links found are joined to components.

Filing and agreements travel as packed arrays, equal sets of one batch only once. A family beyond
`BLOCK` elements is cut into blocks, and every pair of blocks is one group of its own.

Defined results: without words or text, the set is empty, `n_shingles` is 0 and nothing is
linked; rows with the same `doc_id` are one node; rows without `doc_id` get a null
component; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm._shared import shuffle_width, slices, staged
from tallyhouse.llm.components import components

#: Elements, over all its sets, of a family that one task holds in a trie (some 100 MB at work).
BLOCK = 2_000_000
#: Sets that agree on a part before it is a hot one. Changes the work, never the result.
HOT = 3
#: Average elements of a part from which on those of a single element are weak, beside empty ones.
#: Changes the work, never the result.
FULL = 4.5
#: Most document numbers (16 MB) that are broadcast.
BROADCAST = 2_000_000
_U = np.uint64
_NEXT = 1 << 15  # added to a document's place in a batch where it is filed for its next level
_FILED = "bucket int, keys binary, places binary, docs binary, facts binary"
_FOUND = "bucket int, kind string, packed binary"
_TALLIED = "kind string, packed binary"
#: Columns of the numbers packed under each kind, and which of them is the document they are dealt by.
_PACKED = {"facts": (6, 0), "hot": (3, 1), "pairs": (4, 0)}


class Similarity(NamedTuple):
    """Sets link when 100 * overlap >= percent * union."""

    words: int = 4
    percent: int = 85


def mix(values: np.ndarray) -> np.ndarray:
    """Scramble unsigned 64-bit numbers (the splitmix finalizer)."""
    values = (values ^ (values >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> _U(27))) * _U(0x94D049BB133111EB)
    return values ^ (values >> _U(31))


def shingles(text: str | None, words: int, known: dict[bytes, int]) -> np.ndarray:
    """Ascending distinct hashes of the word n-grams of a text."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return np.zeros(0, _U)
    if len(known) > 300_000:
        known.clear()
    for word in set(found):
        if word not in known:
            known[word] = xxhash.xxh64_intdigest(word)
    hashes = np.fromiter(map(known.__getitem__, found), _U, len(found))
    width = min(words, len(found))
    total = np.full(len(found) - width + 1, width, _U)
    for at in range(width):
        total = total * _U(0x9E3779B97F4A7C15) + hashes[at : at + len(total)]
    return np.unique(mix(total))


def most_apart(largest: int, percent: int) -> int:
    """Elements that two linked sets of at most `largest` elements can differ in."""
    return (2 * largest * (100 - percent)) // (100 + percent)


def size_range(size: int, percent: int) -> int:
    """Ranges grow by 100 / percent, so linked sets lie in the same range or in neighbouring ones."""
    return int(math.log(size) / math.log(100 / percent) + 1e-9)


def parts_of(level: int, percent: int) -> tuple[int, int]:
    """How many parts sets are dealt to at a level, and how many of those may be weak or hot."""
    largest = int((100 / percent) ** (level + 1) + 1e-6) + 1
    apart = most_apart(largest, percent)
    spare = 2 + apart // 4
    return apart + 1 + spare, spare


def weak_below(percent: int) -> int:
    """Elements of a part before it is told from a weak one: the same for all sets, so that similar ones agree on it.

    The lower the threshold, the more parts there are to a set, and the more hold a single
    element; with too many weak parts nothing could be taken out of the hot ones.
    """
    return 2 if 2 * (100 + percent) / (5 * (100 - percent)) >= FULL else 1


def filing_keys(elements: np.ndarray, percent: int) -> tuple[list[np.ndarray], list[int]]:
    """For a set's own and its next level: hashes it is filed under, and how many more of its parts may be hot."""
    own, weak = size_range(len(elements), percent), weak_below(percent)
    keys, slack = [], []
    for level in (own, own + 1):
        parts, spare = parts_of(level, percent)
        part = (mix(elements ^ _U(level + 1)) % _U(parts)).astype(np.int64)
        sums = np.zeros(parts, _U)
        np.add.at(sums, part, mix(elements + _U(0x632BE59BD9B4E019)))
        full = np.bincount(part, minlength=parts) >= weak
        slack.append(spare - int(parts - full.sum()))
        if slack[-1] < 0:  # two sets with so many weak parts may agree on those alone
            full[:] = True
        place = np.flatnonzero(full).astype(_U)
        keys.append(mix(sums[full] ^ mix(place * _U(0xD6E8FEB86659FD93) + _U(level))))
    return keys, slack


def _file(docs: DataFrame, like: Similarity, buckets: int) -> DataFrame:
    """Packed filing keys per bucket, and the facts of each document (id, size, two digests, slack at two levels)."""

    def file(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}
        for batch in slices(batches, "text", 8 << 20, _NEXT):
            yield from one(batch, known)  # whose arrays are gone before the next slice

    def one(batch: pa.RecordBatch, known: dict[bytes, int]) -> Iterator[pa.RecordBatch]:
        facts, first, keys, places = [], {}, [], []
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
            elements = shingles(text, like.words, known)
            digest = (int(elements.sum(dtype=_U)), int(mix(elements + _U(1)).sum(dtype=_U)))
            facts.append((doc_id, len(elements), *map(_signed, digest), 0, 0))
            if not len(elements) or digest in first:
                continue
            place = first[digest] = len(facts) - 1
            found, slack = filing_keys(elements, like.percent)
            facts[-1] = (*facts[-1][:4], *slack)
            keys += found
            places += [np.full(len(k), place + next_, np.uint16) for k, next_ in zip(found, (0, _NEXT))]
        facts_ = np.array(facts, "<i8")
        yield _filed([-1 - int(facts_[0, 0]) % buckets], [b""], [b""], [b""], [facts_.tobytes()])
        if not keys:
            return
        keys_, places_ = np.concatenate(keys), np.concatenate(places)
        bucket = (keys_ >> _U(40)) % _U(buckets)
        order = np.argsort(bucket, kind="stable")
        keys_, places_ = keys_[order], places_[order]
        cuts = np.searchsorted(bucket[order], np.arange(buckets + 1, dtype=_U))
        some = np.flatnonzero(np.diff(cuts))
        rows = []
        for b in some:
            here = slice(cuts[b], cuts[b + 1])
            used, local = np.unique(places_[here] % _NEXT, return_inverse=True)
            local += places_[here] // _NEXT * _NEXT
            rows.append((int(b), keys_[here].tobytes(), local.astype("<u2").tobytes(), facts_[used, 0].tobytes(), b""))
        yield _filed(*zip(*rows))

    def _filed(*columns: Iterable) -> pa.RecordBatch:
        kinds = [pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary()]
        return pa.RecordBatch.from_arrays(
            [pa.array(list(values), kind) for values, kind in zip(columns, kinds)],
            ["bucket", "keys", "places", "docs", "facts"],
        )

    def _signed(value: int) -> int:
        return value - (1 << 64) if value >= 1 << 63 else value

    return docs.mapInArrow(file, _FILED)


class Union:
    """Union-find over 0 .. n-1."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, a: int) -> int:
        up = self.up
        while up[a] != a:
            up[a] = up[up[a]]
            a = up[a]
        return a

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        self.up[max(a, b)] = min(a, b)
        return True


def summed(pairs: np.ndarray) -> np.ndarray:
    """Rows (a, b, c, n) with the sum of n for each (a, b, c)."""
    pairs = pairs[np.lexsort(pairs[:, :3].T)]
    begin = np.flatnonzero(np.concatenate([[True], (pairs[1:, :3] != pairs[:-1, :3]).any(axis=1)]))
    return np.column_stack([pairs[begin, :3], np.add.reduceat(pairs[:, 3], begin)])


def _meet(filed: DataFrame, buckets: int) -> DataFrame:
    """Per bucket of keys, packed: pairs that met and how often; who is in hot parts; facts, passed on.

    A pair is (a, b, c, n): two documents, the smaller first, their levels (2 if `a` is filed for
    its next one, plus 1 if `b` is), and the parts on which they agree. All numbers are dealt by
    their document, a pair by its smaller one.
    """
    shares = buckets // 4

    def meet(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, parts, pairs = None, [], []
        for batch in batches:
            for row in batch.to_pylist():
                if row["facts"]:
                    yield from _dealt("facts", np.frombuffer(row["facts"], "<i8").reshape(-1, 6))
                    continue
                if row["bucket"] != bucket:  # rows of a bucket stand together: a task holds one at a time
                    yield from _hot(parts, pairs)
                    bucket = row["bucket"]
                place = np.frombuffer(row["places"], "<u2")
                parts.append((np.frombuffer(row["keys"], "<u8"), np.frombuffer(row["docs"], "<i8")[place % _NEXT], place >= _NEXT))
        yield from _hot(parts, pairs)
        if pairs:
            yield from _dealt("pairs", summed(np.concatenate(pairs)))

    def _hot(parts: list[tuple], pairs: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        """Who is in hot parts of one bucket, whose list is emptied; pairs that met there are added to `pairs`."""
        if not parts:
            return
        key, node, next_ = (np.concatenate(x) for x in zip(*parts))
        parts.clear()
        order = np.lexsort((node, key))
        key, node, next_ = key[order], node[order], next_[order].astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        hot = np.repeat(np.diff(np.concatenate([first, [len(key)]])) > HOT, np.diff(np.concatenate([first, [len(key)]])))
        if hot.any():
            yield from _dealt("hot", np.stack([key[hot].view(np.int64), node[hot], next_[hot]], axis=1))
        for step in range(1, HOT):  # a part that is not hot holds at most HOT sets
            left = np.flatnonzero((key[step:] == key[:-step]) & ~hot[step:] & (node[step:] != node[:-step]))
            if len(left):
                pairs.append(np.stack([node[left], node[left + step], 2 * next_[left] + next_[left + step], np.ones(len(left), np.int64)], axis=1))

    def _dealt(kind: str, numbers: np.ndarray) -> Iterator[pa.RecordBatch]:
        share = (mix(numbers[:, _PACKED[kind][1]].astype("<i8").view(_U)) % _U(shares)).astype(np.int64)
        order = np.argsort(share, kind="stable")
        numbers = numbers[order].astype("<i8")
        cuts = np.searchsorted(share[order], np.arange(shares + 1))
        some = np.flatnonzero(np.diff(cuts))
        data = [numbers[cuts[b] : cuts[b + 1]].tobytes() for b in some]
        yield pa.RecordBatch.from_arrays(
            [pa.array(some, pa.int32()), pa.array([kind] * len(some)), pa.array(data, pa.binary())], ["bucket", "kind", "packed"]
        )

    return filed.sortWithinPartitions("bucket").mapInArrow(meet, _FOUND)


def _tally(found: DataFrame, shares: int) -> DataFrame:
    """Packed (doc_id, own_room, next_room), and pairs (a, b, c, n) that agree on enough parts by the room of `a`.

    The room is how many more hot parts a document could have at a level; below 0, too many.
    Numbers meet as they are packed: pairs that share a passage agree on a part or two, and
    are dropped before there is a row for any of them.
    """

    def tally(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds: dict[str, list[np.ndarray]] = {kind: [np.zeros((0, width), np.int64)] for kind, (width, _) in _PACKED.items()}
        for batch in batches:
            for kind, data in zip(batch.column("kind").to_pylist(), batch.column("packed").to_pylist()):
                kinds[kind].append(np.frombuffer(data, "<i8").reshape(-1, _PACKED[kind][0]))
        facts, hot, pairs = (np.concatenate(kinds[kind]) for kind in _PACKED)
        kinds.clear()
        if not len(facts):
            return
        docs, place = np.unique(facts[:, 0], return_inverse=True)
        room = np.full((len(docs), 2), np.iinfo(np.int64).max)
        np.minimum.at(room, place, facts[:, 4:])
        np.subtract.at(room, (docs.searchsorted(hot[:, 1]), hot[:, 2]), 1)
        yield _row("room", np.column_stack([docs, room]))
        if len(pairs):
            pairs = summed(pairs)
            yield _row("pairs", pairs[pairs[:, 3] > room[docs.searchsorted(pairs[:, 0]), pairs[:, 2] // 2]])

    def _row(kind: str, numbers: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([kind]), pa.array([numbers.astype("<i8").tobytes()], pa.binary())], ["kind", "packed"])

    return found.repartition(shares, "bucket").select("kind", "packed").mapInArrow(tally, _TALLIED)


def _cold_edges(pairs: DataFrame, room: DataFrame) -> DataFrame:
    """Edges (a, b) between documents that agree on as many parts as similar sets must.

    Similar sets agree on more than `spare` parts. Those of them that are weak or hot are weak
    or hot for both, so at least 1 + room are neither, with the room of either set: that of `a`
    was looked at in the tally, that of `b` is looked at here.
    """
    enough = F.col("d") > F.when(F.col("c") % 2 == 1, F.col("next_room")).otherwise(F.col("own_room"))
    return pairs.join(room.withColumnRenamed("doc_id", "b"), "b").where(enough).select("a", "b").distinct()


def _hot_edges(members: DataFrame, room: DataFrame) -> DataFrame:
    """Edges (a, b) in hot parts, between the documents with too many of them to be taken out."""
    own, following = room.where("own_room < 0"), room.where("next_room < 0")
    staying = staged(own.selectExpr("doc_id b", "0L c").union(following.selectExpr("doc_id b", "1L c")), "ngram-staying")
    kept = members.join(F.broadcast(staying) if staying.count() <= BROADCAST else staying, ["b", "c"]).select("a", "b")
    smallest = kept.groupBy("a").agg(F.min("b").alias("m"))
    return kept.join(smallest, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _unpacked(packed: DataFrame, width: int) -> DataFrame:
    """Rows of `width` numbers from packed ones."""
    names = "abcdef"[:width]

    def unpack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column("packed").to_pylist():
                numbers = np.frombuffer(data, "<i8").reshape(-1, width)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in numbers.T.copy()], list(names))

    return packed.select("packed").mapInArrow(unpack, ", ".join(f"{name} long" for name in names))


class Trie(NamedTuple):
    """A prefix tree in flat arrays, level by level: the branches of a node stand side by side.

    A node is a run of elements. `order` names the sets as they stand below the nodes;
    node i holds order[low[i]:high[i]], of which the first `ends[i]` end with its run.
    """

    elements: np.ndarray  # the runs of all nodes, one after the other
    begin: np.ndarray  # of each node's run in `elements`
    length: np.ndarray
    depth: np.ndarray  # elements from the root to the end of the run
    last: np.ndarray  # last element of the run
    least: np.ndarray  # smallest and largest set below
    most: np.ndarray
    low: np.ndarray
    high: np.ndarray
    ends: np.ndarray
    child: np.ndarray  # first branch, and how many
    children: np.ndarray
    order: np.ndarray


def build_trie(sets: list[np.ndarray]) -> Trie:
    """The trie of distinct non-empty ascending sets."""
    order = sorted(range(len(sets)), key=lambda s: sets[s].astype(">u4").tobytes())
    ranked = [sets[s] for s in order]
    sizes = np.array([len(s) for s in ranked])
    runs, rows = [], []
    level = [(0, len(order), 0, 0)]  # sets low:high agree up to `start`, and the run begins at `above`
    while level:
        following = []
        for low, high, above, start in level:
            runs.append(ranked[low][above:start])
            inner, ends = low, 0
            while inner < high and sizes[inner] == start:
                inner, ends = inner + 1, ends + 1
            branches = 0
            while inner < high:
                head, end = ranked[inner][start], inner + 1
                while end < high and ranked[end][start] == head:
                    end += 1
                one, other = ranked[inner], ranked[end - 1]  # they stand in order, so these two agree least
                most = min(len(one), len(other))
                unlike = np.flatnonzero(one[start:most] != other[start:most])
                following.append((inner, end, start, start + int(unlike[0]) if len(unlike) else most))
                inner, branches = end, branches + 1
            rows.append((len(runs[-1]), start, runs[-1][-1] if len(runs[-1]) else -1, low, high, ends, branches))
        level = following
    length, depth, last, low, high, ends, children = np.array(rows, np.int64).T
    bounds = np.stack([low, high], 1).ravel()
    padded = np.concatenate([sizes, [0]])
    return Trie(
        np.concatenate(runs).astype(np.int64),
        np.cumsum(length) - length,
        length,
        depth,
        last,
        np.minimum.reduceat(padded, bounds)[::2],
        np.maximum.reduceat(padded, bounds)[::2],
        low,
        high,
        ends,
        1 + np.cumsum(children) - children,
        children,
        np.array(order, np.int64),
    )


def _ranges(begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """All places begin .. begin + length - 1, one range after the other."""
    ends = np.cumsum(length)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(begin - (ends - length), length)


def trie_links(elements: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links that join all linked sets to components (sets distinct and not empty)."""
    names, local = np.unique(np.concatenate(elements), return_inverse=True)
    counts = np.bincount(local, minlength=len(names))
    rank = np.empty(len(names), np.int64)
    rank[np.argsort(-counts, kind="stable")] = np.arange(len(names))
    bounds = np.cumsum([0, *map(len, elements)])
    sets = [np.sort(rank[local[a:b]]) for a, b in zip(bounds[:-1], bounds[1:])]
    sizes = np.diff(bounds)
    trie = build_trie(sets)
    label = np.arange(len(sets))  # component of each set
    span = np.stack([trie.low, trie.high], 1).ravel()
    settled = np.full(len(trie.low), -1)  # component of all sets below a node, -1 for several
    settled[trie.high - trie.low == 1] = trie.order[trie.low[trie.high - trie.low == 1]]
    held = np.zeros(len(names), bool)
    links: list[tuple[int, int]] = []
    for walker in range(len(sets)):
        own, size = sets[walker], len(sets[walker])
        if settled[0] == label[walker]:
            break  # everything is one component
        held[own] = True
        nodes, overlap, joined = np.zeros(1, np.int64), np.zeros(1, np.int64), False
        while len(nodes):
            fits = (settled[nodes] != label[walker]) & (trie.most[nodes] * 100 >= size * percent) & (size * 100 >= trie.least[nodes] * percent)
            nodes, overlap = nodes[fits], overlap[fits]
            if not len(nodes):
                break
            length = trie.length[nodes]
            shared = np.concatenate([[0], np.cumsum(held[trie.elements[_ranges(trie.begin[nodes], length)]])])
            ends = np.cumsum(length)
            overlap = overlap + shared[ends] - shared[ends - length]
            could = overlap + np.minimum(size - own.searchsorted(trie.last[nodes], "right"), trie.most[nodes] - trie.depth[nodes])
            least = np.maximum(trie.least[nodes], -(-size * percent // 100))
            fits = could * (100 + percent) >= percent * (size + least)
            nodes, overlap = nodes[fits], overlap[fits]
            ends = trie.ends[nodes]
            others = trie.order[_ranges(trie.low[nodes], ends)]
            linked = np.repeat(overlap, ends) * (100 + percent) >= percent * (size + sizes[others])
            for other in others[linked].tolist():
                if label[other] != label[walker]:
                    links.append((walker, other))
                    label[label == max(label[other], label[walker])] = min(label[other], label[walker])
                    joined = True
            overlap = np.repeat(overlap, trie.children[nodes])
            nodes = _ranges(trie.child[nodes], trie.children[nodes])
        held[own] = False
        if joined:
            below = np.concatenate([label[trie.order], [0]])
            least, most = np.minimum.reduceat(below, span)[::2], np.maximum.reduceat(below, span)[::2]
            settled = np.where(least == most, least, -1)
    return links


def _family_links(families: DataFrame, docs: DataFrame, like: Similarity) -> DataFrame:
    """Edges (a, b) between linked sets. `families`: (doc_id, family, blocks), one row per class."""
    pairs = families.withColumn("own", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int")).select(
        "doc_id",
        "family",
        F.explode(
            F.transform(
                F.sequence(F.lit(0), F.col("blocks") - 1),
                lambda other: F.struct(
                    F.least("own", other.cast("int")).alias("low"), F.greatest("own", other.cast("int")).alias("high")
                ),
            )
        ).alias("pair"),
    )
    wanted = families.select("doc_id")
    # One number per set that met another: sent to all tasks while that is small, else joined by a shuffle of texts.
    wanted = F.broadcast(wanted) if wanted.count() <= BROADCAST else wanted
    texts = docs.join(wanted, "doc_id").select("doc_id", "text")

    def sets(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}
        for batch in slices(batches, "text"):
            data = [shingles(text, like.words, known).tobytes() for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(data, pa.binary())], ["doc_id", "elements"])

    elements = staged(texts.mapInArrow(sets, "doc_id long, elements binary"), "family-sets")

    def link(table: pa.Table) -> pa.Table:
        rows = table.to_pydict()
        found = [np.frombuffer(data, "<u8") for data in rows["elements"]]
        links = trie_links(found, like.percent) if len(found) > 1 else []
        ids = rows["doc_id"]
        return pa.table(
            {"a": pa.array([ids[a] for a, _ in links], pa.int64()), "b": pa.array([ids[b] for _, b in links], pa.int64())}
        )

    grouped = pairs.join(elements, "doc_id").select("family", F.col("pair.low"), F.col("pair.high"), "doc_id", "elements")
    return grouped.groupBy("family", "low", "high").applyInArrow(link, "a long, b long")


def ngram_components(docs: DataFrame, like: Similarity = Similarity()) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (the smallest doc_id it is linked to, at last itself)."""
    docs = docs.selectExpr("cast(doc_id as long) doc_id", "text")
    named = docs.where("doc_id is not null")
    buckets = 4 * shuffle_width(docs)
    filed = _file(named, like, buckets).repartition(buckets // 4, "bucket")
    found = staged(_meet(filed, buckets), "ngram-filing")

    facts = staged(_unpacked(found.where("kind = 'facts'"), 6), "ngram-facts").toDF(
        "doc_id", "n_shingles", "x", "y", "own_slack", "next_slack"
    )
    # One class per set: all its documents hang on the smallest.
    classes = staged(
        facts.where("n_shingles > 0").groupBy("n_shingles", "x", "y").agg(F.min("doc_id").alias("first")), "ngram-classes"
    )
    equal = staged(
        facts.join(classes, ["n_shingles", "x", "y"]).where("doc_id <> first").selectExpr("doc_id a", "first b"), "ngram-equal"
    )
    members = _unpacked(found.where("kind = 'hot'"), 3)
    tallied = staged(_tally(found, buckets // 4), "ngram-tally")
    room = staged(_unpacked(tallied.where("kind = 'room'"), 3), "ngram-room").toDF("doc_id", "own_room", "next_room")
    met = _cold_edges(_unpacked(tallied.where("kind = 'pairs'"), 4), room)
    family = components(met.union(equal).union(_hot_edges(members, room))).withColumnRenamed("node", "doc_id").withColumnRenamed("component", "family")
    heads = classes.groupBy(F.col("first").alias("doc_id")).agg(F.sum("n_shingles").alias("size"), F.count(F.lit(1)).alias("sets"))
    members = family.join(heads, "doc_id")
    sizes = members.groupBy("family").agg(F.sum("size").alias("size"), F.sum("sets").alias("sets")).where("sets > 1")
    families = members.select("doc_id", "family").join(sizes, "family").select(
        "doc_id", "family", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks")
    )
    links = _family_links(staged(families, "ngram-families"), named, like)
    linked = components(links.union(equal)).withColumnRenamed("node", "doc_id")
    with_component = facts.join(linked, "doc_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")
    )

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}
        for batch in slices(batches, "text"):
            sizes = [len(shingles(text, like.words, known)) for text in batch.column("text").to_pylist()]
            none = pa.nulls(len(sizes), pa.int64())
            yield pa.RecordBatch.from_arrays([none, pa.array(sizes, pa.int64()), none], ["doc_id", "n_shingles", "component_id"])

    unnamed = docs.where("doc_id is null").mapInArrow(count, "doc_id long, n_shingles long, component_id long")
    return with_component.union(unnamed)
