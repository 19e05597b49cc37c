"""Packing token pieces into fixed-length sequences by best-two-fit.

A bin is filled greedily with the largest piece that fits, again and again. Then its
smallest piece is taken out if two unpacked pieces fill the larger gap better.

Only lengths matter for that, and there are at most as many as a sequence has tokens,
so the plan is made from the table (length, count): a filled bin is a pattern, used as
often as the counts allow, which gives the bins that packing piece by piece would give.
The table has at most `capacity` rows whatever the corpus, and the plan has at most
about capacity * (1 + ln capacity) patterns, since each use of a pattern takes one
length below what a bin of that pattern needs of it. Pieces then find their place by
their number among the pieces of equal length, counted per task and added up, so a
length that a third of all documents share is spread over all tasks.

Defined results: null and empty texts are one end id; repeated rows are packed each;
a null `doc_id` stays null; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import os
from collections import Counter
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.llm._shared import slices, staged
from tallyhouse.llm.word_tokens import default_path, word_encoder

CAPACITY = 4096
END_ID = 1

PIECES = "doc_id long, piece int, start long, length int, ids_crc32 long, part int, nth long"
PIECES_WITH_IDS = f"{PIECES}, ids binary"


def cut_pieces(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None, ids: bool = False) -> DataFrame:
    """One row per piece: its document, place and length, a checksum, and with `ids` the ids themselves.

    `part` and `nth` number the pieces of one length within the task that made them.
    """
    path = path or default_path()
    schema = PIECES_WITH_IDS if ids else PIECES

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zlib

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder = word_encoder(path)
        part = TaskContext.get().partitionId()
        seen: Counter[int] = Counter()
        for batch in slices(batches, "text"):
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                tokens = np.append(encoder.encode(text or ""), np.uint32(END_ID)).astype("<u4")
                for piece, start in enumerate(range(0, len(tokens), capacity)):
                    data = tokens[start : start + capacity].tobytes()
                    length = len(data) // 4
                    row = (doc_id, piece, start, length, zlib.crc32(data), part, seen[length])
                    rows.append((*row, data) if ids else row)
                    seen[length] += 1
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]
            columns = [pa.array(values, kind) for values, kind in zip(zip(*rows), kinds)]
            yield pa.RecordBatch.from_arrays(columns, [field.split()[0] for field in schema.split(", ")])

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(cut, schema)


class Pattern(NamedTuple):
    """`times` bins, each holding pieces of these lengths in this order."""

    lengths: tuple[int, ...]
    times: int


class _Counts:
    """How many pieces of each length are left, with the largest available length up to any bound."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.left = np.zeros(capacity + 1, np.int64)
        for length, count in counts.items():
            self.left[length] = count
        self.refresh()

    def refresh(self) -> None:
        at = np.arange(len(self.left))
        self.up_to = np.maximum.accumulate(np.where(self.left > 0, at, 0))

    def take(self, length: int, times: int = 1) -> None:
        self.left[length] -= times
        if self.left[length] == 0 or self.left[length] == -times:
            self.refresh()

    def give(self, length: int) -> None:
        self.left[length] += 1
        if self.left[length] == 1:
            self.refresh()


def _best_two(counts: _Counts, gap: int) -> tuple[int, int]:
    """The two available lengths with the largest sum up to `gap`; zeros if there are none."""
    first = np.flatnonzero(counts.left[: gap + 1])
    if not len(first):
        return 0, 0
    second = counts.up_to[gap - first]
    # A length of which one piece is left cannot be paired with itself: take the next smaller one.
    alone = (second == first) & (counts.left[first] < 2)
    second = np.where(alone, counts.up_to[np.maximum(first - 1, 0)], second)
    total = np.where(second > 0, first + second, 0)
    best = int(total.argmax())
    return (int(first[best]), int(second[best])) if total[best] else (0, 0)


def plan_bins(counts: dict[int, int], capacity: int = CAPACITY) -> list[Pattern]:
    """Bins for all pieces, as patterns with how often each is used."""
    left = _Counts(counts, capacity)
    plan = []
    while largest := int(left.up_to[capacity]):
        gap, bin_ = capacity - largest, [largest]
        left.take(largest)
        while gap and (length := int(left.up_to[gap])):
            bin_.append(length)
            left.take(length)
            gap -= length
        if gap and len(bin_) > 1:
            smallest = bin_[-1]
            one, two = _best_two(left, gap + smallest)
            if one + two > smallest:
                left.give(smallest)
                bin_[-1:] = sorted((one, two), reverse=True)
                left.take(one)
                left.take(two)
        used = Counter(bin_)
        more = min(int(left.left[length]) // n for length, n in used.items())
        for length, n in used.items():
            left.left[length] -= more * n
        left.refresh()
        plan.append(Pattern(tuple(bin_), more + 1))
    return plan


class Places(NamedTuple):
    """For each run of pieces of one length: where it starts, its first sequence and its place there."""

    keys: np.ndarray  # length << 44 | number of the first piece, ascending
    first: np.ndarray
    offset: np.ndarray


def places_of(plan: list[Pattern]) -> Places:
    given: Counter[int] = Counter()
    rows = []
    sequence = 0
    for pattern in plan:
        offset = 0
        for length in pattern.lengths:
            rows.append(((length << 44) | given[length], sequence, offset))
            given[length] += pattern.times
            offset += length
        sequence += pattern.times
    keys, first, offset = (np.array(values, np.int64) for values in zip(*sorted(rows))) if rows else [np.zeros(0, np.int64)] * 3
    return Places(keys, first, offset)


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """`pieces` (a stored table from `cut_pieces`) with `sequence_id` and `offset`.

    Two shuffles of narrow rows: the counts per length and task, and the pieces by
    (length, task) to meet their task's first number. Token ids never move.
    """
    by_task = pieces.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = by_task.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    counts = {row["length"]: row["n"] for row in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    places = places_of(plan_bins(counts, capacity))
    shared = pieces.sparkSession.sparkContext.broadcast(places)

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, first, offset = shared.value
        for batch in batches:
            length = batch.column("length").to_numpy().astype(np.int64)
            number = batch.column("number").to_numpy()
            key = (length << 44) | number
            at = np.searchsorted(keys, key, "right") - 1
            found = first[at] + (key - keys[at])
            kept = [batch.column(name) for name in batch.schema.names if name != "number"]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(found), pa.array(offset[at])], names)

    columns = [name for name in pieces.columns if name not in ("part", "nth")]
    numbered = pieces.join(bases, ["length", "part"]).select(*columns, (F.col("base") + F.col("nth")).alias("number"))
    names = [*columns, "sequence_id", "offset"]
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.select(*columns).schema.fields)
    return numbered.mapInArrow(place, f"{fields}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None, ids: bool = False) -> DataFrame:
    """Cut all documents into pieces and place them: one row per piece.

    Pieces are written to the shared folder once, so that encoding is never repeated.
    With `ids` the rows carry the token ids; `sequences` joins those into whole sequences.
    """
    return pack(staged(cut_pieces(docs, capacity, path, ids), "pieces"), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """Training sequences from packed pieces with ids: (sequence_id, length, ids binary of uint32)."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(
        F.sum("length").alias("length"), F.concat_ws("", F.transform(parts, lambda p: F.hex(p["ids"]))).alias("hex")
    ).select("sequence_id", "length", F.unhex("hex").alias("ids"))
