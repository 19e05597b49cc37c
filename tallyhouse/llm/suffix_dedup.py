"""Exact removal of repeated byte strings by an enhanced suffix array.

A byte goes when a string of `width` bytes that covers it also starts in a document with
a smaller `doc_id`. All such strings of a text are its windows.

1. Every window is filed under its anchor, the 20-byte string in it with the smallest
   hash. Consecutive windows with one anchor are kept as one piece of text. Equal windows
   have equal anchors, so an anchor that occurs in one document only ends here.
2. Pieces travel as hashes in packed arrays. Equal pieces are one leaf with all its
   occurrences; within a batch only those of its smallest document travel.
3. Where an anchor has unequal pieces, the text of each is fetched once and a suffix array
   is built over all suffixes of the pieces that start a window, with the lengths of their
   common prefixes. A scan with a stack lists the intervals of suffixes that share a
   prefix of at least `width` bytes. An interval whose suffixes all have the same byte on
   their left is part of a longer repeat and is left out; the others are the maximal
   repeats, each with all its occurrences. Every occurrence but those of the smallest
   document is a span to remove.
4. Spans are merged per document and cut out.

An anchor with more than `GROUP` unequal pieces (a passage that very many documents
continue differently) is not gathered: its windows are filed one by one under their own
hash, combined in the map tasks, and compared there, with the same result.

Defined results: null text is empty; texts shorter than `width` bytes stay; rows with one
`doc_id` do not remove from each other, and what is decided for one holds for that row's
text alone; rows without `doc_id` stay whole and remove
nothing; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm._shared import BATCH_BYTES, shuffle_width, slices, staged
from tallyhouse.llm.ngram_join import mix

_U = np.uint64
_PLACE = (1 << 24) - 1  # positions within one stretch of text
_STRETCH = 512 << 10
_LETTER = mix(np.arange(1, 257, dtype=_U) * _U(0x9E3779B97F4A7C15)) | _U(1)
_BASE = 0x9FB21C651E98DF25
_INVERSE = pow(_BASE, -1, 1 << 64)

#: A piece as its slice of the documents is looked at; `doc` is its row there.
FOUND = np.dtype([("anchor", "<u8"), ("body", "<u8"), ("start", "<u4"), ("doc", "<u2"), ("n", "u1")])
#: A piece on its way to its anchor's bucket.
PIECE = np.dtype([("h", "<u4"), ("c", "<u4"), ("c2", "<u2"), ("doc", "<u2"), ("start", "<u4"), ("n", "u1")])
#: A row of the documents: its `doc_id`, and the hash of its text, which tells rows of one `doc_id` apart.
ROW = np.dtype([("doc", "<i8"), ("key", "<i8")])
#: A decision or request on its way to its document: 0 span, 1 fetch the piece, 2 file its windows one by one.
MARK = np.dtype([("doc", "<i8"), ("key", "<i8"), ("start", "<u4"), ("end", "<u4"), ("kind", "u1"), ("h", "<u8")])
#: A piece with text on its way to its suffix array; the text stands in a blob, one after the other.
TEXT = np.dtype([("h", "<u8"), ("doc", "<i8"), ("key", "<i8"), ("start", "<u4"), ("size", "<u4")])
#: A window of an anchor with very many pieces.
WINDOW = np.dtype([("w", "<u8"), ("doc", "<i8"), ("key", "<i8"), ("start", "<u4")])


class Repeats(NamedTuple):
    width: int = 50
    anchor: int = 20
    #: Unequal pieces of one anchor that are gathered in one task.
    group: int = 20_000


_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, modulo 2**64."""
    if not _POWERS or len(_POWERS[0]) < n:
        _POWERS.clear()
        for base in (_BASE, _INVERSE):
            steps = np.full(n, base, _U)
            steps[0] = 1
            _POWERS.append(np.multiply.accumulate(steps))
    return _POWERS[0], _POWERS[1]


def pieces_of(data: np.ndarray, ends: np.ndarray, rule: Repeats) -> tuple[np.ndarray, ...]:
    """Pieces of the texts that lie end to end in `data`: first window, windows, anchor hash, hash of the bytes."""
    width, k = rule.width, rule.anchor
    n = len(data)
    if n < width:
        return tuple(np.zeros(0, kind) for kind in (np.int64, np.int64, _U, _U))
    power, inverse = _powers(n + 1)
    sums = np.zeros(n + 1, _U)
    np.cumsum(_LETTER[data] * power[:n], out=sums[1:])
    gram = mix((sums[k:] - sums[:-k]) * inverse[: n - k + 1])
    # Hash first, place second: the smallest of a window is its leftmost smallest hash.
    least = (gram & ~_U(_PLACE)) | np.arange(len(gram), dtype=_U)
    span, want = 1, width - k + 1
    while span * 2 <= want:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < want:
        least = np.minimum(least[: len(least) - (want - span)], least[want - span :])
    anchor = (least & _U(_PLACE)).astype(np.int64)
    # A window that runs over the end of its text is none.
    over = np.zeros(n + 1, np.int64)
    starts = np.concatenate([[0], ends[:-1]])
    np.add.at(over, np.maximum(starts, ends - width + 1), 1)
    np.add.at(over, ends, -1)
    windows = np.flatnonzero(np.cumsum(over)[: len(anchor)] == 0)
    if not len(windows):
        return tuple(np.zeros(0, kind) for kind in (np.int64, np.int64, _U, _U))
    anchor = anchor[windows]
    breaks = np.flatnonzero((anchor[1:] != anchor[:-1]) | (windows[1:] != windows[:-1] + 1)) + 1
    first = np.concatenate([[0], breaks])
    count = np.diff(np.concatenate([first, [len(windows)]]))
    start = windows[first]
    body = mix((sums[start + count + width - 1] - sums[start]) * inverse[start] + count.astype(_U))
    return start, count, gram[anchor[first]], body


def merged(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of half-open spans, ascending."""
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate(end[order])
    new = np.concatenate([[True], start[1:] > end[:-1]])
    last = np.concatenate([np.flatnonzero(new)[1:] - 1, [len(end) - 1]])
    return start[new], end[last]


def _batch(columns: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(columns)


def _marks_by_bucket(marks: np.ndarray, buckets: int) -> pa.RecordBatch:
    """Packed marks, one row per bucket of documents."""
    bucket = _doc_bucket(marks["doc"], buckets)
    order = np.argsort(bucket, kind="stable")
    marks, bucket = marks[order], bucket[order]
    first = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
    rows = [part.tobytes() for part in np.split(marks, first[1:])]
    return _batch({"bucket": pa.array(bucket[first], pa.int32()), "marks": pa.array(rows, pa.binary())})


def _gathered(found: Iterable[np.ndarray], buckets: int) -> Iterator[pa.RecordBatch]:
    """Packed marks of many small finds, a bounded number at a time."""
    parts, held = [], 0
    for marks in found:
        parts.append(marks)
        held += marks.nbytes
        if held >= BATCH_BYTES:
            yield _marks_by_bucket(np.concatenate(parts), buckets)
            parts, held = [], 0
    if held:
        yield _marks_by_bucket(np.concatenate(parts), buckets)


def _doc_bucket(doc: np.ndarray, buckets: int) -> np.ndarray:
    return (mix(doc.astype(np.int64).view(_U)) % _U(buckets)).astype(np.int32)


def _stretches(batch: pa.RecordBatch, width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(bytes, ends, row of each text, its offset in the row's text) for about `_STRETCH` bytes at a time."""
    parts, rows, offsets, held = [], [], [], 0

    def out() -> tuple:
        sizes = np.array([len(p) for p in parts], np.int64)
        data = np.frombuffer(b"".join(parts), np.uint8)
        return data, np.cumsum(sizes), np.array(rows, np.int64), np.array(offsets, np.int64)

    for row, text in enumerate(batch.column("text").to_pylist()):
        data = (text or "").encode("utf-8", "surrogatepass")
        for at in range(0, max(1, len(data)), _STRETCH):  # a longer text is cut, its windows are not
            part = data[at : at + _STRETCH + width - 1]
            if len(part) < width:
                continue
            parts.append(part)
            rows.append(row)
            offsets.append(at)
            held += len(part)
            if held >= _STRETCH:
                yield out()
                parts, rows, offsets, held = [], [], [], 0
    if parts:
        yield out()


def _file(docs: DataFrame, rule: Repeats, buckets: int) -> DataFrame:
    """Pieces packed by bucket of their anchor, and spans that a batch decides by itself."""

    def file(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 8 << 20, 60_000):
            yield from filed(batch)  # whose arrays are gone before the next slice

    def filed(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        names = np.empty(batch.num_rows, ROW)
        for field, column in (("doc", "doc_id"), ("key", "key")):
            names[field] = batch.column(column).to_numpy(zero_copy_only=False)
        parts = []
        for data, ends, rows, offsets in _stretches(batch, rule.width):
            start, count, anchor, body = pieces_of(data, ends, rule)
            text = np.searchsorted(ends, start, "right")
            begin = np.concatenate([[0], ends[:-1]])[text]
            part = np.empty(len(start), FOUND)
            part["doc"], part["start"], part["n"] = rows[text], start - begin + offsets[text], count
            part["anchor"], part["body"] = anchor, body
            parts.append(part)
        if not parts:
            return
        found = np.concatenate(parts)
        parts.clear()
        doc = names["doc"][found["doc"]]
        # Of equal pieces only those in the smallest document travel; the others are decided.
        order = np.lexsort((doc, found["body"]))
        ranked, ranked_doc = found["body"][order], doc[order]
        head = np.maximum.accumulate(np.where(np.concatenate([[True], ranked[1:] != ranked[:-1]]), np.arange(len(order)), 0))
        later = ranked_doc > ranked_doc[head]
        del doc, ranked, ranked_doc, head
        yield from local_spans(names, found[order[later]])
        found = found[order[~later]]
        del order, later
        bucket = (found["anchor"] & _U(0xFFFFFFFF)) % _U(buckets)
        order = np.argsort(bucket, kind="stable")
        cuts = np.searchsorted(bucket[order], np.arange(buckets + 1, dtype=_U))
        out, held = {"bucket": [], "pieces": [], "docs": [], "marks": []}, 0
        for b in np.flatnonzero(np.diff(cuts)):
            own = found[order[cuts[b] : cuts[b + 1]]]
            piece = np.empty(len(own), PIECE)
            piece["h"] = own["anchor"] >> _U(32)
            piece["c"] = own["body"] >> _U(32)
            piece["c2"] = own["body"] & _U(0xFFFF)
            piece["start"], piece["n"] = own["start"], own["n"]
            used, piece["doc"] = np.unique(own["doc"], return_inverse=True)
            out["bucket"].append(int(b))
            out["pieces"].append(piece.tobytes())
            out["docs"].append(names[used].tobytes())
            out["marks"].append(b"")
            held += piece.nbytes + len(out["docs"][-1])
            if held >= BATCH_BYTES:
                yield packed(out)
                out, held = {name: [] for name in out}, 0
        if held:
            yield packed(out)

    def local_spans(names: np.ndarray, which: np.ndarray) -> Iterator[pa.RecordBatch]:
        which = which[np.lexsort((which["start"], which["doc"]))]
        if not len(which):
            return
        row, start = which["doc"], which["start"].astype(np.int64)
        # Texts end to end, far enough apart that spans of two never touch.
        shift = np.cumsum(np.concatenate([[0], (row[1:] != row[:-1])])) << 33
        low, high = merged(start + shift, start + which["n"] + rule.width - 1 + shift)
        of = names[row[np.searchsorted(shift, low >> 33 << 33)]]
        marks = np.zeros(len(low), MARK)
        marks["doc"], marks["key"] = of["doc"], of["key"]
        marks["start"], marks["end"] = low & ((1 << 33) - 1), high & ((1 << 33) - 1)
        yield packed({"bucket": [int(of["doc"][0]) % buckets], "pieces": [b""], "docs": [b""], "marks": [marks.tobytes()]})

    def packed(out: dict) -> pa.RecordBatch:
        kinds = {"bucket": pa.int32(), "pieces": pa.binary(), "docs": pa.binary(), "marks": pa.binary()}
        return _batch({name: pa.array(out[name], kind) for name, kind in kinds.items()})

    return docs.mapInArrow(file, "bucket int, pieces binary, docs binary, marks binary")


def _meet(filed: DataFrame, rule: Repeats, doc_buckets: int) -> DataFrame:
    """Per bucket of anchors: spans of equal pieces, and requests for the text of unequal ones.

    Rows of a bucket stand together, so a task holds the pieces of one bucket at a time.
    """

    def meet(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _gathered(decided(batches), doc_buckets)

    def decided(batches: Iterable[pa.RecordBatch]) -> Iterator[np.ndarray]:
        bucket, pieces, names = None, [], []
        for batch in batches:
            for row in batch.to_pylist():
                if row["marks"]:
                    yield np.frombuffer(row["marks"], MARK)
                    continue
                if row["bucket"] != bucket:
                    if pieces:
                        yield met(bucket, pieces, names)
                    bucket = row["bucket"]
                pieces.append(np.frombuffer(row["pieces"], PIECE))
                names.append(np.frombuffer(row["docs"], ROW))
        if pieces:
            yield met(bucket, pieces, names)

    def met(bucket: int, pieces: list[np.ndarray], names: list[np.ndarray]) -> np.ndarray:
        """Marks of one bucket, whose lists are emptied."""
        held = np.cumsum([0, *map(len, names[:-1])])
        place = np.concatenate([part["doc"] + np.uint32(at) for part, at in zip(pieces, held.tolist())])
        piece, name = np.concatenate(pieces), np.concatenate(names)
        pieces.clear(), names.clear()
        body = piece["c"].astype(_U) << _U(16) | piece["c2"].astype(_U)
        order = np.lexsort((name["doc"][place], body, piece["h"]))
        piece, body, place = piece[order], body[order], place[order]
        doc, anchor = name["doc"][place], piece["h"]
        at = np.arange(len(order))
        new_anchor = np.concatenate([[True], anchor[1:] != anchor[:-1]])
        new_body = new_anchor | np.concatenate([[True], body[1:] != body[:-1]])
        head = np.maximum.accumulate(np.where(new_body, at, 0))
        later = doc > doc[head]
        group = np.cumsum(new_anchor) - 1
        bodies = np.bincount(group[new_body])
        first = np.flatnonzero(new_anchor)
        shared = np.minimum.reduceat(doc, first) != np.maximum.reduceat(doc, first)
        fetch = ~later & (shared & (bodies > 1))[group]
        marks = np.zeros(int(later.sum() + fetch.sum()), MARK)
        which = np.concatenate([np.flatnonzero(later), np.flatnonzero(fetch)])
        marks["doc"], marks["key"], marks["start"] = doc[which], name["key"][place[which]], piece["start"][which]
        marks["end"] = marks["start"] + piece["n"][which].astype(np.uint32) + np.uint32(rule.width - 1)
        marks["kind"][int(later.sum()) :] = np.where((bodies > rule.group)[group[fetch]], 2, 1)
        # The bucket is part of the anchor's name.
        marks["h"][int(later.sum()) :] = anchor[fetch].astype(_U) << _U(32) | _U(bucket)
        return marks

    return filed.sortWithinPartitions("bucket").mapInArrow(meet, "bucket int, marks binary")


#: Rows after the texts have met their marks: finished documents, open ones, packed pieces or windows.
_MET = (
    "kind string, bucket int, doc_id long, key long, n_bytes long, spans binary, text binary, "
    "records binary, blob binary"
)


def _empty_met() -> dict:
    return {name.split()[0]: [] for name in _MET.split(", ")}


def _met_batch(rows: dict) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    fields = [field.split() for field in _MET.split(", ")]
    return _batch({name: pa.array(rows[name], kinds[kind]) for name, kind in fields})


def _add(rows: dict, **values: object) -> None:
    for name, column in rows.items():
        column.append(values.get(name))


def _own(marks: np.ndarray, row: dict) -> np.ndarray:
    """The marks of one row, of marks that ascend by `doc_id`."""
    low, high = np.searchsorted(marks["doc"], [row["doc_id"], row["doc_id"] + 1])
    own = marks[low:high]
    return own[own["key"] == row["key"]]


def _with_texts(docs: DataFrame, marks: DataFrame, partitions: int) -> DataFrame:
    """Texts and packed marks of one bucket of documents side by side, marks first."""
    texts = docs.select("bucket", F.lit(1).alias("rank"), "doc_id", "key", "text", F.lit(None).cast("binary").alias("marks"))
    none = [F.lit(None).cast(kind).alias(name) for name, kind in (("doc_id", "long"), ("key", "long"), ("text", "binary"))]
    first = marks.select("bucket", F.lit(0).alias("rank"), *none, "marks")
    return first.union(texts).repartition(partitions, "bucket").sortWithinPartitions("bucket", "rank")


def _fetch(side_by_side: DataFrame, rule: Repeats, buckets: int) -> DataFrame:
    """Finish documents that have no request; cut out the pieces that were asked for."""

    def fetch(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        bucket, parts, marks = None, [], np.zeros(0, MARK)
        rows, pieces, windows, held = _empty_met(), [], [], 0
        for batch in batches:
            for row in batch.to_pylist():
                if row["bucket"] != bucket:
                    bucket, parts, marks = row["bucket"], [], np.zeros(0, MARK)
                if row["marks"] is not None:
                    parts.append(np.frombuffer(row["marks"], MARK))
                    continue
                if parts:
                    marks, parts = np.concatenate(parts), []
                    marks = marks[np.argsort(marks["doc"], kind="stable")]
                own = _own(marks, row)
                data = unpack.decompress(row["text"])
                spans = own[own["kind"] == 0]
                asked = own[own["kind"] > 0]
                spans_ = np.stack(merged(spans["start"].astype(np.int64), spans["end"].astype(np.int64)), 1) if len(spans) else np.zeros((0, 2), np.int64)
                _add(
                    rows,
                    kind="open" if len(asked) else "done",
                    bucket=bucket,
                    doc_id=row["doc_id"],
                    key=row["key"],
                    n_bytes=len(data),
                    spans=spans_.astype("<i8").tobytes(),
                    text=row["text"],
                )
                for doc, key, start, end, kind, h in asked.tolist():
                    (pieces if kind == 1 else windows).append((h, doc, key, start, data[start:end]))
                    held += end - start + 24
                held += len(row["text"])
                if held > 8 << 20:
                    packed(rows, pieces, windows)
                    yield _met_batch(rows)
                    rows, pieces, windows, held = _empty_met(), [], [], 0
        packed(rows, pieces, windows)
        if rows["kind"]:
            yield _met_batch(rows)

    def packed(rows: dict, pieces: list, windows: list) -> None:
        if pieces:
            names = np.array([piece[0] for piece in pieces], _U)
            bucket = (mix(names) % _U(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
            for b in np.flatnonzero(np.diff(cuts)).tolist():
                own = [pieces[i] for i in order[cuts[b] : cuts[b + 1]].tolist()]
                records = np.array([(*where, len(data)) for *where, data in own], TEXT)
                _add(rows, kind="piece", bucket=b, records=records.tobytes(), blob=b"".join(p[-1] for p in own))
        if windows:
            for bucket, records in windows_by_bucket(windows):
                _add(rows, kind="window", bucket=bucket, records=records.tobytes(), blob=b"")

    def windows_by_bucket(windows: list) -> Iterator[tuple[int, np.ndarray]]:
        found = []
        for _, doc, key, start, data in windows:
            values = np.frombuffer(data, np.uint8)
            power, inverse = _powers(len(values) + 1)
            sums = np.concatenate([np.zeros(1, _U), np.cumsum(_LETTER[values] * power[: len(values)])])
            n = len(values) - rule.width + 1
            part = np.empty(n, WINDOW)
            part["w"] = mix((sums[rule.width :] - sums[:n]) * inverse[:n])
            part["doc"], part["key"], part["start"] = doc, key, start + np.arange(n)
            found.append(part)
        records = np.concatenate(found)
        bucket = (mix(records["w"]) % _U(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
        for b in np.flatnonzero(np.diff(cuts)):
            yield int(b), records[order[cuts[b] : cuts[b + 1]]]

    return side_by_side.mapInArrow(fetch, _MET)


class SuffixArray(NamedTuple):
    """Suffixes of several groups of pieces, ascending by group and bytes; no order between groups matters."""

    piece: np.ndarray  # of each suffix
    offset: np.ndarray  # where it starts in the piece
    common: np.ndarray  # bytes shared with the suffix before; 0 across groups
    left: np.ndarray  # byte on its left, or -1 at the start of a piece


def suffix_array(group: np.ndarray, sizes: np.ndarray, blob: np.ndarray, width: int) -> SuffixArray:
    """Sort all suffixes that are at least `width` bytes long."""
    begin = np.cumsum(sizes) - sizes
    count = sizes - width + 1
    piece = np.repeat(np.arange(len(sizes)), count)
    offset = np.arange(len(piece)) - np.repeat(np.cumsum(count) - count, count)
    start, rest = begin[piece] + offset, sizes[piece] - offset
    longest = int(sizes.max())
    padded = np.concatenate([blob, np.zeros(longest, np.uint8)])
    rows = np.lib.stride_tricks.sliding_window_view(padded, longest)[start].copy()
    rows[np.arange(longest)[None, :] >= rest[:, None]] = 0
    keyed = np.concatenate([group[piece].astype(">u4").view(np.uint8).reshape(-1, 4), rows], axis=1)
    order = np.argsort(np.ascontiguousarray(keyed).view(f"S{longest + 4}").ravel(), kind="stable")
    piece, offset, rest, rows = piece[order], offset[order], rest[order], rows[order]
    unlike = rows[1:] != rows[:-1]
    common = np.where(unlike.any(axis=1), unlike.argmax(axis=1), longest)
    common = np.minimum(common, np.minimum(rest[1:], rest[:-1]))
    common[group[piece[1:]] != group[piece[:-1]]] = 0
    left = np.where(offset > 0, padded[np.maximum(begin[piece] + offset - 1, 0)].astype(np.int64), -1)
    return SuffixArray(piece, offset, np.concatenate([[0], common]), left)


def maximal_repeats(array: SuffixArray, width: int) -> Iterator[tuple[int, int, int]]:
    """(length, low, high): repeats of at least `width` bytes that can be extended neither way; suffixes low..high-1.

    Suffixes with a common prefix of `width` bytes stand together. Such a stretch whose
    suffixes all have the same byte on the left holds no repeat that starts here.
    """
    n = len(array.common)
    if n < 2:
        return
    edge = np.flatnonzero(array.common < width)
    ends = np.concatenate([edge[1:], [n]])
    many = ends - edge > 1
    edge, ends = edge[many], ends[many]
    if not len(edge):
        return
    bounds = np.stack([edge, ends], 1).ravel()
    left = np.concatenate([array.left, [0]])
    least = np.minimum.reduceat(left, bounds)[::2]
    most = np.maximum.reduceat(left, bounds)[::2]
    diverse = (least != most) | (least < 0)
    for low, high in zip(edge[diverse].tolist(), ends[diverse].tolist()):
        yield from _scan(array.common[low:high].tolist(), array.left[low:high].tolist(), low, width)


def _scan(common: list[int], left: list[int], shift: int, width: int) -> Iterator[tuple[int, int, int]]:
    """Stack scan over one stretch. Each entry: depth, first suffix, its left byte or -1 when they differ."""
    stack: list[list[int]] = []
    for at in range(1, len(common) + 1):
        depth = common[at] if at < len(common) else 0
        first, byte = at - 1, left[at - 1]
        while stack and stack[-1][0] > depth:
            top_depth, first, top_byte = stack.pop()
            byte = top_byte if top_byte == byte else -1
            if byte < 0:
                yield top_depth, shift + first, shift + at
        if depth >= width:
            if stack and stack[-1][0] == depth:
                stack[-1][2] = byte if byte == stack[-1][2] else -1
            else:
                stack.append([depth, first, byte])


def repeat_spans(records: np.ndarray, blob: np.ndarray, width: int) -> np.ndarray:
    """Marks for every occurrence of a maximal repeat that is not in the repeat's smallest document."""
    sizes = records["size"].astype(np.int64)
    array = suffix_array(np.unique(records["h"], return_inverse=True)[1], sizes, blob, width)
    doc, key = records["doc"][array.piece], records["key"][array.piece]
    start = records["start"][array.piece].astype(np.int64) + array.offset
    found = []
    for length, low, high in maximal_repeats(array, width):
        own = doc[low:high]
        later = own > own.min()
        if later.any():
            part = np.zeros(int(later.sum()), MARK)
            part["doc"], part["key"], part["start"] = own[later], key[low:high][later], start[low:high][later]
            part["end"] = part["start"] + length
            found.append(part)
    return np.concatenate(found) if found else np.zeros(0, MARK)


def _repeats(met: DataFrame, rule: Repeats, doc_buckets: int) -> DataFrame:
    """Per bucket of anchors: spans from suffix arrays, and from windows filed one by one."""

    def repeats(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        records, blobs, windows = [], [], []
        for batch in batches:
            for row in batch.to_pylist():
                if row["kind"] == "window":
                    windows.append(np.frombuffer(row["records"], WINDOW))
                else:
                    records.append(np.frombuffer(row["records"], TEXT))
                    blobs.append(row["blob"])
        if records:
            record, blob = np.concatenate(records), np.frombuffer(b"".join(blobs), np.uint8)
            records.clear(), blobs.clear()
            begin = np.cumsum(record["size"].astype(np.int64)) - record["size"]
            order = np.argsort(record["h"], kind="stable")
            # Whole groups of pieces, a bounded number at a time.
            turns = np.flatnonzero(np.concatenate([[True], record["h"][order][1:] != record["h"][order][:-1]]))
            marks, low = [], 0
            while low < len(order):
                far = np.searchsorted(turns, low + 4000, "right")
                high = int(turns[far]) if far < len(turns) else len(order)
                own = record[order[low:high]]
                size = own["size"].astype(np.int64)
                take = np.repeat(begin[order[low:high]] - (np.cumsum(size) - size), size) + np.arange(size.sum())
                marks.append(repeat_spans(own, blob[take], rule.width))
                low = high
            marks_ = np.concatenate(marks)
            if len(marks_):
                yield _marks_by_bucket(marks_, doc_buckets)
        if windows:
            window = np.concatenate(windows)
            window = window[np.lexsort((window["doc"], window["w"]))]
            new = np.concatenate([[True], window["w"][1:] != window["w"][:-1]])
            head = np.maximum.accumulate(np.where(new, np.arange(len(window)), 0))
            later = window[window["doc"] > window["doc"][head]]
            marks_ = np.zeros(len(later), MARK)
            marks_["doc"], marks_["key"], marks_["start"] = later["doc"], later["key"], later["start"]
            marks_["end"] = later["start"] + rule.width
            if len(marks_):
                yield _marks_by_bucket(marks_, doc_buckets)

    return met.mapInArrow(repeats, "bucket int, marks binary")


def _finish(rows: DataFrame, with_text: bool) -> DataFrame:
    """Cut the spans out of each text and describe what is left."""
    schema = "doc_id long, key long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start:long,end:long>>"
    schema += ", kept binary" if with_text else ""
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def finish(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        bucket, parts, marks = None, [], np.zeros(0, MARK)
        for batch in batches:
            out: list[tuple] = []
            for row in batch.to_pylist():
                if row["bucket"] != bucket:
                    bucket, parts, marks = row["bucket"], [], np.zeros(0, MARK)
                if row["marks"] is not None:
                    parts.append(np.frombuffer(row["marks"], MARK))
                    continue
                if parts:
                    marks, parts = np.concatenate(parts), []
                    marks = marks[np.argsort(marks["doc"], kind="stable")]
                data = unpack.decompress(row["text"])
                known = np.frombuffer(row["spans"], "<i8").reshape(-1, 2)
                more = _own(marks, row)
                low = np.concatenate([known[:, 0], more["start"].astype(np.int64)])
                high = np.concatenate([known[:, 1], more["end"].astype(np.int64)])
                if len(low):
                    low, high = merged(low, high)
                cuts = [0, *np.stack([low, high], 1).ravel().tolist(), len(data)]
                kept = b"".join(data[a:b] for a, b in zip(cuts[::2], cuts[1::2]))
                spans = [{"start": a, "end": b} for a, b in zip(low.tolist(), high.tolist())]
                facts = (row["doc_id"], row["key"], len(data), len(data) - len(kept), len(low), hashlib.sha256(kept).hexdigest(), spans)
                out.append((*facts, kept) if with_text else facts)
            if out:
                kinds = [pa.int64()] * 5 + [pa.string(), span, pa.binary()]
                names = ["doc_id", "key", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept"]
                yield _batch({n: pa.array(list(v), k) for n, v, k in zip(names, zip(*out), kinds)})

    return rows.mapInArrow(finish, schema)


def _compressed(docs: DataFrame, buckets: int) -> DataFrame:
    """Texts with their bucket, as Zstandard frames, which move and spill at under half the size."""

    def compress(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=1)
        for batch in slices(batches, "text"):
            data = [packer.compress((text or "").encode("utf-8", "surrogatepass")) for text in batch.column("text").to_pylist()]
            bucket = _doc_bucket(batch.column("doc_id").fill_null(0).to_numpy(zero_copy_only=False), buckets)
            columns = [pa.array(bucket, pa.int32()), batch.column("doc_id"), batch.column("key"), pa.array(data, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["bucket", "doc_id", "key", "text"])

    return docs.select("doc_id", "key", "text").mapInArrow(compress, "bucket int, doc_id long, key long, text binary")


def suffix_dedup(docs: DataFrame, rule: Repeats = Repeats(), with_text: bool = False) -> DataFrame:
    """One row per document: doc_id, key (a hash of its text), n_bytes, n_removed, n_spans, kept_sha256, spans, and kept bytes if asked."""
    partitions = shuffle_width(docs)
    buckets = 4 * partitions
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("key"), "text")

    named = docs.where("doc_id is not null")
    filed = _file(named, rule, buckets).repartition(partitions, "bucket")
    marks = staged(_meet(filed, rule, buckets), "suffix-marks")
    placed = _compressed(named, buckets)
    met = staged(_fetch(_with_texts(placed, marks, partitions), rule, buckets), "suffix-met")
    packed = met.where("kind in ('piece', 'window')").select("kind", "bucket", "records", "blob").repartition(partitions, "bucket")
    spans = staged(_repeats(packed, rule, buckets), "suffix-spans")
    open_docs = met.where("kind = 'open'").select("bucket", "doc_id", "key", "text", "spans")
    none = {"doc_id": "long", "key": "long", "text": "binary", "spans": "binary"}
    first = spans.select("bucket", F.lit(0).alias("rank"), *[F.lit(None).cast(k).alias(n) for n, k in none.items()], "marks")
    rest = open_docs.select("bucket", F.lit(1).alias("rank"), *none, F.lit(None).cast("binary").alias("marks"))
    late = first.union(rest).repartition(partitions, "bucket").sortWithinPartitions("bucket", "rank")
    no_marks = F.lit(None).cast("binary").alias("marks")
    done = met.where("kind = 'done'").select("bucket", F.lit(1).alias("rank"), *none, no_marks)
    unnamed = _compressed(docs.where("doc_id is null"), buckets).select(
        "bucket", F.lit(1).alias("rank"), "doc_id", "key", "text", F.lit(b"").alias("spans"), no_marks
    )
    return _finish(late, with_text).union(_finish(done, with_text)).union(_finish_unnamed(unnamed, with_text))


def _finish_unnamed(rows: DataFrame, with_text: bool) -> DataFrame:
    """Rows without doc_id stay whole: give them a number for the while, then take it away."""
    result = _finish(rows.withColumn("doc_id", F.lit(0).cast("long")), with_text)
    return result.withColumn("doc_id", F.lit(None).cast("long"))
