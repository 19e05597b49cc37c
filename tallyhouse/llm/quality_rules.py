"""Quality rules: base rules on words and lines, then bands of zstandard compression ratios.

A text is compressed whole and in fixed chunks. Very repetitive text compresses too
well, random bytes hardly at all, and how well ordinary prose compresses depends on
how long it is, so each limit holds for a range of lengths.

Defined results: null and empty text have no words and fail the base rules; a null
`doc_id` stays null; repeated rows are each judged; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from tallyhouse.llm._shared import slices

WHITE = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"


HIGH = bytes(range(128, 256))


class Band(NamedTuple):
    """Raw bytes over compressed bytes must lie in [least, most] for texts below `below` bytes.

    A plain text, nearly all of it ASCII, must reach `plain` instead of `least`.
    """

    below: float
    least: float
    most: float
    plain: float = 0.0


#: Prose stays well inside; a short text has too few bytes to say much, so its band is wide.
#: `plain` lies between random letters and digits (base64, keys) and prose of that length.
BANDS = (
    Band(256, 0.0, 3.0),
    Band(512, 1.02, 3.0, 1.27),
    Band(1 << 10, 1.05, 3.2, 1.31),
    Band(2 << 10, 1.10, 3.5, 1.42),
    Band(4 << 10, 1.15, 4.0, 1.55),
    Band(8 << 10, 1.20, 4.5, 1.57),
    Band(32 << 10, 1.25, 5.0, 1.60),
    Band(float("inf"), 1.30, 6.0, 1.60),
)


class Rules(NamedTuple):
    min_words: int = 50
    #: Most words, in percent, that may lie in three-word windows found more than once.
    max_repeat_percent: int = 50
    level: int = 3
    chunk_bytes: int = 4096
    #: A text is rejected when chunks holding more than this share of its bytes miss their band.
    max_bad_chunk_share: float = 0.25
    bands: tuple[Band, ...] = BANDS
    #: Most bytes, as a share, that a plain text may have beyond ASCII.
    max_high_share: float = 0.1


SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, ratio double, bad_chunk_share double"
)


def repeat_words(words: list[bytes]) -> int:
    """Words lying in a three-word window that occurs at least twice in the text."""
    if len(words) < 4:
        return 0
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(word, len(seen)) for word in words), np.int64, len(words))
    if len(seen) == len(words):
        return 0
    # Name pairs, then triples, by whole numbers; naming pairs afresh keeps the products small.
    pairs = ids[:-1] * len(seen) + ids[1:]
    if len(seen) > 1 << 20:
        pairs = np.unique(pairs, return_inverse=True)[1]
    triples = pairs[:-1] * len(seen) + ids[2:]
    order = np.argsort(triples, kind="stable")
    ranked = triples[order]
    same = ranked[1:] == ranked[:-1]
    if not same.any():
        return 0
    twice = np.zeros(len(triples), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(len(words), bool)
    for shift in range(3):
        covered[shift : shift + len(twice)] |= twice
    return int(covered.sum())


def repeated_lines(data: bytes) -> int:
    """Lines holding a word that equal an earlier line."""
    lines = [line for line in data.split(b"\n") if line.strip(WHITE)]
    return len(lines) - len(set(lines))


def in_band(ratio: float, data: bytes, rules: Rules) -> bool:
    band = next(b for b in rules.bands if len(data) < b.below)
    least = band.least
    if least <= ratio < band.plain and len(data) - len(data.translate(None, HIGH)) <= rules.max_high_share * len(data):
        least = band.plain
    return least <= ratio <= band.most


def compression(data: bytes, packer: zstandard.ZstdCompressor, rules: Rules) -> tuple[float, float, bool]:
    """Ratio of the whole text, share of bytes in chunks out of band, and whether the text passes."""
    if not data:
        return 0.0, 0.0, False
    ratio = len(data) / len(packer.compress(data))
    bad = 0
    if len(data) > rules.chunk_bytes:
        for start in range(0, len(data), rules.chunk_bytes):
            chunk = data[start : start + rules.chunk_bytes]
            if not in_band(len(chunk) / len(packer.compress(chunk)), chunk, rules):
                bad += len(chunk)
    share = bad / len(data)
    return ratio, share, in_band(ratio, data, rules) and share <= rules.max_bad_chunk_share


def judge(text: str | None, packer: zstandard.ZstdCompressor, rules: Rules) -> tuple:
    """All columns of the result after `doc_id`."""
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.split()  # bytes.split() splits at exactly the six ASCII white-space characters
    white = len(data) - len(data.translate(None, WHITE))
    symbols = len(data) - len(data.translate(None, SYMBOLS))
    repeats = repeat_words(words)
    failed = len(words) < rules.min_words or 100 * repeats > rules.max_repeat_percent * len(words)
    ratio, share, passes = compression(data, packer, rules)
    return (
        len(words),
        len(text or "") - white,
        symbols,
        repeated_lines(data),
        repeats,
        failed,
        passes and not failed,
        ratio,
        share,
    )


def quality_report(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """One row per document with its counts, ratios and verdict. No shuffle; memory is one batch."""

    def measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=rules.level)
        for batch in slices(batches, "text"):
            found = [judge(text, packer, rules) for text in batch.column("text").to_pylist()]
            kinds = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.float64()] * 2
            columns = [pa.array(values, kind) for values, kind in zip(zip(*found), kinds)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names)

    names = [field.split()[0] for field in SCHEMA.split(", ")]
    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(measure, SCHEMA)


def keep_good(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The documents that pass, with all their columns."""

    def measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=rules.level)
        for batch in slices(batches, "text"):
            kept = [judge(text, packer, rules)[6] for text in batch.column("text").to_pylist()]
            yield batch.filter(pa.array(kept, pa.bool_()))

    return docs.mapInArrow(measure, docs.schema)
