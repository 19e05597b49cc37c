"""Plain, slow versions of the operators, and small documents that hold the odd cases."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows):
    """A documents table; rows are (doc_id, text)."""
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], DOCUMENTS)


def prose(seed: int, words: int, letters: int = 400) -> str:
    draw = random.Random(seed)
    names = [f"w{draw.randrange(10**6)}x" for _ in range(letters)]
    return " ".join(draw.choice(names) for _ in range(words))


def words(text: str | None) -> list[str]:
    return re.findall("[^\x20\x09-\x0d]+", text or "")


def quality_counts(text: str | None) -> tuple:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    found = words(text)
    lines = [line for line in (text or "").split("\n") if words(line)]
    windows = Counter(zip(found, found[1:], found[2:]))
    covered = set()
    for at, window in enumerate(zip(found, found[1:], found[2:])):
        if windows[window] > 1:
            covered.update((at, at + 1, at + 2))
    failed = len(found) < 50 or 100 * len(covered) > 50 * len(found)
    symbols = len(re.findall("[#*$%&|<>]", text or ""))
    return len(found), sum(map(len, found)), symbols, len(lines) - len(set(lines)), len(covered), failed


def shingle_set(text: str | None, size: int = 4) -> frozenset:
    found = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(found[at : at + size]) for at in range(max(1, len(found) - size + 1))) if found else frozenset()


def ngram_components(rows: list[tuple], size: int = 4, percent: int = 85) -> dict:
    """doc_id -> (set size, component), for distinct doc_ids."""
    sets = {i: shingle_set(t, size) for i, t in rows}
    up = {i: i for i in sets}

    def root(a):
        while up[a] != a:
            a = up[a]
        return a

    ids = sorted(sets)
    for at, a in enumerate(ids):
        for b in ids[at + 1 :]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                one, two = root(a), root(b)
                up[max(one, two)] = min(one, two)
    return {i: (len(sets[i]), root(i)) for i in ids}


def bytes_gone(rows: list[tuple], width: int = 50) -> list[tuple]:
    """(doc_id, bytes, one flag per byte that goes) per row."""
    texts = [(i, (t or "").encode()) for i, t in rows]
    first: dict[bytes, int] = {}
    for i, data in texts:
        if i is not None:
            for at in range(len(data) - width + 1):
                window = data[at : at + width]
                first[window] = min(first.get(window, i), i)
    out = []
    for i, data in texts:
        gone = bytearray(len(data))
        if i is not None:
            for at in range(len(data) - width + 1):
                if first[data[at : at + width]] < i:
                    gone[at : at + width] = b"\1" * width
        out.append((i, data, gone))
    return out


def repeated_bytes(rows: list[tuple], width: int = 50) -> list[tuple]:
    """(doc_id, n_bytes, n_removed, n_spans, sha256 of what is left) per row."""
    out = []
    for i, data, gone in bytes_gone(rows, width):
        spans = sum(1 for at, g in enumerate(gone) if g and not (at and gone[at - 1]))
        kept = bytes(b for b, g in zip(data, gone) if not g)
        out.append((i, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out
