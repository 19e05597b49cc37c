"""Byte-level BPE by the backtracking encoder, in linear time, and decoding by an offset table.

An Aho-Corasick automaton over all tokens gives, in one pass, the longest token that
starts at each byte. The encoder takes it, checks it against the token before with the
pair-compatibility table (would merging in rank order really leave this border?), falls
back to the next shorter token, and steps back when none fits; a place found hopeless is
never tried again. What remains is exactly the result of the merges in rank order.

Decoding gathers bytes by an offset table: the place of each token's bytes in one blob.

Defined results: null and empty text have no ids and decode to empty text; the string of
an added token is that token, as in the library; a null `doc_id` stays null; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tallyhouse.llm._shared import slices
from tallyhouse.llm.word_tokens import BYTE_LETTERS, default_path

#: The split before the merges, fixed by the vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_OTHER = re.compile("[^\t-\r -~À-ÖØ-öø-ÿ]")
#: The same split where every character is ASCII or a Latin-1 letter, for the faster engine.
_LATIN = re.compile(
    "'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-zÀ-ÖØ-öø-ÿ]+| ?[0-9]+| ?[^\\sA-Za-zÀ-ÖØ-öø-ÿ0-9]+|\\s+(?!\\S)|\\s+"
)
_FULL = regex.compile(PATTERN)
#: Splits remembered in one worker (about 100 MB); when full it starts anew.
MEMORY = 400_000


class ByteBpe:
    """Vocabulary tables of a byte-level BPE file; tokens are numbered by rank inside."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            stored = json.load(file)
        vocab, merges = stored["model"]["vocab"], stored["model"]["merges"]
        letters = {BYTE_LETTERS.get(byte, chr(byte)): byte for byte in range(256)}
        self.bytes_of = [bytes([byte]) for byte in range(256)]
        rank = {letter: byte for letter, byte in letters.items()}
        #: By rank: the two tokens it was merged from, itself twice for a single byte.
        self.split = [(byte, byte) for byte in range(256)]
        self.merged: dict[tuple[int, int], int] = {}
        for left, right in (merge if isinstance(merge, list) else merge.split(" ") for merge in merges):
            pair = (rank[left], rank[right])
            if left + right in rank:  # a second way to the same bytes
                self.merged.setdefault(pair, rank[left + right])
                continue
            rank[left + right] = self.merged[pair] = len(self.bytes_of)
            self.split.append(pair)
            self.bytes_of.append(self.bytes_of[pair[0]] + self.bytes_of[pair[1]])
        self.id_of = [0] * len(self.bytes_of)
        for letters_, at in rank.items():
            self.id_of[at] = vocab[letters_]
        self.automaton = ahocorasick.Automaton()
        for at, data in enumerate(self.bytes_of):
            self.automaton.add_word(data.decode("latin-1"), at)
        self.automaton.make_automaton()
        rank_of_bytes = {data: at for at, data in enumerate(self.bytes_of)}
        #: By rank: the longest shorter token its bytes begin with, or -1.
        self.shorter = [
            next((rank_of_bytes[data[:n]] for n in range(len(data) - 1, 0, -1) if data[:n] in rank_of_bytes), -1)
            for data in self.bytes_of
        ]
        self.compatible: dict[tuple[int, int], bool] = {}
        self.added = {token["content"]: token["id"] for token in stored["added_tokens"]}
        self.added_split = re.compile("|".join(map(re.escape, sorted(self.added, key=len, reverse=True)))) if self.added else None
        self._offset_table()

    def _offset_table(self) -> None:
        by_id = {self.id_of[at]: data for at, data in enumerate(self.bytes_of)}
        by_id |= {id_: content.encode() for content, id_ in self.added.items()}
        sizes = np.zeros(max(by_id) + 1, np.int64)
        for id_, data in by_id.items():
            sizes[id_] = len(data)
        self.offsets = np.concatenate([[0], np.cumsum(sizes)])
        self.blob = np.frombuffer(b"".join(by_id[id_] for id_ in sorted(by_id)), np.uint8)

    def fits(self, left: int, right: int) -> bool:
        """Whether the border between two tokens outlives the merges; remembered as the table of pairs."""
        known = self.compatible.get((left, right))
        if known is None:
            known = self.compatible[left, right] = self._fits(left, right)
        return known

    def _fits(self, left: int, right: int) -> bool:
        # Undo the latest merge on either side of the border, step by step: if at some step
        # the two tokens at the border could merge before that merge, they would have.
        merged, split = self.merged, self.split
        limit = len(split)
        while True:
            if (found := merged.get((left, right))) is not None and found < limit:
                return False
            if left > right:
                limit, left = left, split[left][1]
                if left == limit:
                    limit, right = right + 1, split[right][0]
                    if right + 1 == limit:
                        return True
            else:
                limit, right = right + 1, split[right][0]
                if right + 1 == limit:
                    limit, left = left, split[left][1]
                    if left == limit:
                        return True

    def encode_piece(self, data: bytes) -> list[int]:
        """Ids of one split of a text."""
        size = len(data)
        longest = [-1] * size
        reach = [0] * size
        for end, token in self.automaton.iter(data.decode("latin-1")):
            n = len(self.bytes_of[token])
            start = end + 1 - n
            if n > reach[start]:
                reach[start], longest[start] = n, token
        hopeful = bytearray(b"\x01") * (size + 1)
        tokens: list[int] = []
        at, token = 0, longest[0]
        bytes_of, shorter = self.bytes_of, self.shorter
        while at < size:
            last = tokens[-1] if tokens else -1
            while token >= 0:
                end = at + len(bytes_of[token])
                if hopeful[end] and (last < 0 or self.fits(last, token)):
                    tokens.append(token)
                    at = end
                    token = longest[at] if at < size else -1
                    break
                token = shorter[token]
            else:
                hopeful[at] = 0
                token = tokens.pop()
                at -= len(bytes_of[token])
        return [self.id_of[token] for token in tokens]

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of all tokens in a row, gathered through the offset table."""
        if not len(ids):
            return b""
        starts = self.offsets[ids]
        sizes = self.offsets[ids + 1] - starts
        ends = np.cumsum(sizes)
        places = np.arange(ends[-1]) + np.repeat(starts - (ends - sizes), sizes)
        return self.blob[places].tobytes()


class TextEncoder:
    """Whole texts to ids; splits seen before are looked up."""

    def __init__(self, path: str):
        self.bpe = ByteBpe(path)
        self.known: dict[str, bytes] = {}

    def encode(self, text: str) -> np.ndarray:
        bpe = self.bpe
        if not bpe.added_split or not bpe.added_split.search(text):
            return np.frombuffer(self._plain(text), "<u4")
        parts, at = [], 0
        for found in bpe.added_split.finditer(text):
            parts += [self._plain(text[at : found.start()]), np.uint32(bpe.added[found[0]]).tobytes()]
            at = found.end()
        return np.frombuffer(b"".join([*parts, self._plain(text[at:])]), "<u4")

    def _plain(self, text: str) -> bytes:
        splits = (_FULL if _OTHER.search(text) else _LATIN).findall(text)
        known = self.known
        try:
            return b"".join(map(known.__getitem__, splits))
        except KeyError:
            pass
        if len(known) > MEMORY:
            known.clear()
        for split in splits:
            if split not in known:
                known[split] = np.array(self.bpe.encode_piece(split.encode()), "<u4").tobytes()
        return b"".join(map(known.__getitem__, splits))

    def decode(self, ids: np.ndarray) -> str:
        return self.bpe.decode(np.asarray(ids, np.int64)).decode("utf-8", "replace")


_ENCODERS: dict[str, TextEncoder] = {}


def text_encoder(path: str) -> TextEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = TextEncoder(path)
    return _ENCODERS[path]


def encode_documents(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, ids): the token ids of every whole text. No shuffle."""
    path = path or default_path("byte_bpe_50k.json")

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = text_encoder(path)
        for batch in slices(batches, "text"):
            ids = [encoder.encode(text or "").astype(np.int32) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(encode, "doc_id long, ids array<int>")


def decode_documents(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, text) from (doc_id, ids)."""
    path = path or default_path("byte_bpe_50k.json")

    def decode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = text_encoder(path)
        for batch in batches:
            texts = [encoder.decode(np.array(ids or [], np.int64)) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(decode, "doc_id long, text string")


DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def round_trip(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Encode and decode every text in one pass: number of ids, and digests of the ids and of the decoded text."""
    path = path or default_path("byte_bpe_50k.json")

    def digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = text_encoder(path)
        for batch in slices(batches, "text"):
            counts, ids_digests, text_digests = [], [], []
            for text in batch.column("text").to_pylist():
                ids = encoder.encode(text or "")
                counts.append(len(ids))
                ids_digests.append(hashlib.sha256(",".join(map(str, ids.tolist())).encode()).hexdigest())
                text_digests.append(hashlib.sha256(encoder.decode(ids).encode()).hexdigest())
            columns = [pa.array(counts, pa.int64()), pa.array(ids_digests), pa.array(text_digests)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(digest, DIGESTS)
