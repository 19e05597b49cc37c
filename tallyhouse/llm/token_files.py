"""Token ids as binary files: one concatenated id array and Elias-Fano document boundaries per file.

Documents are ranged by `doc_id`, so file after file holds them in ascending order. A
task streams its ids to a file of its own name in the shared folder and returns one
manifest row; Spark commits the manifest as a Parquet table. A task that is repeated
after a lost executor writes a new file, and only the one in the manifest is ever read.

File: magic, bytes per id, number of ids, lengths of three blocks, then the ids (16 bits
each when the vocabulary allows it), boundaries, document ids (as distances from the
smallest), both Elias-Fano coded.

Defined results: null and empty texts are one end id; equal `doc_id`s stand beside each
other, ordered by a hash of the text; rows without `doc_id` come first; other columns
are ignored; an empty table gives an empty manifest.
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.llm._shared import scratch, shuffle_width, slices
from tallyhouse.llm.elias_fano import EliasFano, encode
from tallyhouse.llm.word_tokens import default_path, word_encoder

END_ID = 1
_MAGIC = b"TOKIDS01"
#: magic, bytes per id, ids, rows without doc_id, smallest doc_id, bytes of boundaries and of doc_ids
_HEAD = "<8sBQQqQQ"
MANIFEST = "shard int, file string, n_docs long, n_tokens long"


class TokenFiles(NamedTuple):
    """Where the files are, and one row per file: (shard, file, n_docs, n_tokens)."""

    folder: str
    manifest: DataFrame


def _open(folder: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (pafs.LocalFileSystem(), folder)


def write_token_files(docs: DataFrame, path: str | None = None, files: int | None = None) -> TokenFiles:
    """Encode all documents and write them in ascending `doc_id` order. One shuffle, of texts."""
    spark = docs.sparkSession
    path, folder = path or default_path(), scratch(spark, "token-files")

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder = word_encoder(path)
        kind = np.dtype("<u2" if encoder.vocabulary <= 1 << 16 else "<u4")
        ends, doc_ids, shard, total, out = [], [], None, 0, None
        name = f"ids-{uuid.uuid4().hex}.bin"
        for batch in slices(batches, "text"):
            if out is None:
                files_, root = _open(folder)
                files_.create_dir(root, recursive=True)
                out = files_.open_output_stream(f"{root}/{name}")
                shard = batch.column("shard")[0].as_py()
            block = []
            for text in batch.column("text").to_pylist():
                ids = np.append(encoder.encode(text or ""), np.uint32(END_ID)).astype(kind)
                total += len(ids)
                ends.append(total)
                block.append(ids.tobytes())
            doc_ids.extend(batch.column("doc_id").to_pylist())
            out.write(b"".join(block))
        if out is None:
            return
        nulls = doc_ids.count(None)
        known = doc_ids[nulls:]
        smallest = known[0] if known else 0
        bounds = encode(np.array(ends, np.uint64))
        names = encode(np.array([doc_id - smallest for doc_id in known], np.uint64))
        out.write(bounds + names)
        out.write(struct.pack(_HEAD, _MAGIC, kind.itemsize, total, nulls, smallest, len(bounds), len(names)))
        out.close()
        row = [[shard], [name], [len(ends)], [total]]
        kinds = [pa.int32(), pa.string(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row, kinds)], ["shard", "file", "n_docs", "n_tokens"])

    ordered = (
        docs.selectExpr("cast(doc_id as long) doc_id", "text")
        .withColumn("tie", F.xxhash64("text"))
        .repartitionByRange(files or shuffle_width(docs), "doc_id", "tie")
        .sortWithinPartitions("doc_id", "tie")
        .select("doc_id", "text", F.spark_partition_id().alias("shard"))
    )
    manifest = f"{folder}/manifest"
    ordered.mapInArrow(write, MANIFEST).write.parquet(manifest)
    return TokenFiles(folder, spark.read.schema(MANIFEST).parquet(manifest))


class TokenFile:
    """One file, read in pieces: `document(i)` seeks by two selects; `blocks` streams all documents."""

    def __init__(self, folder: str, name: str):
        files, root = _open(folder)
        self.file = files.open_input_file(f"{root}/{name}")
        self.file.seek(self.file.size() - struct.calcsize(_HEAD))
        magic, width, self.n_tokens, self.nulls, self.smallest, n_bounds, n_names = struct.unpack(_HEAD, self.file.read(struct.calcsize(_HEAD)))
        if magic != _MAGIC:
            raise ValueError(f"{name} is no token file")
        self.kind = np.dtype(f"<u{width}")
        self.file.seek(self.n_tokens * width)
        self.bounds = EliasFano(self.file.read(n_bounds))
        self._names = EliasFano(self.file.read(n_names))

    def __len__(self) -> int:
        return len(self.bounds)

    def doc_ids(self) -> list[int | None]:
        return [None] * self.nulls + [self.smallest + int(step) for step in self._names.all()]

    def _ids(self, start: int, end: int) -> np.ndarray:
        self.file.seek(start * self.kind.itemsize)
        return np.frombuffer(self.file.read((end - start) * self.kind.itemsize), self.kind)

    def document(self, i: int) -> np.ndarray:
        """Token ids of the i-th document of the file."""
        return self._ids(self.bounds.select(i - 1) if i else 0, self.bounds.select(i))

    def blocks(self, most: int = 1 << 20) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(first document, its and its followers' boundaries, their ids), of about `most` ids each."""
        ends = np.concatenate([[0], self.bounds.all().astype(np.int64)])
        at = 0
        while at < len(ends) - 1:
            to = max(at + 1, int(np.searchsorted(ends, ends[at] + most, "right")) - 1)
            yield at, ends[at : to + 1], self._ids(int(ends[at]), int(ends[to]))
            at = to


def read_token_files(stored: TokenFiles, with_ids: bool = False) -> DataFrame:
    """One row per document from the files: doc_id, start, n_tokens, ids_crc32 and, if asked, the ids.

    `start` counts the ids of all documents before it in all files: the number before the
    file comes from adding up the manifest, which has one row per file.
    """
    folder = stored.folder
    fields = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<int>" if with_ids else "")

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, before in zip(batch.column("file").to_pylist(), batch.column("before").to_pylist()):
                yield from rows_of(TokenFile(folder, name), before)

    def rows_of(file: TokenFile, before: int) -> Iterator[pa.RecordBatch]:
        doc_ids = file.doc_ids()
        for at, ends, ids in file.blocks():
            wide = ids.astype("<u4")
            parts = [wide[a - ends[0] : b - ends[0]] for a, b in zip(ends[:-1], ends[1:])]
            columns = [
                pa.array(doc_ids[at : at + len(parts)], pa.int64()),
                pa.array(before + ends[:-1], pa.int64()),
                pa.array(np.diff(ends), pa.int64()),
                pa.array([zlib.crc32(part) for part in parts], pa.int64()),
            ]
            if with_ids:
                columns.append(pa.array([part.astype(np.int32) for part in parts], pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, [field.split()[0] for field in fields.split(", ")])

    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    before = stored.manifest.select("shard", "file", F.coalesce(F.sum("n_tokens").over(earlier), F.lit(0)).alias("before"))
    spread = before.repartition(shuffle_width(before), "file")
    return spread.mapInArrow(read, fields)
