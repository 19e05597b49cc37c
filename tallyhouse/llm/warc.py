"""WARC archives of pages, each record its own Zstandard frame with a dictionary built from the records.

A task gathers records up to a documented sample size, trains a dictionary on them,
writes it in a skippable frame at the head of its archive and then compresses every
record by itself, so a reader can start at any record once it has the dictionary.

Of pages with equal payloads of at least `MIN_REVISIT` bytes, that with the smallest
`page_id` is written as a response and the others as revisits to it. Archives go to the
shared folder under names of their own; Spark commits a manifest of them, and only
archives in the manifest are read, so tasks repeated after a loss leave no doubles.

Defined results: null html is an empty payload; rows that repeat a `page_id` with the
same payload are all responses; a null `page_id` never counts as smallest unless all are
null; a null url is left out; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import io
import struct
import uuid
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm._shared import scratch, shuffle_width, slices

MIN_REVISIT = 100
#: Records a dictionary is trained on: the first of each archive up to this many bytes.
SAMPLE_BYTES = 4 << 20
DICTIONARY_BYTES = 64 << 10
DATE = "2024-01-01T00:00:00Z"
_SKIPPABLE = 0x184D2A5D
_READ = 64 << 10
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


class Archives(NamedTuple):
    """Where the archives are, and one row per archive: (file, records)."""

    folder: str
    manifest: DataFrame


def classify(pages: DataFrame) -> DataFrame:
    """Pages with payload digest, and the smallest page of equal long payloads.

    Digests are grouped first, with partial aggregation in the map tasks; only digests
    that occur more than once go on. A digest that a third of all pages share is dealt
    over salted copies of its one row.
    """
    spread = min(64, shuffle_width(pages))
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = pages.selectExpr("cast(page_id as long) page_id", "url", "html").select(
        "page_id", "url", payload.alias("payload"), F.sha2(payload, 256).alias("digest")
    )
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("page_id"), F.lit(spread)).cast("int"))
    shared = (
        rows.where(F.octet_length("payload") >= MIN_REVISIT)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first_page"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select("digest", "first_page", F.explode(F.sequence(F.lit(0), F.lit(spread - 1))).alias("salt"))
    )
    return rows.join(shared, ["digest", "salt"], "left").select(
        "page_id",
        "url",
        "payload",
        "digest",
        F.when(F.col("first_page") != F.col("page_id"), F.col("first_page"))
        .otherwise(F.when(F.col("page_id").isNull(), F.col("first_page")))
        .alias("refers_to"),
    )


def _record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}')}>"


def _record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC record: headers, blank line, block, two blank lines."""
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_record_id(page_id)}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha256:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if page_id is not None:
        lines.append(f"X-Page-ID: {page_id}")
    if url is not None:
        clean = "".join(url.splitlines()).strip()
        lines.append(f"WARC-Target-URI: {clean}")
    if revisit:
        lines += [f"WARC-Profile: {_REVISIT}", f"WARC-Refers-To: {_record_id(refers_to)}", f"X-Refers-To-Page-ID: {refers_to}"]
    return "\r\n".join(lines).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def _train(sample: list[bytes]) -> zstandard.ZstdCompressionDict | None:
    """A dictionary from these records; too few or too small ones give none."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, sample)
    except zstandard.ZstdError:
        return None


def _open(folder: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (pafs.LocalFileSystem(), folder)


def write_archives(pages: DataFrame, level: int = 3) -> Archives:
    """Write every page into an archive."""
    folder = scratch(pages.sparkSession, "warc")

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, records, out, packer, sample, held = f"pages-{uuid.uuid4().hex}.warc.zst", 0, None, None, [], 0

        def begin() -> tuple[pa.NativeFile, zstandard.ZstdCompressor]:
            files, root = _open(folder)
            files.create_dir(root, recursive=True)
            stream, dictionary = files.open_output_stream(f"{root}/{name}", compression=None), _train(sample)
            if dictionary is None:
                return stream, zstandard.ZstdCompressor(level=level)
            data = dictionary.as_bytes()
            stream.write(struct.pack("<II", _SKIPPABLE, len(data)) + data)
            return stream, zstandard.ZstdCompressor(level=level, dict_data=dictionary)

        for batch in slices(batches, "payload"):
            for row in batch.to_pylist():
                record = _record(row["page_id"], row["url"], row["payload"], row["digest"], row["refers_to"])
                records += 1
                if out is None:
                    sample.append(record)
                    held += len(record)
                    if held >= SAMPLE_BYTES:
                        out, packer = begin()
                        out.write(b"".join(map(packer.compress, sample)))
                        sample = []
                else:
                    out.write(packer.compress(record))
        if not records:
            return
        if out is None:
            out, packer = begin()
            out.write(b"".join(map(packer.compress, sample)))
        out.close()
        yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([records], pa.int64())], ["file", "records"])

    manifest = f"{folder}/manifest"
    classify(pages).mapInArrow(write, "file string, records long").write.parquet(manifest)
    return Archives(folder, pages.sparkSession.read.schema("file string, records long").parquet(manifest))


def _frames(source: io.RawIOBase, unpacker: zstandard.ZstdDecompressor) -> Iterator[bytes]:
    """Each frame, that is each record, unpacked."""
    pending = source.read(_READ)
    while pending:
        frame, parts = unpacker.decompressobj(), []
        while not frame.eof:
            if not pending:
                raise ValueError("the archive ends within a record")
            parts.append(frame.decompress(pending))
            pending = frame.unused_data or source.read(_READ)
        yield b"".join(parts)


def read_records(source: io.RawIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record of one archive, one after the other."""
    head = source.read(8)
    unpacker = zstandard.ZstdDecompressor()
    if len(head) == 8 and struct.unpack("<II", head)[0] == _SKIPPABLE:
        dictionary = zstandard.ZstdCompressionDict(source.read(struct.unpack("<II", head)[1]))
        unpacker = zstandard.ZstdDecompressor(dict_data=dictionary)
    else:
        source.seek(0)
    for record in _frames(source, unpacker):
        top, _, rest = record.partition(b"\r\n\r\n")
        version, *lines = top.decode("utf-8", "surrogatepass").split("\r\n")
        if version != "WARC/1.1":
            raise ValueError("no WARC record where one should begin")
        headers = dict(line.split(": ", 1) for line in lines)
        yield headers, rest[: int(headers["Content-Length"])]


RESULT = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def read_archives(archives: Archives, payloads: bool = False) -> DataFrame:
    """One row per record. A response's payload is digested anew and must match its header."""
    folder = archives.folder
    fields = RESULT + (", payload binary" if payloads else "")
    names = [field.split()[0] for field in fields.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()][: len(names)]

    def parse(headers: dict[str, str], block: bytes) -> tuple:
        head, _, payload = block.partition(b"\r\n\r\n")
        size = int(head.rpartition(b"Content-Length: ")[2])
        digest = headers["WARC-Payload-Digest"].removeprefix("sha256:")
        kind = headers["WARC-Type"]
        if kind == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
            raise ValueError(f"record {headers['WARC-Record-ID']} is damaged")
        page, refers = headers.get("X-Page-ID"), headers.get("X-Refers-To-Page-ID")
        row = (page and int(page), size, digest, kind, refers and int(refers))
        return (*row, payload) if payloads else row

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = _open(folder)
        for batch in batches:
            for name in batch.column("file").to_pylist():
                rows, held = [], 0
                with files.open_input_file(f"{root}/{name}") as source:
                    for headers, block in read_records(source):
                        rows.append(parse(headers, block))
                        held += len(block) * payloads + 200
                        if held > 4 << 20:
                            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*rows), kinds)], names)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*rows), kinds)], names)

    spread = archives.manifest.repartition(shuffle_width(archives.manifest), "file")
    return spread.mapInArrow(read, fields)
