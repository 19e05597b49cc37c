import hashlib
import struct

import zstandard

from tallyhouse.llm.warc import read_archives, read_records, write_archives
from tests.llm.brute import prose

PAGES = "page_id long, url string, html string"
LONG = "<html>" + prose(1, 60) + "</html>"


def pages(spark, rows):
    return spark.createDataFrame(rows, PAGES)


def test_round_trip_and_revisits(spark):
    rows = [(5, "http://a/5", LONG), (2, "http://a/2", LONG), (9, None, LONG), (9, None, LONG), (None, "u", LONG), (3, "x\r\ny", None),
            (4, "", ""), (6, "é", "short"), (7, "", "short"), (8, "h", "ü" * 50), (11, "h", "ü" * 50), (12, "h", "x" * 99), (13, "h", "x" * 99),
            (20, "long", prose(2, 60_000)), *[(100 + k, f"http://b/{k}", f"<p>{prose(k, 80)}</p>\r\n\r\nWARC/1.1\r\n") for k in range(200)]]
    got = {}
    for r in read_archives(write_archives(pages(spark, rows)), payloads=True).collect():
        got.setdefault(r.page_id, []).append(r)
    assert sum(map(len, got.values())) == len(rows)
    for page_id, _, html in rows:
        for r in got[page_id]:
            data = (html or "").encode()
            assert (r.payload_bytes, r.payload_digest) == (len(data), hashlib.sha256(data).hexdigest())
            assert r.record_type == ("revisit" if r.refers_to is not None else "response")
            assert r.record_type == "revisit" or r.payload == data
    kinds = {i: {(r.record_type, r.refers_to) for r in rs} for i, rs in got.items()}
    assert kinds[2] == {("response", None)} and kinds[5] == kinds[9] == kinds[None] == {("revisit", 2)}
    assert kinds[11] == {("revisit", 8)} and kinds[13] == kinds[7] == {("response", None)}


def test_archives_carry_their_dictionary(spark):
    rows = [(k, f"http://b/{k}", f"<html><body class='page'><p>{prose(k, 80)}</p></body></html>") for k in range(400)]
    stored = write_archives(pages(spark, rows).coalesce(1))
    first = stored.manifest.first()
    path = f"{stored.folder}/{first.file}".removeprefix("file:").replace("///", "/")
    with open(path, "rb") as file:
        data = file.read()
        file.seek(0)
        assert len(list(read_records(file))) == first.records
    magic, size = struct.unpack("<II", data[:8])
    assert magic == 0x184D2A5D
    plain = sum(len(zstandard.ZstdCompressor(level=3).compress(r[2].encode())) for r in rows)
    assert size > 0 and len(data) - size - 8 < plain


def test_empty_table_and_extra_columns(spark):
    assert read_archives(write_archives(pages(spark, []))).count() == 0
    extra = pages(spark, [(1, "u", "x")]).selectExpr("*", "1 AS digest", "2 AS salt", "3 AS payload")
    assert read_archives(write_archives(extra)).count() == 1
