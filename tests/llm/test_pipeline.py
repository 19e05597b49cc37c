import hashlib
import zlib

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
import zstandard
from tokenizers import Tokenizer

import __spark_entry__ as contract
import corpus_pipeline
from tallyhouse.llm.line_templates import line_dedup_sql
from tallyhouse.llm.oracle import ORACLE
from tallyhouse.llm.quality_rules import Rules, judge
from tests.llm.brute import bytes_gone, documents, ngram_components, prose, words
from tests.llm.test_native_scans import by_sql
from verification.compare import connect, differences

SMALL = "/root/testdata/sf0.001"


def test_every_operator_is_registered():
    names = set(contract.queries())
    assert "pipeline" in names
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1


@pytest.mark.parametrize("name", ORACLE)
def test_matches_sql(spark, name):
    assert differences(contract.queries()[name](spark, SMALL), connect(SMALL), contract.oracle_sql()[name]) == []


def test_pipeline_matches_brute_force(spark):
    table = pq.read_table(f"{SMALL}/documents.parquet").to_pydict()
    rows = dict(zip(table["doc_id"], table["text"]))
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    packer = zstandard.ZstdCompressor(level=3)
    stages = dict(corpus_pipeline.STAGES)

    def run(name):
        nonlocal docs
        docs = corpus_pipeline.staged(stages[name](spark, docs, SMALL), name)
        assert set(docs.columns) == {"doc_id", "text", "lang", "source", "n_chars"}
        return {r.doc_id: r.text for r in docs.collect()}

    rows = {i: t for i, t in rows.items() if judge(t, packer, Rules())[6]}
    assert run("quality_rules") == rows

    report = {r[0]: r for r in by_sql(list(rows.items()), line_dedup_sql())}
    after = run("line_dedup")
    assert {i for i, r in report.items() if r[2] == 0} <= set(after)
    assert {i: hashlib.sha256(t.encode()).hexdigest() for i, t in after.items()} == {i: report[i][1] for i in after}
    rows = after

    found = ngram_components(list(rows.items()), 5, 80)
    rows = {i: t for i, t in rows.items() if found[i][1] == i}
    assert run("ngram_join") == rows

    # Where a cut goes through a character, what is left of it goes too.
    expected = {}
    for i, data, gone in bytes_gone(list(rows.items())):
        left = bytes(b for b, g in zip(data, gone) if not g).decode("utf-8", "ignore") if any(gone) else rows[i]
        if not any(gone) or words(left):
            expected[i] = left
    rows = run("suffix_array_dedup")
    assert rows == expected

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    expected = set()
    for i, text in rows.items():
        ids = np.array(library.encode(text, add_special_tokens=False).ids + [1], "<u4")
        expected |= {(i, at // 4096, at, zlib.crc32(ids[at : at + 4096].tobytes())) for at in range(0, len(ids), 4096)}
    packed = corpus_pipeline.best_fit_packing(spark, docs, SMALL).collect()
    assert {(r.doc_id, r.piece, r.start, r.ids_crc32) for r in packed} == expected
    whole = corpus_pipeline.run(spark, SMALL)
    assert {(r.doc_id, r.piece, r.start, r.ids_crc32) for r in whole.collect()} == expected


def test_stages_take_odd_rows(spark):
    rows = [(1, None), (2, ""), (None, prose(1, 80)), (3, prose(2, 90)), (3, prose(2, 90)), (4, prose(2, 90)), (5, "x " * 9000)]
    for extra in ([], ["1 AS id", "2 AS key", "3 AS kept", "4 AS bucket", "5 AS component_id"]):
        for given in (rows, []):
            docs = documents(spark, given).selectExpr("*", *extra)
            for name, stage in corpus_pipeline.STAGES:
                result = stage(spark, docs, SMALL)
                if name != "best_fit_packing":
                    assert set(result.columns) == set(docs.columns)
                result.collect()
