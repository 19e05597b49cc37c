import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tallyhouse.llm.best_fit_packing import END_ID, pack_documents, places_of, plan_bins, sequences
from tallyhouse.llm.elias_fano import EliasFano, encode
from tallyhouse.llm.token_files import TokenFile, read_token_files, write_token_files
from tests.llm.brute import documents, prose

ROWS = [(5, "one two"), (3, None), (3, ""), (4, "same"), (4, "same"), (None, "lost"), (-7, prose(1, 3000)), (9, prose(2, 9000)), (10**12, "far")]


def library_ids(text):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    return np.array(library.encode(text or "", add_special_tokens=False).ids + [END_ID], "<u4")


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**63), max_size=700))
def test_elias_fano_round_trip(values):
    values.sort()
    read = EliasFano(encode(np.array(values, np.uint64)))
    assert read.all().tolist() == values
    assert [read.select(i) for i in range(len(values))] == values


def test_elias_fano_is_small():
    ends = np.cumsum(np.random.default_rng(1).integers(1, 1000, 100_000))
    assert len(encode(ends)) < 100_000 * 12 / 8 + 2000
    with pytest.raises(IndexError):
        EliasFano(encode(ends)).select(100_000)


def test_files_hold_all_documents_in_order(spark):
    docs = documents(spark, ROWS).withColumnRenamed("lang", "shard")
    stored = write_token_files(docs, files=3)
    got = sorted(read_token_files(stored, with_ids=True).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted([i for i, _ in ROWS], key=lambda i: (i is not None, i))
    assert got[0].start == 0
    assert all(a.start + a.n_tokens == b.start for a, b in zip(got, got[1:]))
    assert all(r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4")) for r in got)
    expected = sorted((i, library_ids(t).tolist()) for i, t in ROWS if i is not None)
    assert sorted((r.doc_id, r.ids) for r in got if r.doc_id is not None) == expected
    for row in stored.manifest.collect():
        file = TokenFile(stored.folder, row.file)
        at = len(file) - 1
        assert file.document(at).tolist()[-1] == END_ID


def test_empty_table(spark):
    assert read_token_files(write_token_files(documents(spark, []))).count() == 0
    assert pack_documents(documents(spark, [])).count() == 0


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=300))
def test_plan_uses_every_piece_once_and_few_bins(lengths):
    counts = {n: lengths.count(n) for n in set(lengths)}
    plan = plan_bins(counts, 64)
    used: dict[int, int] = {}
    for pattern in plan:
        assert sum(pattern.lengths) <= 64
        for n in pattern.lengths:
            used[n] = used.get(n, 0) + pattern.times
    assert used == counts
    assert len(places_of(plan).keys) >= len(counts)
    # Never more than first fit in falling order, which is within 11/9 of the best.
    bins: list[int] = []
    for n in sorted(lengths, reverse=True):
        spot = next((k for k, room in enumerate(bins) if room >= n), None)
        bins.append(64 - n) if spot is None else bins.__setitem__(spot, bins[spot] - n)
    assert sum(p.times for p in plan) <= len(bins) + 1


def test_two_for_one_fills_a_bin():
    # Greedy takes 60 and 3 and leaves 1 free; 2 + 2 fill the bin.
    assert any(sorted(p.lengths) == [2, 2, 60] for p in plan_bins({60: 1, 3: 1, 2: 2}, 64))


def test_packing_is_gapless_and_whole(spark):
    rows = [*ROWS, *[(1000 + k, prose(k, k % 37)) for k in range(300)]]
    got = pack_documents(documents(spark, rows).withColumnRenamed("lang", "offset"), capacity=256, ids=True)
    pieces = got.collect()
    by_sequence: dict[int, list] = {}
    for r in pieces:
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for members in by_sequence.values():
        place = 0
        for r in sorted(members, key=lambda r: r.offset):
            assert r.offset == place
            place += r.length
        assert place <= 256
    total = sum(r.length for r in pieces)
    assert len(by_sequence) <= -(-total // 256) + 1
    whole: dict = {}
    for r in sorted(pieces, key=lambda r: (str(r.doc_id), r.piece)):
        assert r.start == r.piece * 256 and r.ids_crc32 == zlib.crc32(r.ids)
        whole.setdefault(r.doc_id, []).append(np.frombuffer(r.ids, "<u4"))
    single = {i: library_ids(t) for i, t in rows if [x for x, _ in rows].count(i) == 1}
    assert all(np.array_equal(np.concatenate(whole[i]), ids) for i, ids in single.items())
    joined = {r.sequence_id: r for r in sequences(got).collect()}
    assert sum(r.length for r in joined.values()) == total
    assert all(len(r.ids) == 4 * r.length for r in joined.values())
