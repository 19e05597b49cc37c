"""N-gram join, suffix arrays and the flat graph against brute force."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallyhouse.llm import ngram_join, suffix_dedup as suffixes
from tallyhouse.llm._shared import BATCH_BYTES, staged
from tallyhouse.llm.components import components
from tallyhouse.llm import flat_graph
from tallyhouse.llm.flat_graph import Graph, Mutual, audit_recall, near_duplicates
from tallyhouse.llm.ngram_join import trie_links
from tallyhouse.llm.suffix_dedup import Repeats, maximal_repeats, suffix_array, suffix_dedup
from tests.llm.brute import documents, ngram_components, prose, repeated_bytes


def edited(text: str, seed: int, edits: int) -> str:
    draw = random.Random(seed)
    found = text.split(" ")
    for _ in range(edits):
        found[draw.randrange(len(found))] = f"e{draw.randrange(10**6)}"
    return " ".join(found)


def families() -> list[tuple]:
    rows = [(1, None), (2, ""), (3, " \n"), (4, "Only Three Words"), (5, "only three  words"), (6, "only three word")]
    for family in range(12):
        base = prose(family, 30 + 25 * family)
        for copy in range(8):
            rows.append((100 + 10 * family + copy, edited(base, copy, copy * (1 + family // 4))))
    passage = prose(77, 60)
    rows += [(500 + k, prose(500 + k, 40 + k) + " " + passage + " " + prose(900 + k, 30)) for k in range(30)]
    rows += [(700 + k, " ".join(f"t{j}" for j in range(k + 1))) for k in range(40)]  # each a little longer than the last
    return rows + [(900, prose(3, 20_000)), (901, edited(prose(3, 20_000), 1, 300)), (902, "x " * 5000), (903, "X " * 5000)]


@pytest.mark.parametrize(("block", "hot"), [(2_000_000, 16), (900, 16), (2_000_000, 2), (2_000_000, 1)])
def test_ngram_components_match_brute_force(spark, monkeypatch, block, hot):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    monkeypatch.setattr(ngram_join, "HOT", hot)
    rows = families()
    docs = documents(spark, rows).withColumnRenamed("lang", "component_id").repartition(5)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.ngram_components(docs).collect()}
    assert got == ngram_components(rows)


def test_ngram_rows_without_id_or_repeated(spark):
    rows = [(None, "a b c d e"), (None, None), (2, "a b c d e"), (2, "a b c d e"), (7, "A B c d e"), (9, "z")]
    got = sorted((tuple(r) for r in ngram_join.ngram_components(documents(spark, rows)).collect()), key=repr)
    assert got == sorted([(None, 2, None), (None, 0, None), (2, 2, 2), (2, 2, 2), (7, 2, 2), (9, 1, 9)], key=repr)
    assert ngram_join.ngram_components(documents(spark, [])).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_trie_finds_every_component(seed):
    draw = np.random.default_rng(seed)
    base = draw.integers(0, 300, 60)
    sets = [np.unique(np.where(draw.random(60) < draw.random() * 0.2, draw.integers(0, 600, 60), base)).astype(np.uint64) for _ in range(80)]
    sets = list({s.tobytes(): s for s in sets}.values())
    up = list(range(len(sets)))

    def root(a):
        while up[a] != a:
            a = up[a]
        return a

    def groups(links):
        up[:] = range(len(sets))
        for a, b in links:
            up[root(a)] = root(b)
        return {frozenset(x for x in range(len(sets)) if root(x) == root(y)) for y in range(len(sets))}

    true = []
    for a in range(len(sets)):
        for b in range(a):
            o = len(np.intersect1d(sets[a], sets[b]))
            if 100 * o >= 85 * (len(sets[a]) + len(sets[b]) - o):
                true.append((a, b))
    assert groups(trie_links(sets, 85)) == groups(true)


def test_components_of_chains_and_stars(spark):
    edges = [(k, k + 1) for k in range(100, 140)] + [(500, k) for k in range(501, 560)] + [(7, 3), (3, 7), (3, 3), (9, 9)]
    found = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert found == {**{k: 100 for k in range(100, 141)}, **{k: 500 for k in range(500, 560)}, 3: 3, 7: 3}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def repeats() -> list[tuple]:
    draw = random.Random(2)
    rows = [(1, None), (2, ""), (3, "short"), (4, "ab" * 300), (5, "ab" * 40), (6, "ba" * 60), (None, "ab" * 300)]
    passage = prose(5, 25)
    for k in range(40):
        rows.append((10 + k, f"{prose(k, draw.randrange(60), 9)} {passage[draw.randrange(30):]} {'é日' * draw.randrange(20)}"))
    rows += [(200 + k, prose(3, 50)) for k in range(6)] + [(300, prose(1, 20_000)), (299, prose(1, 20_000)[50_000:50_060])]
    # One doc_id with several texts: each is cut at its own places only.
    rows += [(500, text) for text in (prose(1, 300), prose(77, 60), prose(78, 20) + passage, f"{passage[:90]}{prose(79, 30)}")]
    return rows + [(400, "\0" * 200), (401, "\0" * 120), (9, prose(99, 40)), (9, prose(99, 40))]


@pytest.mark.parametrize("group", [20_000, 2])
def test_removed_bytes_match_brute_force(spark, group):
    rows = repeats()
    docs = documents(spark, rows).withColumnRenamed("lang", "spans").repartition(4)
    got = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup(docs, Repeats(group=group)).collect()]
    assert sorted(got, key=repr) == sorted(repeated_bytes(rows), key=repr)


def test_texts_longer_than_a_stretch(spark, monkeypatch):
    rows = [(1, prose(1, 3000)), (2, prose(2, 500) + prose(1, 3000)[3000:9000] + prose(4, 300)), (3, prose(1, 3000)[:500])]
    import tallyhouse.llm.suffix_dedup as module

    pieces = {}
    for stretch in (1000, 2 << 20):
        monkeypatch.setattr(module, "_STRETCH", stretch)
        import pyarrow as pa

        batch = pa.RecordBatch.from_pydict({"text": [t for _, t in rows]})
        pieces[stretch] = sum(len(pieces_) for pieces_ in ([w for w in module.pieces_of(d, e, Repeats())[1]] for d, e, _, _ in module._stretches(batch, 50)))
        windows = sum(int(module.pieces_of(d, e, Repeats())[1].sum()) for d, e, _, _ in module._stretches(batch, 50))
        assert windows == sum(len(t.encode()) - 49 for _, t in rows)
    assert pieces[1000] >= pieces[2 << 20]


def test_suffix_dedup_of_nothing_and_its_text(spark):
    assert suffix_dedup(documents(spark, [])).count() == 0
    found = {r.doc_id: r for r in suffix_dedup(documents(spark, [(2, "A" + prose(1, 20)), (1, prose(1, 20) + "B")]), with_text=True).collect()}
    assert bytes(found[2].kept) == b"A" and found[2].spans[0].start == 1 and found[1].n_removed == 0


@pytest.mark.parametrize("seed", range(4))
def test_maximal_repeats_of_a_suffix_array(seed):
    draw = random.Random(seed)
    texts = ["".join(draw.choice("ab") for _ in range(40)) for _ in range(5)]
    blob = np.frombuffer("".join(texts).encode(), np.uint8)
    sizes, width = np.full(5, 40), 6
    array = suffix_array(np.zeros(5, np.int64), sizes, blob, width)
    found = {}
    for length, low, high in maximal_repeats(array, width):
        places = frozenset(zip(array.piece[low:high].tolist(), array.offset[low:high].tolist()))
        strings = {texts[p][o : o + length] for p, o in places}
        assert len(strings) == 1
        found[strings.pop()] = places
    expected = {}
    strings = {t[a : a + n] for t in texts for n in range(width, 41) for a in range(41 - n)}
    for s in strings:
        places = frozenset((p, a) for p, t in enumerate(texts) for a in range(41 - len(s)) if t.startswith(s, a))
        left = {texts[p][a - 1] if a else p - 9 for p, a in places}
        right = {texts[p][a + len(s)] if a + len(s) < 40 else p - 9 for p, a in places}
        if len(places) > 1 and len(left) > 1 and len(right) > 1:
            expected[s] = places
    # A suffix at the start of its piece counts as unlike any other on its left.
    assert expected.items() <= found.items()


def clusters(seed: int, count: int) -> np.ndarray:
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(count // 8, 24))
    noise = draw.normal(size=(count, 24)) * draw.choice([0.02, 0.1, 0.3], (count, 1))
    return (centres[draw.integers(0, len(centres), count)] + noise).astype(np.float32)


def test_flat_graph_matches_brute_force(spark):
    vectors = clusters(1, 3000)
    vectors[100:160] = vectors[100]
    odd = [None, [], [0.0] * 24, [None] * 24, [float("nan")] * 24, [float("inf")] + [1.0] * 23, [1.0, 2.0], [2.0, 4.0], [3e38] * 24, [1e-38] * 24]
    rows = [(k, v.tolist(), 0) for k, v in enumerate(vectors)] + [(5000 + k, v, 1) for k, v in enumerate(odd)] + [(None, [1.0] * 24, 1)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, n_links int")
    got = {r.vec_id: r for r in near_duplicates(table, Graph(shard=1000, leaf=200)).collect()}
    assert len(got) == len(rows)
    units = vectors.astype(np.float64) / np.linalg.norm(vectors.astype(np.float64), axis=1, keepdims=True)
    exact = (units @ units.T >= 0.95).sum(axis=1) - 1
    found = np.array([got[k].n_links for k in range(3000)])
    assert (found <= exact).all() and found.sum() >= 0.98 * exact.sum()
    assert all(got[k].kept == (got[k].component_id == k) for k in range(3000))
    assert [got[5000 + k].n_links for k in range(10)] == [0, 0, 0, 0, 0, 0, 1, 1, 1, 1]
    assert got[5007].component_id == 5006 and got[5009].component_id == 5008
    assert (got[None].n_links, got[None].component_id, got[None].kept) == (0, None, False)


def test_flat_graph_of_nothing(spark):
    assert near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
    only = spark.createDataFrame([(1, [0.0, 0.0]), (2, None)], "vec_id long, embedding array<float>")
    assert [r.n_links for r in near_duplicates(only).collect()] == [0, 0]


def test_audit_sees_missed_pairs_beside_a_large_group(spark):
    draw = np.random.default_rng(3)
    group = draw.normal(size=24) + 0.01 * draw.normal(size=(300, 24))
    pairs = np.repeat(draw.normal(size=(100, 24)), 2, axis=0) + 0.01 * draw.normal(size=(200, 24))
    vectors = np.concatenate([group, pairs])
    classes = spark.createDataFrame([(k, 1, v.tolist()) for k, v in enumerate(vectors)], "node long, weight long, embedding array<double>")
    found = spark.createDataFrame([("links", k, 299) for k in range(300)], "kind string, a long, b long")
    assert audit_recall(classes, found, Graph()) == 0.0
    whole = found.union(spark.createDataFrame([("links", k, 1) for k in range(300, 500)], found.schema))
    assert audit_recall(classes, whole, Graph()) == 1.0


def test_no_result_below_the_least_recall(spark, monkeypatch):
    monkeypatch.setattr(flat_graph, "audit_recall", lambda *_: 0.5)
    table = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.1])], "vec_id long, embedding array<float>")
    with pytest.raises(RuntimeError, match="recall 0.500"):
        near_duplicates(table)


def test_links_count_from_both_sides(spark):
    vectors = clusters(4, 2000)
    table = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(vectors)], "vec_id long, embedding array<float>")
    # With one shard per vector and next to it only a few guests, one side often does not see the other.
    graph = Graph(shard=100, leaf=50, overlap=2, tries=1, least_recall=0.0)
    units = flat_graph.unit(vectors)
    near = units @ units.T >= 0.95
    np.fill_diagonal(near, False)
    drawn = table.orderBy(flat_graph.F.xxhash64("vec_id")).select("embedding").toArrow()
    centres = flat_graph.fit_centres(flat_graph.unit(flat_graph._matrix(drawn.column("embedding").combine_chunks())), 40)
    shards = flat_graph.nearest_centres(units, centres, 2)
    sees = (shards[None, :, :] == shards[:, :1, None]).any(axis=2)  # y is in the home shard of x
    met = near & (sees | sees.T)
    assert (near & sees).sum() < met.sum()
    got = {r.vec_id: r.n_links for r in near_duplicates(table, graph).collect()}
    found = np.array([got[k] for k in range(2000)])
    assert (found <= met.sum(axis=1)).all() and found.sum() > (near & sees).sum()


def test_mutual_links_count_once():
    home = np.array([True, False, True, True])
    mutual = Mutual(home)
    mutual.add(0, np.array([1, 2]))
    mutual.add(2, np.array([0]))
    mutual.add(3, np.array([0]))
    assert mutual.links(np.array([1, 5, 10, 100])).tolist() == [110, 0, 1, 1]


def test_a_large_shard_is_cut_into_blocks(spark):
    draw = np.random.default_rng(5)
    tight = draw.normal(size=24) + 0.02 * draw.normal(size=(600, 24))
    vectors = np.concatenate([tight, clusters(6, 600)]).astype(np.float32)
    table = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(vectors)], "vec_id long, embedding array<float>")
    got = {r.vec_id: r for r in near_duplicates(table, Graph(shard=300, leaf=100, most=300)).collect()}
    units = flat_graph.unit(vectors)
    exact = (units @ units.T >= 0.95).sum(axis=1) - 1
    found = np.array([got[k].n_links for k in range(len(vectors))])
    assert (found <= exact).all() and found.sum() >= 0.98 * exact.sum()
    assert {got[k].component_id for k in range(600)} == {0}


def test_every_pair_of_a_cut_shard_meets_in_one_small_task():
    near, blocks = np.zeros((900, 1), np.int32), np.array([6])
    rows, shard, low, high, block = flat_graph.deal(near, np.arange(900), blocks)
    tasks = {}
    for row, one, two, own in zip(rows.tolist(), low.tolist(), high.tolist(), block.tolist()):
        tasks.setdefault((one, two), []).append((row, own))
    assert len(tasks) == 21 and max(map(len, tasks.values())) <= 400
    met = np.zeros((900, 900), int)
    for (one, two), members in tasks.items():
        for row, own in members:
            others = [r for r, o in members if r != row and (one == two or o != own)]
            met[row, others] += 1
    assert (met + np.eye(900, dtype=int) == 1).all()


def test_agreements_are_added_up_before_they_become_rows(spark, monkeypatch):
    """Documents that only share a passage in pairs make no row for the parts they agree on."""
    from tallyhouse.llm import ngram_join

    draw = random.Random(5)
    text = lambda n: " ".join(f"w{draw.randrange(10**9)}" for _ in range(n))
    texts = []
    for _ in range(40):
        passage = text(40)
        texts += [f"{text(60)} {passage}", f"{passage} {text(60)}"]
    body = text(120).split()
    texts += [" ".join(body), " ".join([*body[:-2], "other", "end"])]
    seen = []
    unpacked = ngram_join._unpacked
    monkeypatch.setattr(ngram_join, "_unpacked", lambda packed, width: seen.append((width, unpacked(packed, width))) or seen[-1][1])
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {row["doc_id"]: row["component_id"] for row in ngram_join.ngram_components(docs).collect()}
    assert found == {**{i: i for i in range(80)}, 80: 80, 81: 80}
    assert sum(df.count() for width, df in seen if width == 4) <= 4  # the one near pair, at most at every two levels


class Caught:
    """Stands for a table and keeps the function that its partitions would go through."""

    def sortWithinPartitions(self, column):
        return self

    def mapInArrow(self, function, schema):
        self.function = function
        return self


def _pieces(bucket, n):
    piece = np.zeros(n, suffixes.PIECE)
    piece["h"], piece["doc"], piece["n"] = np.arange(n), np.arange(n) % 1000, 5
    names = np.zeros(1000, suffixes.ROW)
    names["doc"] = np.arange(1000)
    row = {"bucket": [bucket], "pieces": [piece.tobytes()], "docs": [names.tobytes()], "marks": [b""]}
    return pa.RecordBatch.from_pydict(row, pa.schema([("bucket", pa.int32()), *[(k, pa.binary()) for k in ("pieces", "docs", "marks")]]))


def _keys(bucket, n):
    keys = (np.arange(n, dtype=np.uint64) + np.uint64(bucket * n)).tobytes()
    row = {"bucket": [bucket], "keys": [keys], "places": [(np.arange(n) % 1000).astype("<u2").tobytes()]}
    row |= {"docs": [np.arange(1000).astype("<i8").tobytes()], "facts": [b""]}
    kinds = [("keys", pa.binary()), ("places", pa.binary()), ("docs", pa.binary()), ("facts", pa.binary())]
    return pa.RecordBatch.from_pydict(row, pa.schema([("bucket", pa.int32()), *kinds]))


@pytest.mark.parametrize(
    "meet, rows",
    [(lambda table: suffixes._meet(table, Repeats(), 8), _pieces), (lambda table: ngram_join._meet(table, 8), _keys)],
)
def test_a_task_holds_one_bucket_at_a_time(meet, rows):
    function = meet(Caught()).function

    def most_held(buckets):
        tracemalloc.start()
        for _ in function(rows(b, 30_000) for b in range(buckets)):
            pass
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return most

    most_held(1)
    assert most_held(16) < 2 * most_held(2)


def test_filed_pieces_leave_a_bounded_number_at_a_time():
    rng = np.random.default_rng(5)
    texts = ["".join(map(chr, rng.integers(97, 123, 50_000))) for _ in range(120)]
    n = len(texts)
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(n), pa.int64()), "key": pa.array(range(n), pa.int64()), "text": texts})
    out = list(suffixes._file(Caught(), Repeats(), 64).function([batch]))
    assert sum(b.num_rows for b in out) == 64 and max(b.nbytes for b in out) < 2 * BATCH_BYTES


def test_staged_tables_meet_python_in_batches_cut_by_bytes(spark):
    def size(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": pa.array([batch.nbytes], pa.int64())})

    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    large = spark.range(0, 300, 1, 1).select(F.repeat(F.lit("x"), 100_000).alias("text"))
    sizes = [r.n for r in staged(large.mapInArrow(size, "n long"), "sizes").collect()]
    assert sum(sizes) >= 30_000_000 and max(sizes) < 2 * BATCH_BYTES
    assert spark.conf.get(name) == before
