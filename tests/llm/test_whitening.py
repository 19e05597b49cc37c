"""Whitening against numpy over all rows at once."""

import numpy as np
import pytest

from tallyhouse.llm.whitening import SCHEMA, Blocks, whiten

ROW = "vec_id long, embedding array<float>, label int, n long, x array<long>, deviation string"


def frame(spark, vectors):
    rows = [(number, vector, 0, 5, [1], "clash") for number, vector in enumerate(vectors)]
    return spark.createDataFrame(rows, ROW).repartition(3)


def brute(vectors, components=32):
    x = np.floor(64 * np.array(vectors, np.float32).astype(float)).astype(np.int64) + 1_000_000
    n, sums = len(x), x.sum(axis=0)
    centred = (n * x - sums) / n
    values, basis = np.linalg.eigh(centred.T @ centred / n)
    values, basis = values[::-1][:components], basis[:, ::-1][:, :components]
    return centred @ basis / np.sqrt(values), values / np.trace(centred.T @ centred / n), ((n * x - sums) ** 2).sum(axis=1)


@pytest.mark.parametrize("width, blocks", [(5, Blocks()), (40, Blocks(rows=16, columns=7, per_task=2))])
def test_equals_numpy_however_it_is_cut_into_blocks(spark, width, blocks):
    draw = np.random.default_rng(3)
    vectors = (draw.standard_normal((200, width)) * np.linspace(1, 4, width)).tolist()
    found = whiten(frame(spark, vectors), blocks=blocks).toPandas()
    assert len(found) == 200 * min(width, 32)
    whitened, explained, deviation = brute(vectors)
    by_row = found.pivot(index="vec_id", columns="component", values="whitened").to_numpy()
    signs = np.sign((by_row * whitened).sum(axis=0))
    assert abs(by_row - whitened * signs).max() < 1e-9
    first = found[found["vec_id"] == 0].sort_values("component")
    assert abs(first["explained"].to_numpy() - explained).max() < 1e-12
    assert found["identity_error"].nunique() == 1 and found["identity_error"][0] < 1e-9
    assert (found[found["component"] == 1].sort_values("vec_id")["deviation"].to_numpy() == deviation).all()
    assert set(found["n"]) == {200}


def test_rows_that_cannot_take_part_are_left_out(spark):
    good = [[1.0, 2.0], [2.0, 1.0], [0.5, 0.25], [0.5, 0.25]]
    bad = [None, [], [None, 1.0], [float("nan"), 1.0], [float("inf"), 1.0], [1e30, 1.0], [1.0, 2.0, 3.0]]
    found = whiten(frame(spark, good + bad)).toPandas()
    assert sorted(found["vec_id"]) == [0, 0, 1, 1, 2, 2, 3, 3] and set(found["n"]) == {4}
    same = found[found["vec_id"].isin([2, 3])].groupby("component")["whitened"].nunique()
    assert set(same) == {1}


def test_components_without_variance_are_null(spark):
    found = whiten(frame(spark, [[1.0, 5.0], [3.0, 5.0]])).toPandas().sort_values(["vec_id", "component"])
    assert found["whitened"].isna().tolist() == [False, True, False, True]
    assert found["explained"].tolist() == [1.0, 0.0, 1.0, 0.0] and set(found["identity_error"]) == {0.0}
    alone = whiten(frame(spark, [[1.0, 5.0]])).toPandas()
    assert alone["whitened"].isna().all() and alone["explained"].isna().all() and set(alone["deviation"]) == {0}


def test_repeated_and_missing_ids_and_doubles(spark):
    rows = [(1, [1.0, 2.0]), (1, [2.0, 0.0]), (None, [0.0, 1.0])]
    found = whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    assert sorted((row["vec_id"] or -1, row["component"]) for row in found.collect()) == [(-1, 1), (-1, 2), (1, 1), (1, 1), (1, 2), (1, 2)]


def test_deviation_beyond_64_bits_is_null_and_exact_below(spark):
    found = whiten(frame(spark, [[1e9], [0.0]] + [[0.0]] * 3)).toPandas().set_index("vec_id")
    numbers = [64 * 10**9] + [0] * 4
    total = sum(numbers)
    exact = [(5 * number - total) ** 2 for number in numbers]
    assert found["deviation"].isna().tolist() == [value >= 1 << 63 for value in exact]


def test_empty_table(spark):
    found = whiten(frame(spark, []))
    assert found.count() == 0 and found.schema == spark.createDataFrame([], SCHEMA).schema
