"""The byte network: gradients, chunks, held-out accuracy, and what it must not look at."""

import random
import zlib

import numpy as np

from tallyhouse.llm import byte_cnn
from tallyhouse.llm.byte_cnn import Network, Shape, Training, cut, score_quality

SMALL = "/root/testdata/sf0.01"


def test_gradients_agree_with_differences():
    shape = Shape(chunk=32, step=24, embedding=3, filters=4, hidden=3)
    network = Network.fresh(shape, 1)
    network.weights = {name: value.astype(np.float64) for name, value in network.weights.items()}
    chunks, first = cut(["some text that fills more than one chunk of bytes", "short", "AAAA BBBB !!"], shape)
    labels = np.array([1.0, 0.0, 1.0])

    def loss():
        logit = network.combined(network.layered(network.convolve(chunks)[0]), first) @ network.weights["out"] + network.weights["bias"]
        return float(np.mean(np.log1p(np.exp(logit[:, 0])) - labels * logit[:, 0]))

    found = network.gradients(chunks, first, labels)
    for name in found:
        weight, at = network.weights[name], np.unravel_index(np.abs(found[name]).argmax(), found[name].shape)
        kept = weight[at]
        weight[at] = kept + 1e-4
        above = loss()
        weight[at] = kept - 1e-4
        below = loss()
        weight[at] = kept
        assert abs((above - below) / 2e-4 - found[name][at]) < 2e-3 * max(1.0, abs(found[name][at])), name


def test_chunks_overlap_and_cover_every_byte():
    shape = Shape()
    texts = [None, "", "a", "b" * 512, "c" * 513, "é" * 1000, "x" * 5000]
    chunks, first = cut(texts, shape)
    ends = np.append(first[1:], len(chunks))
    for text, start, end in zip(texts, first, ends):
        data = (text or "").encode()
        seen = bytearray(shape.step * (end - start - 1) + shape.chunk)
        for number, chunk in enumerate(chunks[start:end]):
            seen[number * shape.step : number * shape.step + shape.chunk] = chunk.tobytes()
        assert bytes(seen).rstrip(b"\0") == data and len(seen) >= len(data)


def test_held_out_labels_are_predicted(spark):
    docs, labels = (spark.read.parquet(f"{SMALL}/{name}.parquet") for name in ("documents", "labels"))
    found = score_quality(docs, labels).toPandas()
    assert len(found) == docs.count() and found["score"].between(0, 1).all()
    assert (found["held_out"] == [zlib.crc32(str(i).encode()) % 5 == 0 for i in found["doc_id"]]).all()
    assert (found["predicted"] == (found["score"] >= 0.3)).all()
    joined = found.merge(labels.toPandas(), on="doc_id")
    held = joined[joined["held_out"]]
    good, bad = (held[held["quality"] == label]["score"].to_numpy() for label in (1, 0))
    assert np.mean(good[:, None] > bad[None]) > 0.95
    assert (good >= 0.3).mean() > 0.95


def made(spark, texts):
    return spark.createDataFrame([(i, text, 7.5, "clash") for i, text in texts], "doc_id long, text string, score double, held_out string")


def corpus(number=120):
    draw = random.Random(5)
    texts, labels = [], []
    for i in range(number):
        good = i % 2
        words = ["".join(draw.choices("abcdefgh", k=5)) + ("" if good else "#$") for _ in range(60)]
        texts.append((i, " ".join(words)))
        labels.append((i, good))
    return texts, labels


def test_odd_rows_and_held_out_labels_change_nothing(spark):
    texts, labels = corpus()
    odd = [(None, "no id"), (500, None), (501, ""), (3, texts[4][1]), (502, "word " * 200_000), (503, "\u0000\U0001f600")]
    docs = made(spark, texts + odd)
    schema = "doc_id long, quality int, toxic int"
    plain = spark.createDataFrame([(i, q, 0) for i, q in labels], schema)
    held = [i for i, _ in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    turned = [(i, 1 - q if i in held else q, 1) for i, q in labels]
    noise = [(None, 1, 0), (7, None, 0), (901, 5, 0)] + turned[:10]
    other = spark.createDataFrame(turned + noise, schema)
    one, two = (
        sorted(((*row[:2], round(row[2], 5), row[3]) for row in score_quality(rows, given).collect()), key=repr)
        for rows, given in ((docs, plain), (docs.repartition(5), other))
    )
    assert one == two and len(one) == len(texts) + len(odd)
    assert {row[0]: row[1] for row in one}[None] is True
    scores = {row[0]: row[2] for row in one if row[0] in held}
    assert all((scores[i] >= 0.3) == bool(dict(labels)[i]) for i in held)


def test_contradicting_labels_are_not_learned(spark):
    texts, labels = corpus(40)
    both = spark.createDataFrame([(i, q) for i, q in labels] + [(i, 1 - q) for i, q in labels], "doc_id long, quality int")
    assert {row["score"] for row in score_quality(made(spark, texts), both).collect()} == {0.5}


def test_without_labels_of_both_kinds(spark):
    texts, labels = corpus(20)
    ones = spark.createDataFrame([(i, 1) for i, _ in labels], "doc_id long, quality int")
    learned = sum(zlib.crc32(str(i).encode()) % 5 != 0 for i, _ in labels)
    assert {row["score"] for row in score_quality(made(spark, texts), ones).collect()} == {(learned + 1) / (learned + 2)}
    assert score_quality(made(spark, []), ones).count() == 0


def test_the_sample_is_bounded(spark, monkeypatch):
    texts, labels = corpus(60)
    sizes = []
    fit = byte_cnn.fit
    monkeypatch.setattr(byte_cnn, "fit", lambda chunks, *rest: sizes.append([len(c) for c in chunks]) or fit(chunks, *rest))
    long = [(i, text * 40) for i, text in texts]
    labelled = spark.createDataFrame(labels, "doc_id long, quality int")
    score_quality(made(spark, long), labelled, training=Training(per_class=8, chunks=3, epochs=1)).count()
    assert len(sizes[0]) == 16 and max(sizes[0]) <= 3
