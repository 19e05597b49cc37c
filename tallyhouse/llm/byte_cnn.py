"""Quality classifier: a convolutional network over the bytes of a text, in numpy.

A text is cut into overlapping chunks of bytes that cover all of it. Learned filters slide
over each chunk; the strongest answer of every filter goes through a small layer, and the
maximum and the mean over all chunks of a text through a logistic unit: one probability.

The network is fitted on the driver with labelled documents only, at most
`Training.per_class` of each label and `Training.chunks` chunks of each document, taken in
the order of a hash; whatever the size of the tables, no more than that is fetched. Documents
whose `crc32(doc_id)` is divisible by `Training.fold` are never learned from. The two labels
are learned in equal shares and their real shares added to the logit afterwards. Every text
is scored whole, in one scan without a shuffle.

Defined results: null and empty text are one chunk of padding and get a score; a null
`doc_id` is held out; repeated rows are each scored. A label row counts if its `doc_id` has
one label of 0 or 1 only; repeated equal labels count once. Of documents sharing a `doc_id`
one is learned from. Without labels of both kinds every score is (ones + 1) / (labels + 2).
Other columns are ignored, also ones that clash with those of the result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm._shared import slices


class Shape(NamedTuple):
    chunk: int = 512
    #: Distance of chunk starts; less than `chunk`, so that chunks overlap.
    step: int = 384
    embedding: int = 8
    #: A filter is two strides wide.
    stride: int = 4
    filters: int = 32
    hidden: int = 16


class Training(NamedTuple):
    fold: int = 5
    per_class: int = 1500
    #: Chunks learned of one document, evenly spread over it.
    chunks: int = 8
    epochs: int = 10
    batch: int = 64
    rate: float = 0.004
    decay: float = 1e-4
    threshold: float = 0.3
    seed: int = 7


#: Chunks convolved in one go: some 32 MB of intermediate values.
SLAB = 512
SCHEMA = "doc_id long, held_out boolean, score double, predicted int"


def held_out(doc_id: Column, fold: int) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % fold == 0, F.lit(True))


def cut(texts: list[str | None], shape: Shape) -> tuple[np.ndarray, np.ndarray]:
    """Chunks of all texts, one row of bytes each and padded with zeros, and the first chunk of every text."""
    parts, starts, counts, at = [], [], [], 0
    for text in texts:
        data = (text or "").encode("utf-8", "surrogatepass")
        number = 1 + max(0, -(-(len(data) - shape.chunk) // shape.step))
        starts.append(at + shape.step * np.arange(number))
        counts.append(number)
        padding = bytes((number - 1) * shape.step + shape.chunk - len(data))
        parts += [data, padding]
        at += len(data) + len(padding)
    whole = np.frombuffer(b"".join(parts), np.uint8)
    first = np.concatenate([[0], np.cumsum(counts)[:-1]]).astype(np.int64)
    return sliding_window_view(whole, shape.chunk)[np.concatenate(starts)], first


class Network:
    """Weights by name, and the passes through them."""

    def __init__(self, shape: Shape, weights: dict[str, np.ndarray]):
        self.shape, self.weights = shape, weights

    @classmethod
    def fresh(cls, shape: Shape, seed: int) -> Network:
        draw = np.random.default_rng(seed)
        half = shape.stride * shape.embedding
        sizes = {
            "bytes": (256, shape.embedding),
            "left": (half, shape.filters),
            "right": (half, shape.filters),
            "layer": (shape.filters, shape.hidden),
            "out": (2 * shape.hidden, 1),
        }
        spread = {"bytes": 0.5, "left": half**-0.5, "right": half**-0.5, "layer": (2 / shape.filters) ** 0.5, "out": 0.2}
        weights = {name: (spread[name] * draw.standard_normal(size)).astype(np.float32) for name, size in sizes.items()}
        weights["bytes"][0] = 0
        weights |= {
            "filter_bias": np.zeros(shape.filters, np.float32),
            "layer_bias": np.zeros(shape.hidden, np.float32),
            "bias": np.zeros(1, np.float32),
        }
        return cls(shape, weights)

    def convolve(self, chunks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Strongest answer of every filter in every chunk before its bias, and where it was."""
        w, shape = self.weights, self.shape
        strides = w["bytes"][chunks].reshape(len(chunks), shape.chunk // shape.stride, -1)
        answers = (strides @ w["left"])[:, :-1]
        answers += (strides @ w["right"])[:, 1:]
        where = answers.argmax(axis=1)
        return np.take_along_axis(answers, where[:, None, :], axis=1)[:, 0], where

    def layered(self, pooled: np.ndarray) -> np.ndarray:
        w = self.weights
        return np.maximum(np.maximum(pooled + w["filter_bias"], 0) @ w["layer"] + w["layer_bias"], 0)

    def combined(self, hidden: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Maximum and mean over the chunks of each document."""
        counts = np.diff(np.append(first, len(hidden)))[:, None]
        sums = np.add.reduceat(hidden, first, axis=0, dtype=np.float64)
        return np.hstack([np.maximum.reduceat(hidden, first, axis=0), (sums / counts).astype(np.float32)])

    def logits(self, texts: list[str | None]) -> np.ndarray:
        chunks, first = cut(texts, self.shape)
        hidden = np.concatenate([self.layered(self.convolve(chunks[at : at + SLAB])[0]) for at in range(0, len(chunks), SLAB)])
        return (self.combined(hidden, first) @ self.weights["out"])[:, 0].astype(np.float64) + float(self.weights["bias"][0])

    def gradients(self, chunks: np.ndarray, first: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean log loss over some documents."""
        w, shape = self.weights, self.shape
        best, where = self.convolve(chunks)
        pooled = np.maximum(best + w["filter_bias"], 0)
        hidden = self.layered(best)
        features = self.combined(hidden, first)
        chance = 1 / (1 + np.exp(-np.clip(features @ w["out"] + w["bias"], -30, 30)))
        d_logit = (chance - labels[:, None]).astype(np.float32) / len(labels)
        d_features = d_logit @ w["out"].T

        counts = np.diff(np.append(first, len(chunks)))
        owner = np.repeat(np.arange(len(first)), counts)
        top, mean = np.hsplit(features, 2)
        d_top, d_mean = np.hsplit(d_features, 2)
        at_top = (hidden == top[owner]).astype(np.float32)
        at_top /= np.add.reduceat(at_top, first, axis=0)[owner]  # ties share
        d_hidden = (at_top * d_top[owner] + (d_mean / counts[:, None])[owner]) * (hidden > 0)
        d_pooled = (d_hidden @ w["layer"].T) * (pooled > 0)

        # Only the window that answered strongest is moved by a filter.
        width = 2 * shape.stride
        windows = sliding_window_view(chunks, width, axis=1)[:, :: shape.stride]
        seen = windows[np.arange(len(chunks))[:, None], where]  # chunk, filter, byte
        moved = np.einsum("cf,cfe->fe", d_pooled, w["bytes"][seen].reshape(*seen.shape[:2], -1), optimize=True)
        d_left, d_right = np.hsplit(moved, 2)
        both = np.vstack([w["left"], w["right"]]).T.reshape(shape.filters, width, shape.embedding)
        d_seen = d_pooled[:, :, None, None] * both
        flat = seen.ravel()
        d_bytes = np.stack([np.bincount(flat, part, 256) for part in d_seen.reshape(-1, shape.embedding).T], axis=1)
        d_bytes[0] = 0
        return {
            "bytes": d_bytes,
            "left": d_left.T,
            "right": d_right.T,
            "filter_bias": d_pooled.sum(axis=0),
            "layer": pooled.T @ d_hidden,
            "layer_bias": d_hidden.sum(axis=0),
            "out": features.T @ d_logit,
            "bias": d_logit.sum(axis=0),
        }


def fit(chunks: list[np.ndarray], labels: np.ndarray, shape: Shape, training: Training) -> Network:
    """A network fitted to documents given by their chunks, by Adam; the same for the same documents in the same order."""
    network = Network.fresh(shape, training.seed)
    first_moment = {name: np.zeros(value.shape) for name, value in network.weights.items()}
    second_moment = {name: np.zeros(value.shape) for name, value in network.weights.items()}
    draw = np.random.default_rng(training.seed)
    # However few the documents, they are seen often enough to settle.
    steps, total = 0, max(training.epochs * -(-len(chunks) // training.batch), 120)
    while steps < total:
        order = draw.permutation(len(chunks))
        for at in range(0, len(order), training.batch):
            chosen = order[at : at + training.batch]
            counts = [len(chunks[number]) for number in chosen]
            first = np.concatenate([[0], np.cumsum(counts)[:-1]]).astype(np.int64)
            found = network.gradients(np.concatenate([chunks[number] for number in chosen]), first, labels[chosen])
            steps += 1
            rate = training.rate * max(0.02, 1 - steps / total)
            for name, gradient in found.items():
                weight = network.weights[name]
                gradient = gradient + training.decay * weight
                first_moment[name] += 0.1 * (gradient - first_moment[name])
                second_moment[name] += 0.001 * (gradient**2 - second_moment[name])
                ahead = first_moment[name] / (1 - 0.9**steps)
                size = np.sqrt(second_moment[name] / (1 - 0.999**steps)) + 1e-8
                network.weights[name] = (weight - rate * ahead / size).astype(np.float32)
    return network


def clear_labels(labels: DataFrame, training: Training) -> DataFrame:
    """(id, label) of the documents that may be learned from and have one label."""
    usable = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id"), training.fold))
    per_id = usable.groupBy(F.col("doc_id").cast("bigint").alias("id")).agg(
        F.min("quality").alias("label"), F.max("quality").alias("other")
    )
    return per_id.where(F.col("label") == F.col("other")).select("id", F.col("label").cast("int").alias("label"))


def _sample(docs: DataFrame, labels: DataFrame, shape: Shape, training: Training) -> tuple[list[np.ndarray], np.ndarray]:
    """Chunks and labels of the documents to learn from: at most `per_class` of each label, in the order of a hash."""
    order = [F.xxhash64("id"), F.col("id")]
    chosen = [labels.where(F.col("label") == label).orderBy(*order).limit(training.per_class) for label in (0, 1)]
    found = chosen[0].union(chosen[1]).collect()
    sample = docs.sparkSession.createDataFrame(found, labels.schema)
    width = shape.chunk

    def spread(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            blobs = []
            for text in batch.column("text").to_pylist():
                chunks, _ = cut([text], shape)
                at = np.unique(np.linspace(0, len(chunks) - 1, training.chunks).astype(np.int64))
                blobs.append(chunks[at].tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(blobs, pa.binary())], ["id", "blob"])

    ids = docs.select(F.col("doc_id").cast("bigint").alias("id"), "text").join(F.broadcast(sample.select("id")), "id")
    cuts = ids.mapInArrow(spread, "id long, blob binary").groupBy("id").agg(F.min("blob").alias("blob"))
    label_of = {row["id"]: row["label"] for row in found}
    rows = sorted((row["id"], bytes(row["blob"])) for row in cuts.collect())
    chunks = [np.frombuffer(blob, np.uint8).reshape(-1, width) for _, blob in rows]
    return chunks, np.array([label_of[number] for number, _ in rows], np.float32)


def score_quality(
    docs: DataFrame, labels: DataFrame, shape: Shape = Shape(), training: Training = Training()
) -> DataFrame:
    """One row per document: held_out, the probability that its label is 1, and the label predicted."""
    known = clear_labels(labels, training)
    counts = {row["label"]: row["count"] for row in known.groupBy("label").count().collect()}
    zeros, ones = counts.get(0, 0), counts.get(1, 0)
    chunks, given = _sample(docs, known, shape, training) if zeros and ones else ([], np.zeros(0, np.float32))
    learned = 0 < given.sum() < len(given)
    network = fit(chunks, given, shape, training) if learned else None
    prior = (ones + 1) / (zeros + ones + 2)
    # The shares in the sample are not the shares in the table.
    shift = np.log(ones / zeros) - np.log(given.sum() / (len(given) - given.sum())) if learned else 0.0

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            texts = batch.column("text").to_pylist()
            if network is None:
                scores = np.full(len(texts), prior)
            else:
                scores = 1 / (1 + np.exp(-np.clip(network.logits(texts) + shift, -500, 500)))
            predicted = pa.array((scores >= training.threshold).astype(np.int32))
            columns = [batch.column("doc_id"), batch.column("held_out"), pa.array(scores), predicted]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "score", "predicted"])

    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), held_out(F.col("doc_id"), training.fold).alias("held_out"), "text"
    )
    return rows.mapInArrow(score, SCHEMA)
