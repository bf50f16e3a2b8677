"""Quality classifier: random-indexing word vectors pooled per document, and a two-layer network with calibrated probabilities."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from faultline.lineage import cut_lineage
from faultline.llm.common import TOKENS, buffers, fresh, pieces, tokens

#: Words share this many vectors (by hash) of this many numbers; what the driver gathers is one such table.
WORDS, SIZE = 8192, 32
#: Non-zero places of an index vector, and neighbours on each side that a word's vector sums.
PLACES, REACH = 4, 2
#: Labelled documents the network learns from, at most: those of least hash. A fifth of them calibrate it.
SAMPLE = 20_000
HIDDEN, EPOCHS, BATCH, RATE, DECAY = 32, 40, 256, 3e-3, 1e-4

_SHIFT = np.uint64(64 - WORDS.bit_length() + 1)


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the non-zero numbers of each word's index vector."""
    rng = np.random.default_rng(17)
    return np.argsort(rng.random((WORDS, SIZE)), 1)[:, :PLACES], rng.integers(0, 2, (WORDS, PLACES)) * 2 - 1


def dense_index() -> np.ndarray:
    places, signs = index_vectors()
    out = np.zeros((WORDS, SIZE), np.float32)
    np.put_along_axis(out, places, signs.astype(np.float32), 1)
    return out


def word_numbers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Vector number of each word of the texts, and each text's first word. Words are runs of letters, digits or other marks."""
    _, _, hashes, first = tokens(*buffers(texts), TOKENS)
    return (hashes >> _SHIFT).astype(np.int64), first


def context_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, sums) of the task's texts: the index vectors of each word's neighbours, summed."""
    places, signs = index_vectors()
    sums = np.zeros(WORDS * SIZE)
    for batch in batches:
        for piece in pieces(batch, 0):
            words, first = word_numbers(piece.column(0))
            row = np.repeat(np.arange(piece.num_rows), np.diff(first))
            for step in range(1, REACH + 1):
                near = row[step:] == row[:-step]
                left, right = words[:-step][near], words[step:][near]
                for a, b in ((left, right), (right, left)):
                    for k in range(PLACES):
                        sums += np.bincount(a * SIZE + places[b, k], signs[b, k], WORDS * SIZE)
    sums = sums.reshape(WORDS, SIZE)
    some = np.flatnonzero(sums.any(1))
    columns = [pa.array(sums[some, j].astype(np.int64)) for j in range(SIZE)]
    yield pa.RecordBatch.from_arrays([pa.array(some), *columns], ["word", *(f"v{j}" for j in range(SIZE))])


def word_vectors(docs: DataFrame) -> np.ndarray:
    """A vector per word number: the direction of its context, over all documents, beside its own index vector."""
    names = [f"v{j}" for j in range(SIZE)]
    sums = docs.select(F.col("text").cast("string")).mapInArrow(context_sums, "word long, " + ", ".join(f"{n} long" for n in names))
    table = sums.groupBy("word").agg(*[F.sum(n).alias(n) for n in names]).toArrow()
    context = np.zeros((WORDS, SIZE), np.float32)
    context[table.column("word").to_numpy()] = np.stack([table.column(n).to_numpy() for n in names], 1)
    context /= np.maximum(np.linalg.norm(context, axis=1, keepdims=True), 1e-9)
    return np.concatenate([context, dense_index()], 1)


def pooled(docs: DataFrame, vectors: np.ndarray, carry: list[str]) -> DataFrame:
    """The columns in `carry` and `features` (`fresh`), the mean of a text's word vectors; zeros for a text without words."""
    shared = docs.sparkSession.sparkContext.broadcast(vectors)
    rows = docs.select(F.col("text").cast("string").alias(fresh(docs, "input_text")), *[F.col(f"`{c}`") for c in carry])
    schema = StructType(rows.schema.fields[1:]).add(fresh(rows.drop(rows.columns[0]), "features"), "binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            for piece in pieces(batch, 0, 256 << 10):
                words, first = word_numbers(piece.column(0))
                out = np.zeros((piece.num_rows, table.shape[1]), np.float32)
                some = np.flatnonzero(np.diff(first))
                if len(some):
                    out[some] = np.add.reduceat(table[words], first[some]) / np.diff(first)[some, None]
                yield pa.RecordBatch.from_arrays([*piece.columns[1:], pa.array([x.tobytes() for x in out], pa.binary())], schema.names)

    return rows.mapInArrow(run, schema)


@dataclass
class Network:
    """Two layers over scaled features; `heat` divides what the sigmoid gets."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    heat: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.mean) / self.scale @ self.w1 + self.b1) @ self.w2 + self.b2

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.heat, -40, 40)))


def train(x: np.ndarray, y: np.ndarray) -> Network:
    """Learns on four fifths of the rows, then finds the temperature under which the others are likeliest.

    Rows come in a fixed order and all draws are seeded. Without rows, or with one class, every score is that
    class's share, smoothed by one row of each.
    """
    n, size = x.shape
    rate = (y.sum() + 1) / (n + 2)
    flat = Network(np.zeros(size), np.ones(size), np.zeros((size, 1)), np.zeros(1), np.zeros(1), float(np.log(rate / (1 - rate))))
    if n < 20 or y.min() == y.max():
        return flat
    rng = np.random.default_rng(5)
    test = np.arange(n) % 5 == 4
    own, target = x[~test], y[~test]
    net = Network(own.mean(0), own.std(0) + 1e-6, rng.normal(0, 1 / np.sqrt(size), (size, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), flat.b2)
    scaled = (own - net.mean) / net.scale
    parts = [net.w1, net.b1, net.w2, np.array([net.b2])]
    first, second = [np.zeros_like(p) for p in parts], [np.zeros_like(p) for p in parts]
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(own))
        for low in range(0, len(own), BATCH):
            at = order[low:low + BATCH]
            hidden = np.tanh(scaled[at] @ parts[0] + parts[1])
            error = (1 / (1 + np.exp(-np.clip(hidden @ parts[2] + parts[3], -40, 40))) - target[at]) / len(at)
            inner = np.outer(error, parts[2]) * (1 - hidden**2)
            slopes = [scaled[at].T @ inner + DECAY * parts[0], inner.sum(0), hidden.T @ error + DECAY * parts[2], np.array([error.sum()])]
            step += 1
            for p, g, m, v in zip(parts, slopes, first, second):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    net.w1, net.b1, net.w2, net.b2 = parts[0], parts[1], parts[2], float(parts[3][0])
    logits, heats = net.logits(x[test]), np.exp(np.linspace(-2, 3, 101))
    net.heat = float(min(heats, key=lambda t: np.logaddexp(0, -(2 * y[test] - 1) * logits / t).mean()))
    return net


def fit(features: DataFrame, labels: DataFrame, usable: Column) -> Network:
    """The network, from rows of (doc_id, features) where `usable`, that have a label.

    A bounded sample: the `SAMPLE` labelled documents of least hash. Several labels of a document are averaged; of
    several texts with one doc_id the one of least features counts.
    """
    known = labels.filter("quality is not null and doc_id is not null").filter(usable).groupBy("doc_id").agg(F.avg("quality").alias("target"))
    known = known.withColumn("order", F.xxhash64("doc_id")).orderBy("order", "doc_id").limit(SAMPLE)
    rows = features.join(F.broadcast(known), "doc_id").groupBy("order", "doc_id", "target").agg(F.min("features").alias("features"))  # SAMPLE rows
    rows = rows.toArrow().sort_by([("order", "ascending"), ("doc_id", "ascending")])
    width = 2 * SIZE
    x = np.frombuffer(b"".join(v.as_py() for v in rows.column("features")), np.float32).reshape(-1, width).astype(np.float64)
    return train(x, np.round(rows.column("target").to_numpy()))


def scored(features: DataFrame, net: Network) -> DataFrame:
    """The rows with `score` in place of the last column, the features: the probability of good quality."""
    *names, vector = features.columns
    kept = features.select(*[F.col(f"`{c}`") for c in names])
    schema = StructType(kept.schema.fields).add(fresh(kept, "score"), "double")
    rows = features.select(F.col(f"`{vector}`"), *[F.col(f"`{c}`") for c in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.frombuffer(b"".join(v.as_py() for v in batch.column(0)), np.float32).reshape(batch.num_rows, 2 * SIZE)
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(net.scores(x.astype(np.float64)))], schema.names)

    return rows.mapInArrow(run, schema)


def score(docs: DataFrame, labels: DataFrame, usable: Column, carry: list[str]) -> DataFrame:
    """The columns in `carry` and `score` of every row of `docs`, null and empty texts included; equal texts score alike.

    Word vectors come from all documents; labels are read only where `usable`, an expression over doc_id. Where `carry`
    already has a `score`, in whatever letter case, that one stays and the new column is the last, `score_`.
    """
    features = cut_lineage(pooled(docs, word_vectors(docs), carry if "doc_id" in carry else ["doc_id", *carry]))
    net = fit(features.select("doc_id", F.col(f"`{features.columns[-1]}`").alias("features")), labels, usable)
    return scored(features.select(*[F.col(f"`{c}`") for c in [*carry, features.columns[-1]]]), net)
