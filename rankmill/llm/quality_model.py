"""A quality score per document: random-indexing word vectors, pooled, and a two-layer network.

Words are runs of letters and digits, or runs of other signs. A word is hashed to one of `BUCKETS`
numbers, and each number has a fixed sparse index vector of a few +1 and -1. The vector of a word is the
sum of the index vectors of the words within `REACH` of it, over every occurrence in all documents.
These sums are integers, added up per task and merged block by block, so they do not depend on how the
input is split. They are scaled to unit length and rounded, which makes the pooled vectors of a document
exact too: the mean of its words' vectors, the mean of their squares, the share of words with the vector
of one of the `REACH` words before them (high where words are repeated), and the logarithm of their number.

The network is trained on the driver, on at most `TRAINING_ROWS` labelled documents, those with the
smallest hash of the id: a documented bound, 20 MB. One in `CALIBRATION_SHARE` of them is kept apart and
sets the temperature its probabilities are divided by.

* A text that is null, empty or without words has the pooled vector zero and gets a score too.
* Labels of one document that contradict each other, or are neither 0 nor 1, are not learnt from.
* Rows that repeat a document id are scored each by its own text; for training, one of them counts, the
  one with the smallest vectors.
* Without labels of both kinds every score is the share of label 1, or 0.5 without any label.
* Very long texts are pooled in slices. Only the named columns are read, so others cannot clash.
* Empty tables give an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankmill.llm.blocks import SCHEMA, block_batch, collected, summed_blocks
from rankmill.llm.common import ship_package, text_of

WORD = r"[\p{L}\p{N}]+|[^\p{L}\p{N}\s]+"
BUCKETS = 2**14
DIMENSIONS = 64
FEATURES = 2 * DIMENSIONS + 2
SIGNS = 4  # cells of an index vector that are not zero
REACH = 2
BLOCK_BUCKETS = 256
SLICE_WORDS = 2**19  # words whose neighbours are counted together
POOL_WORDS = 2**16  # words whose vectors are held at once
UNIT = 2**10  # a word vector of length one

TRAINING_ROWS = 20_000
CALIBRATION_SHARE = 5
HIDDEN = 32
EPOCHS = 60
BATCH = 128
RATE = 3e-3
DECAY = 1e-4
SEED = 20_240_607

POOLED = "doc_id long, n_words long, pooled array<double>"


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the cells of every index vector; fixed by the seed."""
    draw = np.random.default_rng(SEED)
    places = draw.permuted(np.tile(np.arange(DIMENSIONS), (BUCKETS, 1)), axis=1)[:, :SIGNS]
    return places, draw.choice(np.array([-1.0, 1.0]), (BUCKETS, SIGNS))


def word_buckets(text: Column) -> Column:
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    return F.transform(words, lambda w: F.pmod(F.xxhash64(w), F.lit(BUCKETS)).cast("int"))


def _flat(batch: pa.RecordBatch, column: int) -> tuple[np.ndarray, np.ndarray]:
    """The words of all rows of a batch in a row, and where each row starts and the last ends."""
    lists = batch.column(column)
    offsets = lists.offsets.to_numpy().astype(np.int64)
    return lists.flatten().to_numpy(zero_copy_only=False), offsets - offsets[0]


def _slices(words: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Slices of bounded size: words, and the row of each."""
    for at in range(0, len(words), POOL_WORDS):
        places = np.arange(at, min(at + POOL_WORDS, len(words)))
        yield words[places], np.searchsorted(offsets, places, "right") - 1


def _neighbours(words: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(word, neighbour) of all pairs of words within `REACH` of each other in one row, both ways."""
    rows = np.repeat(np.arange(len(offsets) - 1, dtype=np.int32), np.diff(offsets))
    for at in range(0, len(words), SLICE_WORDS):
        for step in range(1, REACH + 1):
            end = min(at + SLICE_WORDS, len(words) - step)
            if end <= at:
                continue
            near = rows[at:end] == rows[at + step : end + step]
            left, right = words[at:end][near], words[at + step : end + step][near]
            yield left, right
            yield right, left


def word_sums(texts: DataFrame) -> np.ndarray:
    """The vector sums of all buckets over all documents: `BUCKETS` x `DIMENSIONS` longs."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, signs = index_vectors()
        sums = np.zeros(BUCKETS * DIMENSIONS, dtype=np.int64)
        for batch in batches:
            for word, near in _neighbours(*_flat(batch, 0)):
                for n in range(SIGNS):
                    cells = word.astype(np.int64) * DIMENSIONS + places[near, n]
                    sums += np.bincount(cells, signs[near, n], len(sums)).astype(np.int64)
        yield block_batch(0, sums, BLOCK_BUCKETS * DIMENSIONS)

    parts = texts.select(word_buckets(text_of()).alias("words")).mapInArrow(counted, SCHEMA)
    sums = collected(summed_blocks(parts), BUCKETS * DIMENSIONS, BLOCK_BUCKETS * DIMENSIONS)
    return sums.reshape(BUCKETS, DIMENSIONS)


def word_vectors(sums: np.ndarray) -> np.ndarray:
    """Unit vectors in steps of 1 / `UNIT`; a bucket without neighbours stays zero."""
    lengths = np.sqrt(np.square(sums.astype(np.float64)).sum(axis=1))
    return np.rint(sums / np.where(lengths > 0, lengths, 1.0)[:, None] * UNIT).astype(np.int16)


def _sums(values: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros((n, values.shape[1]), dtype=np.int64)
    if len(rows):
        starts = np.flatnonzero(np.diff(rows, prepend=-1))
        out[rows[starts]] = np.add.reduceat(values, starts, axis=0, dtype=np.int64)
    return out


def pooled(words: np.ndarray, offsets: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """The features of each row; they come from exact sums, so slices do not matter."""
    n = len(offsets) - 1
    first, second = (np.zeros((n, DIMENSIONS), dtype=np.int64) for _ in range(2))
    sizes = np.diff(offsets)[:, None]
    counts = np.maximum(sizes, 1)
    again = np.zeros(len(words), dtype=bool)
    for step in range(1, REACH + 1):
        before = np.arange(len(words)) - step >= np.repeat(offsets[:-1], sizes[:, 0])
        again |= before & (words == np.roll(words, step))
    repeated = np.diff(np.concatenate([[0], np.cumsum(again)])[offsets])[:, None]
    for some, rows in _slices(words, offsets):
        taken = vectors[some]
        first += _sums(taken, rows, n)
        second += _sums(np.square(taken, dtype=np.int32), rows, n)
    return np.hstack([first / counts / UNIT, second / counts / UNIT**2, repeated / counts, np.log1p(sizes)])


@dataclass(frozen=True)
class Network:
    """Two layers over standardised features; `temperature` divides the logit."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, features: np.ndarray) -> np.ndarray:
        hidden = np.maximum((features - self.mean) / self.scale @ self.w1 + self.b1, 0.0)
        return hidden @ self.w2 + self.b2

    def scores(self, features: np.ndarray) -> np.ndarray:
        return _sigmoid(self.logits(features) / self.temperature)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1.0 + np.tanh(0.5 * x))


def trained(features: np.ndarray, labels: np.ndarray) -> Network:
    """Logistic loss, Adam, mini-batches in a fixed random order."""
    draw = np.random.default_rng(SEED)
    inputs = features.shape[1]
    mean, scale = features.mean(axis=0), features.std(axis=0) + 1e-3
    x = (features - mean) / scale
    share = np.clip(labels.mean(), 1e-3, 1 - 1e-3)
    params = [
        draw.normal(0, np.sqrt(2 / inputs), (inputs, HIDDEN)),
        np.zeros(HIDDEN),
        draw.normal(0, np.sqrt(1 / HIDDEN), HIDDEN),
        np.array(np.log(share / (1 - share))),
    ]
    means, squares = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    steps = 0
    for _ in range(EPOCHS):
        order = draw.permutation(len(x))
        for at in range(0, len(x), BATCH):
            rows = order[at : at + BATCH]
            w1, b1, w2, b2 = params
            hidden = np.maximum(x[rows] @ w1 + b1, 0.0)
            wrong = (_sigmoid(hidden @ w2 + b2) - labels[rows]) / len(rows)
            back = np.outer(wrong, w2) * (hidden > 0)
            grads = [x[rows].T @ back + DECAY * w1, back.sum(axis=0), hidden.T @ wrong + DECAY * w2, wrong.sum()]
            steps += 1
            for n, grad in enumerate(grads):
                means[n] = 0.9 * means[n] + 0.1 * grad
                squares[n] = 0.999 * squares[n] + 0.001 * grad**2
                step = means[n] / (1 - 0.9**steps) / (np.sqrt(squares[n] / (1 - 0.999**steps)) + 1e-8)
                params[n] = params[n] - RATE * step
    return Network(mean, scale, params[0], params[1], params[2], float(params[3]))


def best_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature with the least log loss on rows the network has not seen."""
    grid = np.exp(np.linspace(np.log(0.25), np.log(16), 121))
    signed = np.where(labels == 1, logits, -logits)
    return float(grid[np.argmin([np.logaddexp(0, -signed / t).mean() for t in grid])])


def fitted(features: np.ndarray, labels: np.ndarray, apart: np.ndarray) -> Network:
    """A network trained on the rows not `apart`, with the temperature that suits those."""
    learnt = ~apart
    if len(set(labels[learnt].tolist())) < 2:
        return constant(float(labels.mean()) if len(labels) else 0.5)
    network = trained(features[learnt], labels[learnt])
    if not apart.any():
        return network
    parts = (network.mean, network.scale, network.w1, network.b1, network.w2, network.b2)
    return Network(*parts, best_temperature(network.logits(features[apart]), labels[apart]))


def constant(score: float) -> Network:
    share = min(max(score, 1e-6), 1 - 1e-6)
    zeros = np.zeros((FEATURES, 1))
    return Network(np.zeros(FEATURES), np.ones(FEATURES), zeros, np.zeros(1), np.zeros(1), float(np.log(share / (1 - share))))


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 3, is 1; a document without an id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def training_labels(labels: DataFrame, rows: int = TRAINING_ROWS) -> DataFrame:
    """(doc_id, label) of at most `rows` documents that may be learnt from, the same ones every time."""
    usable = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id")))
    agreed = usable.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.min("quality").alias("label"), F.max("quality").alias("most")
    )
    return agreed.where("label = most").orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows).select("doc_id", "label")


def training_set(docs: DataFrame, labels: DataFrame, vectors, rows: int) -> tuple[np.ndarray, ...]:
    """Pooled vectors and labels of the training documents, in the order of their ids."""

    def pool(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, offsets = _flat(batch, 1)
            values = pooled(words, offsets, vectors.value)
            arrays = [batch.column(0), pa.array(np.diff(offsets)), pa.array(list(values), pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_words", "pooled"])

    chosen = training_labels(labels, rows)
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(chosen.select("doc_id")), "doc_id", "left_semi")
    taken = ids.select("doc_id", word_buckets(text_of()).alias("words")).mapInArrow(pool, POOLED)
    known = taken.groupBy("doc_id").agg(F.min(F.struct("n_words", "pooled")).alias("p")).join(F.broadcast(chosen), "doc_id")
    table = known.select("doc_id", "p.pooled", "label").orderBy("doc_id").toArrow()
    features = table.column("pooled").combine_chunks().flatten().to_numpy().reshape(-1, FEATURES)
    apart = np.array([(i * 2654435761 >> 8) % CALIBRATION_SHARE == 0 for i in table.column("doc_id").to_pylist()], dtype=bool)
    return features, table.column("label").to_numpy().astype(np.float64), apart


def score_quality(docs: DataFrame, labels: DataFrame, training_rows: int = TRAINING_ROWS) -> DataFrame:
    """(doc_id, held_out, score, predicted, n_words) of every row of `docs`."""
    spark = docs.sparkSession
    ship_package(spark)
    vectors = spark.sparkContext.broadcast(word_vectors(word_sums(docs)))
    network = spark.sparkContext.broadcast(fitted(*training_set(docs, labels, vectors, training_rows)))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, offsets = _flat(batch, 1)
            scores = np.round(network.value.scores(pooled(words, offsets, vectors.value)), 9)
            arrays = [batch.column(0), pa.array(scores), pa.array(np.diff(offsets))]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "score", "n_words"])

    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), word_buckets(text_of()).alias("words"))
    result = ids.mapInArrow(scored, "doc_id long, score double, n_words long")
    return result.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_words"
    )
