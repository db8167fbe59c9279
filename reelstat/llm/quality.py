"""Text quality by attention-based multiple-instance learning.

A text is a bag of passages of ``PASSAGE`` words, all of which are encoded: shares of character classes and of hashed
character pairs. A small network embeds each passage, a gate learned from the labels of whole documents weighs it,
and the document's score is that of the weighted sum of its passages. The network is fitted on the driver from a
bounded sample of labelled rows; every document is scored where it lies.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from reelstat.llm.common import sized_slices, table, text_bytes, word_spans
from reelstat.llm.toxicity import learns

PASSAGE = 100
# ASCII characters, bytes beyond ASCII, hashed pairs of characters, distinct words, words by passage length.
CHARACTERS, PAIRS = 129, 126
FEATURES = CHARACTERS + PAIRS + 2
HIDDEN, GATE = 24, 16
# Labelled rows that the network is fitted on, at most.
SAMPLE = 4000
# Passages of one text that are learned from, at most; so rows and bytes of the sample are bounded.
FIT_PASSAGES = 64
STEPS, BAGS, RATE = 500, 96, 0.01
FOLDS, HELD_OUT = 4, 2
THRESHOLD = 0.7


def passages(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Features of every passage and the row of each. A text without words is one passage of zeros."""
    data, starts = text_bytes(column)
    n = len(starts) - 1
    first, last, rows = word_spans(data, starts)
    count = np.bincount(rows, minlength=n)
    own = np.maximum(1, -(-count // PASSAGE))
    base = np.cumsum(own) - own
    place = np.arange(len(rows)) - (np.cumsum(count) - count)[rows]
    passage = base[rows] + place // PASSAGE
    total = int(own.sum())
    # A byte belongs to the passage of the last word that started, so white space counts with what it follows.
    if not len(first):
        return np.zeros((total, FEATURES), np.float32), np.repeat(np.arange(n), own)
    word = np.searchsorted(first, np.arange(len(data)), side="right") - 1
    at = passage[np.maximum(word, 0)]
    kind = np.minimum(data, 128).astype(np.int64)
    singles = np.bincount(at * CHARACTERS + kind, minlength=total * CHARACTERS).reshape(total, CHARACTERS)
    pair = (data[:-1].astype(np.int64) * 257 + data[1:]) * 2654435761 % 4294967291 % PAIRS
    pairs = np.bincount(at[1:] * PAIRS + pair, minlength=total * PAIRS).reshape(total, PAIRS)
    size = np.maximum(singles.sum(axis=1, keepdims=True), 1)
    words = np.bincount(passage, minlength=total)
    # Different first bytes and lengths of words stand for different words.
    shape = passage * 8192 + np.minimum(last - first, 31) * 256 + data[first]
    different = np.bincount(np.unique(shape) // 8192, minlength=total)
    more = np.stack([different / np.maximum(words, 1), words / PASSAGE], axis=1)
    features = np.concatenate([np.sqrt(singles / size), np.sqrt(pairs / size), more], axis=1)
    return features.astype(np.float32), np.repeat(np.arange(n), own)


class Model:
    """Passage embedding, gated attention and document score, with the gradient of their log loss."""

    def __init__(self, seed: int = 3):
        rng = np.random.default_rng(seed)
        draw = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
        self.mean, self.scale = np.zeros(FEATURES, np.float32), np.ones(FEATURES, np.float32)
        self.weights = [
            draw(FEATURES, HIDDEN), np.zeros(HIDDEN, np.float32), draw(HIDDEN, GATE), draw(HIDDEN, GATE),
            draw(GATE, 1)[:, 0], draw(HIDDEN, 1)[:, 0], np.zeros(1, np.float32),
        ]

    def forward(self, x: np.ndarray, bag: np.ndarray, bags: int):
        w, b, v, u, a, c, d = self.weights
        x = (x - self.mean) / self.scale
        h = np.tanh(x @ w + b)
        t, s = np.tanh(h @ v), 1 / (1 + np.exp(-np.clip(h @ u, -30, 30)))
        energy = (t * s) @ a
        top = np.full(bags, -np.inf, np.float32)
        np.maximum.at(top, bag, energy)
        weight = np.exp(energy - top[bag])
        weight /= np.bincount(bag, weight, bags)[bag]
        z = np.zeros((bags, HIDDEN), np.float32)
        np.add.at(z, bag, (weight[:, None] * h).astype(np.float32))
        p = 1 / (1 + np.exp(-np.clip(z @ c + d, -30, 30)))
        return p, (x, h, t, s, weight, z)

    def gradient(self, x: np.ndarray, bag: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
        w, b, v, u, a, c, d = self.weights
        p, (x, h, t, s, weight, z) = self.forward(x, bag, len(y))
        out = (p - y) / len(y)
        dz = out[:, None] * c
        along = (dz[bag] * h).sum(axis=1)
        mean = np.bincount(bag, weight * along, len(y))
        de = weight * (along - mean[bag])
        dt, ds = de[:, None] * a * s * (1 - t**2), de[:, None] * a * t * s * (1 - s)
        dh = weight[:, None] * dz[bag] + dt @ v.T + ds @ u.T
        dx = dh * (1 - h**2)
        grads = [x.T @ dx, dx.sum(axis=0), h.T @ dt, h.T @ ds, (t * s).T @ de, z.T @ out, np.array([out.sum()])]
        return [g + 1e-4 * k for g, k in zip(grads, self.weights)]

    def fit(self, x: np.ndarray, starts: np.ndarray, y: np.ndarray, seed: int = 4) -> Model:
        """Adam over random batches of bags; bag i has the passages from ``starts[i]`` to ``starts[i + 1]``."""
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-2
        rng = np.random.default_rng(seed)
        first = [np.zeros_like(k) for k in self.weights]
        second = [np.zeros_like(k) for k in self.weights]
        for step in range(1, STEPS + 1):
            pick = rng.integers(0, len(y), min(BAGS, len(y)))
            sizes = starts[pick + 1] - starts[pick]
            rows = np.concatenate([np.arange(starts[k], starts[k + 1]) for k in pick])
            for k, g in enumerate(self.gradient(x[rows], np.repeat(np.arange(len(pick)), sizes), y[pick])):
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                move = RATE * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
                self.weights[k] = (self.weights[k] - move).astype(np.float32)
        return self


def _encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in sized_slices(batches, 2, size=1 << 20):
        features, rows = passages(batch.column(2))
        starts = np.searchsorted(rows, np.arange(batch.num_rows + 1))
        packed = []
        for doc, a, b in zip(batch.column(0).to_pylist(), starts[:-1], starts[1:]):
            own = features[a:b]
            if len(own) > FIT_PASSAGES:
                own = own[np.sort(np.random.default_rng(abs(doc)).choice(len(own), FIT_PASSAGES, replace=False))]
            packed.append(own.tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(packed, pa.binary())], names=["doc_id", "quality", "features"]
        )


def fit(self, x: np.ndarray, starts: np.ndarray, y: np.ndarray, seed: int = 4) -> Model:
        """Adam over random batches of bags; bag i has the passages from ``starts[i]`` to ``starts[i + 1]``."""
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-2
        rng = np.random.default_rng(seed)
        first = [np.zeros_like(k) for k in self.weights]
        second = [np.zeros_like(k) for k in self.weights]
        for step in range(1, STEPS + 1):
            pick = rng.integers(0, len(y), min(BAGS, len(y)))
            sizes = starts[pick + 1] - starts[pick]
            rows = np.concatenate([np.arange(starts[k], starts[k + 1]) for k in pick])
            for k, g in enumerate(self.gradient(x[rows], np.repeat(np.arange(len(pick)), sizes), y[pick])):
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                move = RATE * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
                self.weights[k] = (self.weights[k] - move).astype(np.float32)
        return self


def _encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in sized_slices(batches, 2):
        features, rows = passages(batch.column(2))
        starts = np.searchsorted(rows, np.arange(batch.num_rows + 1))
        packed = [features[a:b].tobytes() for a, b in zip(starts[:-1], starts[1:])]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(packed, pa.binary())], names=["doc_id", "quality", "features"]
        )


def fit(documents: DataFrame, labels: DataFrame) -> Model | None:
    """A model learned from at most SAMPLE labelled rows outside the held-out fold, or None without two classes.

    The sample is drawn by a hash of the id, from rows that have a document. The two classes count the same. Of a very long
    text FIT_PASSAGES passages, drawn by its id, are learned from; all are scored.
    """
    known = labels.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")
    ).filter(F.col("quality").isin(0, 1) & (learns(F.col("doc_id"), FOLDS) != HELD_OUT))
    # Of several labels of an id the least counts.
    known = known.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    known = known.join(documents.select(F.col("doc_id").cast("long").alias("doc_id")), "doc_id", "left_semi")
    order = F.xxhash64("doc_id", F.lit("sample"))
    half = [known.filter(F.col("quality") == k).orderBy(order, "doc_id").limit(SAMPLE // 2) for k in (0, 1)]
    sample = F.broadcast(half[0].unionAll(half[1]))
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = docs.join(sample, "doc_id").select("doc_id", "quality", "text")
    taught = rows.mapInArrow(_encode, "doc_id long, quality int, features binary").toArrow()
    taught = taught.sort_by([("doc_id", "ascending")])
    y = taught.column("quality").to_numpy().astype(np.float32)
    if not 0 < y.sum() < len(y):
        return None
    bags = [np.frombuffer(b, np.float32).reshape(-1, FEATURES) for b in taught.column("features").to_pylist()]
    starts = np.concatenate([[0], np.cumsum([len(b) for b in bags])])
    return Model().fit(np.concatenate(bags), starts, y)


def score(documents: DataFrame, model: Model | None) -> DataFrame:
    """doc_id and score of every row, by all passages of its text. Without a model every score is 0.5."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sized_slices(batches, 1, size=1 << 20):
            if model is None:
                value = np.full(batch.num_rows, 0.5)
            else:
                features, rows = passages(batch.column(1))
                value = model.forward(features, rows, batch.num_rows)[0].astype(float)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(value)], names=["doc_id", "score"])

    needed = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return needed.mapInArrow(run, "doc_id long, score double")


def op8_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Quality of every document. Null texts are scored as empty ones; an empty table gives no rows."""
    documents = table(spark, folder, "documents")
    scored = score(documents, fit(documents, table(spark, folder, "labels")))
    return scored.select(
        "doc_id",
        F.coalesce(learns(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
