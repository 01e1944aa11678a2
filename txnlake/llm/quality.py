"""Quality classifier: a convolutional network over bytes, in numpy.

Filters of ``WIDTH`` bytes slide over the whole text. A filter is a table of weights per place and byte
value, so a convolution is a sum of table rows. The text is cut into overlapping chunks (each shares half
of its bytes with the next), every filter's strongest answer in a chunk passes (max-pooling, then ReLU),
a dense layer gives each chunk a hidden vector, and the mean over all chunks of the hidden vectors is combined
into one probability. A text of any length is scored whole, a bounded slice at a time.

``train`` learns from labelled rows on the driver: at most ``SAMPLE_ROWS`` rows that have a document, chosen by a hash of
the id, and of a text longer than ``SAMPLE_BYTES`` a slice of that size from a hashed place. That sample is the
only bounded input; scoring covers all documents.

Defined cases: null and empty texts are scored like a text of white space; labels, language,
source and id never enter a score; labels that are null are not learnt from; several labels of a document
count once each; without labels of both classes every score is the share of label 1 (one half
without labels), and labels of both classes of which the sample has not two are an error, unless there are no documents. Repeated rows and rows with a null id are scored like any other.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnlake.llm import common

WIDTH, FILTERS, HIDDEN = 5, 16, 8
HALF = 64  # bytes; a chunk is two halves
SLICE = 2048  # halves scored at once
SAMPLE_ROWS, SAMPLE_BYTES = 1500, 6000
STEPS, RATE, GROUP = 800, 0.02, 16  # steps of Adam, whatever the sample's size
ACCEPT = 0.3


class Network:
    def __init__(self, seed: int = 11):
        r = np.random.default_rng(seed)
        self.filters = r.normal(0, 0.3, (WIDTH, 256, FILTERS)).astype(np.float32)
        self.bias = np.zeros(FILTERS, np.float32)
        self.dense = r.normal(0, 0.4, (FILTERS, HIDDEN)).astype(np.float32)
        self.dense_bias = np.zeros(HIDDEN, np.float32)
        self.out = r.normal(0, 0.4, HIDDEN).astype(np.float32)
        self.out_bias = np.zeros(1, np.float32)
        self.constant: float | None = None

    def weights(self) -> list[np.ndarray]:
        return [self.filters, self.bias, self.dense, self.dense_bias, self.out, self.out_bias]

    def convolve(self, x: np.ndarray) -> np.ndarray:
        """Filter answers at every place of ``x`` but the last WIDTH - 1."""
        n = len(x) - WIDTH + 1
        out = self.filters[0].take(x[:n], axis=0)
        for k in range(1, WIDTH):
            out += self.filters[k].take(x[k : k + n], axis=0)
        return out

    def pooled(self, x: np.ndarray) -> np.ndarray:
        """Strongest answers per chunk. ``x`` is padded: whole halves and WIDTH - 1 bytes more."""
        halves = (len(x) - WIDTH + 1) // HALF
        best = np.empty((halves, FILTERS), np.float32)
        for a in range(0, halves, SLICE):
            b = min(halves, a + SLICE)
            best[a:b] = self.convolve(x[a * HALF : b * HALF + WIDTH - 1]).reshape(b - a, HALF, FILTERS).max(axis=1)
        return np.maximum(best[:-1], best[1:]) if halves > 1 else best

    def score(self, data: bytes) -> float:
        if self.constant is not None:
            return self.constant
        hidden = np.maximum(np.maximum(self.pooled(padded(data)) + self.bias, 0) @ self.dense + self.dense_bias, 0)
        return float(1 / (1 + np.exp(-np.clip(hidden.mean(axis=0) @ self.out + self.out_bias[0], -30, 30))))


def padded(data: bytes) -> np.ndarray:
    """Bytes filled up with spaces to whole halves, two at least, and the filter's overhang."""
    halves = max(2, -(-len(data) // HALF))
    return np.frombuffer(data.ljust(halves * HALF + WIDTH - 1, b" "), np.uint8)


def fit(texts: list[bytes], labels: np.ndarray, steps: int = STEPS, seed: int = 11) -> Network:
    """Adam on the log loss; gradients pass only through the winning places of the pooling."""
    net = Network(seed)
    if len(texts) == 0 or labels.min() == labels.max():
        net.constant = float(labels.mean()) if len(texts) else 0.5
        return net
    r = np.random.default_rng(seed)
    weights = net.weights()
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    inputs = [padded(t) for t in texts]
    order: list[int] = []
    for step in range(1, steps + 1):
        while len(order) < GROUP:
            order += r.permutation(len(inputs)).tolist()
        picked, order = order[:GROUP], order[GROUP:]
        grads = [np.zeros_like(w) for w in weights]
        for i in picked:
            _gradient(net, inputs[i], labels[i], grads)
        rate = RATE * (1 - (step - 1) / steps)
        for w, g, m, v in zip(weights, grads, first, second, strict=True):
            g /= len(picked)
            m *= 0.9
            m += 0.1 * g
            v *= 0.99
            v += 0.01 * g * g
            w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)
    return net


def _gradient(net: Network, x: np.ndarray, label: float, grads: list[np.ndarray]) -> None:
    halves = (len(x) - WIDTH + 1) // HALF
    answers = net.convolve(x).reshape(halves, HALF, FILTERS)
    where = answers.argmax(axis=1)
    best = np.take_along_axis(answers, where[:, None, :], axis=1)[:, 0]
    where = where + np.arange(halves)[:, None] * HALF
    later = best[1:] > best[:-1]
    top, place = np.where(later, best[1:], best[:-1]), np.where(later, where[1:], where[:-1])
    passed = np.maximum(top + net.bias, 0)
    before = passed @ net.dense + net.dense_bias
    hidden = np.maximum(before, 0)
    mean = hidden.mean(axis=0)
    error = 1 / (1 + np.exp(-np.clip(mean @ net.out + net.out_bias[0], -30, 30))) - label
    d_hidden = (error * net.out / len(top))[None, :] * (before > 0)
    d_top = (d_hidden @ net.dense.T) * (passed > 0)
    grads[4] += error * mean
    grads[5] += error
    grads[2] += passed.T @ d_hidden
    grads[3] += d_hidden.sum(axis=0)
    grads[1] += d_top.sum(axis=0)
    which = np.broadcast_to(np.arange(FILTERS), place.shape)
    for k in range(WIDTH):
        np.add.at(grads[0][k], (x[place + k], which), d_top)


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", doc_id: str = "doc_id", text: str = "text", rows: int = SAMPLE_ROWS, most: int = SAMPLE_BYTES) -> Network:
    """Learn from a bounded sample of the labelled rows that are not held out (crc32 of the id mod 5 is 0)."""
    marks = labels.select(F.col(doc_id).alias("doc_id"), F.col(label).cast("double").alias("label")).filter("label is not null and doc_id is not null")
    marks = marks.filter(common.remainder_of_id() != 0)
    # Only labels whose document is there are drawn; ids alone decide, texts of the drawn ones follow.
    present = marks.join(docs.select(F.col(doc_id).alias("doc_id")).distinct(), "doc_id", "left_semi")
    drawn = present.withColumn("k", F.xxhash64("doc_id", "label")).orderBy("k", "doc_id", "label").limit(rows)
    whole = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text")).join(F.broadcast(drawn), "doc_id")
    # Of a longer text a slice from a place its id and text choose.
    beyond = F.greatest(F.octet_length("text") - most, F.lit(0))
    start = F.pmod(F.xxhash64("doc_id", "text"), beyond + 1).cast("int")
    cut = whole.select("k", "doc_id", "label", F.substring("text", start + 1, F.lit(most)).alias("text"))
    sample = cut.orderBy("k", "doc_id", "label", "text").limit(rows).select("text", "label").collect()
    if len({r["label"] for r in sample}) < 2 and marks.select("label").distinct().count() > 1 and not docs.isEmpty():
        raise ValueError("the labels have several classes, but the sample of labelled documents has fewer than two")
    return fit([bytes(r["text"]) for r in sample], np.array([r["label"] for r in sample], np.float32))


def score(docs: DataFrame, net: Network, text: str = "text", column: str = "score") -> DataFrame:
    """``docs`` with a probability added."""
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast(pickle.dumps(net))
    column = common.free_name(docs, column)
    at = docs.columns.index(text)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = pickle.loads(model.value)
        for batch in batches:
            scores = pa.array([own.score(x) for x in common.text_bytes(batch.column(at))], pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, scores], [*batch.schema.names, column])

    schema = docs.select("*", F.lit(0.0).cast("double").alias(column)).schema
    return docs.mapInArrow(run, schema)


def judged(docs: DataFrame, net: Network) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    scored = score(docs.select("doc_id", "text"), net)
    held = F.coalesce(common.remainder_of_id() == 0, F.lit(False))
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= ACCEPT).cast("int").alias("predicted"))
