"""Operator 2: quality classifier on random-indexing word vectors.

Random indexing: every word (by hash one of ``WORDS`` buckets) has a sparse
random index vector; the context vector of a word is the sum of the index
vectors of its neighbours over the whole corpus. Each task adds them up for its
texts, Spark sums the buckets. Words are runs of letters and digits, and runs
of other characters, so that decoration has vectors of its own.

A document is the mean of its word vectors, with the norm of that mean, the
mean similarity of adjacent words and the logarithm of its length. A two-layer
network in numpy, trained on at most ``FIT_ROWS`` labelled rows (those with the
smallest hashes of their id, held-out rows excepted), gives a logit, and a
temperature fitted on a part of those rows that the weights did not see turns
it into a probability. Labels, lang, source and doc_id are no inputs.

What is held: ``WORDS * DIMS`` numbers per task and on the driver, and
``FIT_ROWS`` feature rows on the driver, whatever the corpus size.

Defined cases: null or empty text has all features 0 and the score the network
gives them; labels that are null, or of ids without a document, are not used; of several
labels of one id the largest counts; without labels of both kinds every score
is 0.5; repeated rows get equal scores; a null id is not held out; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinelab.llm.common import small_batches, staged
from kinelab.llm.textbytes import buffers, slices, word_hashes

WORDS, DIMS, NONZERO = 1 << 14, 32, 2
FIT_ROWS = 8_000
HIDDEN, EPOCHS, RATE = 16, 400, 0.02
FEATURES = DIMS + 3
#: Held-out rows have crc32(doc_id as text) mod FOLDS = 0; label 1 from this score on.
FOLDS, ACCEPT = 5, 0.3

# 0: white space, 1: letters, digits and bytes of multi-byte characters, 2: other characters
_CLASS = np.full(256, 2, np.uint8)
_CLASS[[0x20, *range(0x09, 0x0E)]] = 0
for _a, _b in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)):
    _CLASS[_a:_b + 1] = 1

_rng = np.random.default_rng(11)
_PLACE = _rng.integers(0, DIMS, (NONZERO, WORDS))
_SIGN = _rng.choice(np.array([-1.0, 1.0]), (NONZERO, WORDS))


def _words(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, rows, row of each word, bucket of each word)."""
    data, off = buffers(texts)
    for i, j in slices(off):
        rows, h = word_hashes(data[off[i]:off[j]], off[i:j + 1] - off[i], _CLASS, lower=False)
        yield i, j - i, rows, (h >> np.uint64(64 - WORDS.bit_length() + 1)).astype(np.int64)


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, seen = np.zeros(WORDS * DIMS), np.zeros(WORDS, np.int64)
    for batch in batches:
        for _, _, rows, b in _words(batch.column(0)):
            seen += np.bincount(b, minlength=WORDS)
            beside = np.flatnonzero(rows[1:] == rows[:-1])
            left, right = b[beside], b[beside + 1]
            for word, other in ((left, right), (right, left)):
                for place, sign in zip(_PLACE, _SIGN):
                    total += np.bincount(word * DIMS + place[other], weights=sign[other], minlength=WORDS * DIMS)
    at = np.flatnonzero(seen)
    vectors = total.reshape(WORDS, DIMS)[at].astype(np.int64)
    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(seen[at]), *(pa.array(vectors[:, d]) for d in range(DIMS))],
                                     ["word", "n", *(f"v{d}" for d in range(DIMS))])


def word_vectors(docs: DataFrame) -> np.ndarray:
    """Unit context vectors of all word buckets, from the whole corpus."""
    small_batches(docs.sparkSession)
    names = [f"v{d}" for d in range(DIMS)]
    parts = docs.select("text").mapInArrow(_contexts, "word int, n long, " + ", ".join(f"{c} long" for c in names))
    out = np.zeros((WORDS, DIMS))
    for r in parts.groupBy("word").agg(*(F.sum(c).alias(c) for c in names)).collect():  # WORDS rows at most
        out[r["word"]] = r[1:]
    return (out / np.maximum(np.sqrt((out * out).sum(1, keepdims=True)), 1e-12)).astype(np.float32)


def pooled(texts: pa.Array, vectors: np.ndarray) -> np.ndarray:
    """A feature row per text."""
    out = np.zeros((len(texts), FEATURES))
    for first, n, rows, b in _words(texts):
        if not len(b):
            continue
        v = vectors[b]
        counts = np.bincount(rows, minlength=n)
        has = np.flatnonzero(counts)
        starts = np.concatenate([[0], np.cumsum(counts[has])[:-1]])
        mean = np.add.reduceat(v, starts, axis=0, dtype=np.float64) / counts[has][:, None]
        beside = np.einsum("ij,ij->i", v[1:], v[:-1]) * (rows[1:] == rows[:-1])
        f = out[first + has]
        f[:, :DIMS] = mean
        f[:, DIMS] = np.sqrt((mean * mean).sum(1))
        f[:, DIMS + 1] = np.bincount(rows[1:], weights=beside, minlength=n)[has] / np.maximum(counts[has] - 1, 1)
        f[:, DIMS + 2] = np.log1p(counts[has])
        out[first + has] = f
    return out


class Network:
    """Two layers (tanh, logit) on standardised features, with a temperature."""

    def __init__(self, x: np.ndarray, y: np.ndarray, seed: int = 13):
        rng = np.random.default_rng(seed)
        self.mean, self.std = x.mean(0), np.maximum(x.std(0), 1e-6)
        tune = np.arange(len(y)) % 5 == 0  # rows come in hash order
        z, t = self._scaled(x), y.astype(np.float64)
        w = [rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), np.zeros(1)]
        m, s = [np.zeros_like(p) for p in w], [np.zeros_like(p) for p in w]
        self.weights, best = [p.copy() for p in w], np.inf
        fit, ft = z[~tune], t[~tune]
        for step in range(1, EPOCHS + 1):
            h = np.tanh(fit @ w[0] + w[1])
            d = (_sigmoid(h @ w[2] + w[3][0]) - ft) / len(ft)
            dh = d[:, None] * w[2] * (1 - h * h)
            grads = [fit.T @ dh + 1e-4 * w[0], dh.sum(0), h.T @ d + 1e-4 * w[2], d.sum(keepdims=True)]
            for k, g in enumerate(grads):  # Adam
                m[k] = 0.9 * m[k] + 0.1 * g
                s[k] = 0.999 * s[k] + 0.001 * g * g
                w[k] = w[k] - RATE * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(s[k] / (1 - 0.999 ** step)) + 1e-8)
            if step % 20 == 0:
                loss = _loss(self._logit(z[tune], w), t[tune])
                if loss < best:
                    best, self.weights = loss, [p.copy() for p in w]
        logit = self._logit(z[tune], self.weights)
        grid = np.exp(np.linspace(np.log(0.25), np.log(8), 60))
        self.temperature = float(grid[np.argmin([_loss(logit / g, t[tune]) for g in grid])])

    def _scaled(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.std, -8, 8)

    @staticmethod
    def _logit(z: np.ndarray, w: list[np.ndarray]) -> np.ndarray:
        return np.tanh(z @ w[0] + w[1]) @ w[2] + w[3][0]

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self._logit(self._scaled(x), self.weights) / self.temperature)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def _loss(logit: np.ndarray, y: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0, logit) - y * logit)) if len(y) else 0.0


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % FOLDS == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, vectors: np.ndarray, most: int = FIT_ROWS) -> Network | None:
    """The network, from the ``most`` labelled rows with the smallest id hashes."""
    known = (labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
             .groupBy("doc_id").agg(F.max("quality").alias("quality"))
             .join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(most))
    known = staged(known, "quality-labels")  # at most ``most`` rows: broadcast, so that no text is shuffled

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = pooled(batch.column("text"), vectors)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * FEATURES, pa.int32()), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("quality"), batch.column("at"), lists], ["quality", "at", "x"])

    rows = (docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")
            .select("text", F.col("quality").cast("int").alias("quality"), F.xxhash64("doc_id", "text").alias("at"))
            .mapInArrow(features, "quality int, at long, x array<double>").orderBy("at").limit(most).collect())
    y = np.array([r["quality"] for r in rows])
    if len(set(y.tolist())) < 2:
        return None
    return Network(np.array([r["x"] for r in rows]), y)


SCORE = "_quality_score"


def scored(docs: DataFrame, labels: DataFrame, keep: tuple[str, ...]) -> DataFrame:
    """The columns ``keep`` of every document, and its score."""
    vectors = word_vectors(docs)
    network = fit(docs, labels, vectors)
    schema = T.StructType([*(docs.schema[c] for c in keep), T.StructField(SCORE, T.DoubleType())])
    text = "_text"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = network(pooled(batch.column(text), vectors)) if network else np.full(batch.num_rows, 0.5)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(s)], [*keep, SCORE])

    return docs.select(*keep, F.col("text").alias(text)).mapInArrow(run, schema)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    return scored(docs, labels, ("doc_id",)).select(
        "doc_id", held_out().alias("held_out"), F.col(SCORE).alias("score"), F.when(F.col(SCORE) >= ACCEPT, 1).otherwise(0).alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are predicted to be good, with all their columns."""
    return scored(docs, labels, tuple(docs.columns)).where(F.col(SCORE) >= ACCEPT).select(*docs.columns)
