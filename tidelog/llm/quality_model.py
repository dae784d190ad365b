"""Quality classifier: random-indexing word vectors, pooled per document, and a small calibrated network.

Every token hashes to one of ``BUCKETS`` words. A word's index vector is sparse and random (``NONZERO`` of ``DIM`` places,
plus or minus one); its context vector is the sum of the index vectors of its neighbours over all documents. The sums are
whole numbers, added up per task and then per word, so the table of vectors has a fixed size and does not depend on the
order of rows. A document's features are the mean and the spread of its tokens' vectors, frequent words weighing less.

A network of two layers learns from labelled documents outside the held-out fold (crc32 of the id, mod 5, is 0), at most
``FIT_ROWS`` of them, those with the smallest hashes: the one bounded sample. Part of them sets the temperature that
calibrates its probabilities. Labels, language, source and id are no inputs.

Nulls and repeats: a null text is empty and has a score like any other; repeated label rows of a document count once
(largest label), null labels not at all; without both labels every score is the share of good labels (0.5 without
labels). Each row gives one row. Empty tables give empty results; other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import MEMO_WORDS, gram_hashes, small_batches, smallest_hashes, stored

BUCKETS, DIM, NONZERO, REACH = 8192, 32, 4, 2
FIT_ROWS = 20_000
HIDDEN, EPOCHS, LEARN_RATE, DECAY = 32, 300, 0.01, 1e-4
THRESHOLD = 0.3
#: Weight of a word of frequency p: COMMON / (COMMON + p).
COMMON = 1e-3
#: Words of their own: tokens in capitals, and tokens that repeat what has just stood there.
CAPITALS, AGAIN = 0, 1
REPEAT = 6

TOKEN = re.compile(r"[^\W\d_]+|\d+|[^\w\s]")

_random = np.random.default_rng(2)
PLACES = np.argsort(_random.random((BUCKETS, DIM)), axis=1)[:, :NONZERO]
SIGNS = _random.choice([-1, 1], (BUCKETS, NONZERO))
INDEX = np.zeros((BUCKETS, DIM))
np.put_along_axis(INDEX, PLACES, SIGNS, axis=1)
del _random


class Buckets(dict):
    """Token to bucket, remembered for the tokens seen lately."""

    def __missing__(self, token: str) -> int:
        if len(self) >= MEMO_WORDS:
            self.clear()
        capital = len(token) > 1 and token.isupper()
        value = self[token] = CAPITALS if capital else 2 + zlib.crc32(token.lower().encode("utf-8", "surrogatepass")) % (BUCKETS - 2)
        return value

    def of(self, text: str) -> np.ndarray:
        tokens = TOKEN.findall(text)
        ids = np.fromiter(map(self.__getitem__, tokens), np.int64, len(tokens))
        again = np.zeros(len(ids), bool)
        for back in (1, 2):
            again[back:] |= ids[back:] == ids[:-back]
        grams = gram_hashes(ids.astype(np.uint64) + np.uint64(1), REPEAT)
        if len(grams):
            first = np.zeros(len(grams), bool)
            first[np.unique(grams, return_index=True)[1]] = True
            again[: len(grams)] |= ~first
        ids[again] = AGAIN
        return ids


def _add_contexts(sums: np.ndarray, ids: np.ndarray) -> None:
    """Add the neighbours' index vectors to the sums; -1 separates documents."""
    for back in range(1, REACH + 1):
        one, two = ids[back:], ids[:-back]
        inside = (one >= 0) & (two >= 0)
        # Between two tokens, -1 may stand in the middle.
        for middle in range(1, back):
            inside &= ids[middle : len(ids) - back + middle] >= 0
        one, two = one[inside], two[inside]
        for word, neighbour in ((one, two), (two, one)):
            for k in range(NONZERO):
                sums += np.bincount(word * DIM + PLACES[neighbour, k], SIGNS[neighbour, k], len(sums)).astype(np.int64)


SUMS = "bucket int, n bigint, " + ", ".join(f"c{d} bigint" for d in range(DIM))


def _context_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    buckets, sums, counts = Buckets(), np.zeros(BUCKETS * DIM, np.int64), np.zeros(BUCKETS, np.int64)
    gap = np.full(1, -1, np.int64)
    for batch in small_batches(batches, "text", 4 << 20):
        parts = [x for text in batch.column("text").to_pylist() for x in (buckets.of(text or ""), gap)]
        if parts:
            ids = np.concatenate(parts)
            _add_contexts(sums, ids)
            counts += np.bincount(ids[ids >= 0], minlength=BUCKETS)
    used = np.flatnonzero(counts)
    table = sums.reshape(BUCKETS, DIM)[used]
    columns = [pa.array(used.astype(np.int32)), pa.array(counts[used]), *[pa.array(table[:, d].copy()) for d in range(DIM)]]
    yield pa.RecordBatch.from_arrays(columns, ["bucket", "n", *[f"c{d}" for d in range(DIM)]])


def word_vectors(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Vectors and weights of all buckets, from all documents: ``BUCKETS`` short rows, whatever the input."""
    partial = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(_context_sums, SUMS)
    rows = partial.groupBy("bucket").agg(F.sum("n"), *[F.sum(f"c{d}") for d in range(DIM)]).collect()
    sums, counts = np.zeros((BUCKETS, DIM)), np.zeros(BUCKETS)
    for row in rows:
        counts[row[0]], sums[row[0]] = row[1], row[2:]
    length = np.linalg.norm(sums, axis=1, keepdims=True)
    vectors = sums / np.where(length > 0, length, 1) + INDEX / np.sqrt(NONZERO)
    return vectors, COMMON / (COMMON + counts / max(1.0, counts.sum()))


def pooled(ids: np.ndarray, vectors: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Mean and spread of a document's word vectors, its share of repeats and capitals, and its length."""
    if not len(ids):
        return np.zeros(2 * DIM + 3)
    words, counts = np.unique(ids, return_counts=True)
    share = weights[words] * counts
    share = share / share.sum()
    mean = share @ vectors[words]
    spread = np.sqrt(np.maximum(share @ vectors[words] ** 2 - mean**2, 0))
    return np.concatenate([mean, spread, [np.mean(ids == AGAIN), np.mean(ids == CAPITALS), np.log1p(len(ids)) / 10]])


class Network:
    """Standardised inputs, one hidden layer, one output; probabilities at a temperature."""

    def __init__(self, x: np.ndarray, y: np.ndarray, seed: int = 7):
        random = np.random.default_rng(seed)
        self.prior, self.layers, self.temperature = (float(y.mean()) if len(y) else 0.5), None, 1.0
        if len(y) < 20 or len(np.unique(y)) < 2:
            return
        held = np.arange(len(y)) % 5 == 0
        self.centre, self.scale = x[~held].mean(0), x[~held].std(0) + 1e-3
        inputs, goal = (x[~held] - self.centre) / self.scale, y[~held]
        layers = [random.normal(0, inputs.shape[1] ** -0.5, (inputs.shape[1], HIDDEN)), np.zeros(HIDDEN), random.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(1)]
        first, second = [np.zeros_like(p) for p in layers], [np.zeros_like(p) for p in layers]
        for step in range(1, EPOCHS + 1):
            hidden = np.tanh(inputs @ layers[0] + layers[1])
            error = (1 / (1 + np.exp(-np.clip(hidden @ layers[2] + layers[3], -40, 40))) - goal) / len(goal)
            back = np.outer(error, layers[2]) * (1 - hidden**2)
            slopes = [inputs.T @ back, back.sum(0), hidden.T @ error, error.sum(keepdims=True)]
            for p, m, v, g in zip(layers, first, second, slopes):
                g = g + DECAY * p
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= LEARN_RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        self.layers = layers
        logits = self.logits(x[held])
        losses = [(np.mean(np.logaddexp(0, logits / t) - y[held] * logits / t), t) for t in np.geomspace(0.25, 8, 41)]
        self.temperature = float(min(losses)[1])

    def logits(self, x: np.ndarray) -> np.ndarray:
        hidden = np.tanh((x - self.centre) / self.scale @ self.layers[0] + self.layers[1])
        return hidden @ self.layers[2] + self.layers[3]

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.layers is None:
            return np.full(len(x), self.prior)
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -40, 40)))


def score_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of ``docs``."""
    context = docs.sparkSession.sparkContext
    table = context.broadcast(word_vectors(docs))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets, (vectors, weights) = Buckets(), table.value
        for batch in small_batches(batches, "text"):
            rows = [pooled(buckets.of(text or ""), vectors, weights).astype(np.float32).tobytes() for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(rows, pa.binary())], ["doc_id", "x"])

    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    pooled_docs = stored(texts.mapInArrow(features, "doc_id bigint, x binary"))
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy(F.col("doc_id").cast("bigint").alias("doc_id"))
    known = known.agg(F.max("quality").cast("int").alias("label")).where(fold != 0)
    sample = stored(smallest_hashes(known.withColumn("hash", F.xxhash64("doc_id")), "hash", FIT_ROWS).drop("hash"))
    rows = pooled_docs.dropDuplicates(["doc_id"]).join(F.broadcast(sample), "doc_id").orderBy("doc_id").collect()
    x = np.array([np.frombuffer(r.x, np.float32) for r in rows], float).reshape(len(rows), 2 * DIM + 3)
    network = context.broadcast(Network(x, np.array([r.label for r in rows], float)))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = np.frombuffer(b"".join(batch.column("x").to_pylist()), np.float32).reshape(batch.num_rows, -1)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(network.value.score(x.astype(float)))], ["doc_id", "score"])

    out = pooled_docs.mapInArrow(scored, "doc_id bigint, score double")
    return out.select(
        "doc_id",
        F.coalesce(fold == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
