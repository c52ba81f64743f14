"""A quality classifier: random-indexing word vectors, pooled per document, and a small network.

*Word vectors.* Words are hashed into a fixed number of buckets. Every bucket has a sparse index vector by a
rule, and its context vector is the sum of the index vectors of its neighbours in all documents. Sums are
made in each task and streamed together per block of buckets, so the vectors take the same space for any
corpus. *Documents* are the mean and the spread of their words' vectors, rare words weighing more. *The
network* has one hidden layer and one output, trained with numpy on a bounded sample of labelled rows
(``SAMPLE``); a temperature found on a part of them that it did not see makes its scores probabilities.

Null and empty texts pool to zeros and get the score that the network has for them. Rows without a label
teach nothing; with no label, or one kind only, all scores are the smoothed share of label 1. Repeated rows
are scored and learned row by row. Result columns replace columns of the same name; others are kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.llm.common import appended, bytes_of, map_batches, mix, pieces, texts_of, with_columns, word_hashes, words_of

#: Word buckets, length of their vectors, non-zero entries of an index vector, words to each side.
BUCKETS, LENGTH, ENTRIES, REACH = 1 << 14, 48, 4, 2
#: Labelled rows that the network is trained on, at most.
SAMPLE = 20_000
#: Buckets that are summed and sent together.
BLOCK = 256


def index_vectors(seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the non-zero entries of each bucket's index vector."""
    bits = mix(np.arange(BUCKETS * ENTRIES, dtype=np.uint64) + np.uint64(seed << 32)).reshape(BUCKETS, ENTRIES)
    places = (bits >> np.uint64(8)) % np.uint64(LENGTH)
    return places.astype(np.int64), np.where(bits & np.uint64(1), 1.0, -1.0).astype(np.float32)


def buckets_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of each word as written, and where each text's words begin."""
    data, offsets = bytes_of(texts)
    starts, ends, firsts = words_of(data, offsets)
    return (word_hashes(data, starts, ends, lower=False) % np.uint64(BUCKETS)).astype(np.int64), firsts


# ---- word vectors -------------------------------------------------------------------------------


def add_contexts(sums: np.ndarray, counts: np.ndarray, words: np.ndarray, firsts: np.ndarray) -> None:
    """Add to every word's row the index vectors of the words up to ``REACH`` away in its document."""
    places, signs = index_vectors()
    counts += np.bincount(words, minlength=BUCKETS)
    doc = np.repeat(np.arange(len(firsts) - 1), np.diff(firsts))
    for step in range(1, REACH + 1):
        same = doc[step:] == doc[:-step]
        left, right = words[:-step][same], words[step:][same]
        for a, b in ((left, right), (right, left)):
            for entry in range(ENTRIES):
                np.add.at(sums.reshape(-1), a * LENGTH + places[b, entry], signs[b, entry])


def word_vectors(docs: DataFrame, text_col: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """Vector of unit length and count of each bucket, from all of ``docs``."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((BUCKETS, LENGTH), np.float32), np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for part in pieces(batch, "text"):
                add_contexts(sums, counts, *buckets_of(texts_of(part, "text")))
        if counts.any():
            yield _blocks({b: (sums[b * BLOCK :][:BLOCK], counts[b * BLOCK :][:BLOCK]) for b in range(BUCKETS // BLOCK)})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for block, raw, numbers in zip(*(column.to_pylist() for column in batch.columns)):
                sums, counts = held.setdefault(block, (np.zeros((BLOCK, LENGTH)), np.zeros(BLOCK, np.int64)))
                sums += np.frombuffer(raw, np.float32).reshape(BLOCK, LENGTH)
                counts += np.frombuffer(numbers, np.int64)
        if held:
            yield _blocks(held)

    schema = "block int, sums binary, counts binary"
    texts = docs.select(F.col(text_col).cast("string").alias("text")).filter("text is not null")
    added = map_batches(map_batches(texts, gather, schema).repartition("block"), add, schema)
    sums, counts = np.zeros((BUCKETS, LENGTH), np.float64), np.zeros(BUCKETS, np.int64)
    for row in added.collect():  # BUCKETS / BLOCK rows
        at = slice(row["block"] * BLOCK, (row["block"] + 1) * BLOCK)
        sums[at] = np.frombuffer(row["sums"], np.float32).reshape(BLOCK, LENGTH)
        counts[at] = np.frombuffer(row["counts"], np.int64)
    if counts.any():
        sums /= np.maximum(counts, 1)[:, None]
        sums -= np.average(sums, 0, counts)
    size = np.linalg.norm(sums, axis=1, keepdims=True)
    return (sums / np.maximum(size, 1e-12) * (counts > 0)[:, None]).astype(np.float32), counts


def _blocks(blocks: dict[int, tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(
        {
            "block": pa.array(list(blocks), pa.int32()),
            "sums": pa.array([s.astype(np.float32).tobytes() for s, _ in blocks.values()], pa.binary()),
            "counts": pa.array([n.tobytes() for _, n in blocks.values()], pa.binary()),
        }
    )


def pool(texts: pa.Array, vectors: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Weighted mean and spread of the words' vectors of each text."""
    words, firsts = buckets_of(texts)
    out = np.zeros((len(texts), 2 * LENGTH), np.float32)
    rows = np.flatnonzero(np.diff(firsts))
    if len(rows):
        share = counts / max(counts.sum(), 1)
        weights = (1e-3 / (1e-3 + share)).astype(np.float32)[words, None]
        some = vectors[words]
        at = firsts[rows]
        total = np.add.reduceat(weights, at, 0)
        mean = np.add.reduceat(some * weights, at, 0) / total
        square = np.add.reduceat(some * some * weights, at, 0) / total
        out[rows, :LENGTH] = mean
        out[rows, LENGTH:] = np.sqrt(np.maximum(square - mean * mean, 0))
    return out


# ---- the network --------------------------------------------------------------------------------


@dataclass(frozen=True)
class Network:
    centre: np.ndarray
    scale: np.ndarray
    hidden: np.ndarray
    hidden_bias: np.ndarray
    out: np.ndarray
    out_bias: float
    temperature: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.centre) / self.scale @ self.hidden + self.hidden_bias) @ self.out + self.out_bias

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -50, 50)))


def train(x: np.ndarray, y: np.ndarray, units: int = 24, passes: int = 40, batch: int = 128, seed: int = 7) -> Network:
    """Fit on four fifths of the rows by Adam, and the temperature on the rest."""
    n, width = x.shape
    if len(set(y.tolist())) < 2:
        share = (y.sum() + 1) / (n + 2)
        zeros = np.zeros((width, units))
        return Network(np.zeros(width), np.ones(width), zeros, zeros[0], zeros[0], float(np.log(share / (1 - share))), 1.0)
    rng = np.random.default_rng(seed)
    order = rng.permutation(n)
    kept = order[: max(1, n // 5)] if n >= 50 else order
    used = order[len(kept) :] if n >= 50 else order
    centre, scale = x[used].mean(0), x[used].std(0) + 1e-4
    scaled = (x - centre) / scale
    state = [
        rng.normal(0, width**-0.5, (width, units)),
        np.zeros(units),
        rng.normal(0, units**-0.5, units),
        np.array(np.log((y[used].sum() + 1) / (len(used) - y[used].sum() + 1))),
    ]
    first, second = [np.zeros_like(p) for p in state], [np.zeros_like(p) for p in state]
    count = 0
    for _ in range(passes):
        for at in np.array_split(rng.permutation(used), max(1, len(used) // batch)):
            inner = np.tanh(scaled[at] @ state[0] + state[1])
            wrong = (1 / (1 + np.exp(-np.clip(inner @ state[2] + state[3], -50, 50))) - y[at]) / len(at)
            back = np.outer(wrong, state[2]) * (1 - inner * inner)
            grads = [scaled[at].T @ back + 1e-3 * state[0], back.sum(0), inner.T @ wrong + 1e-3 * state[2], wrong.sum()]
            count += 1
            for p, g, m, v in zip(state, grads, first, second):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= 3e-3 * (m / (1 - 0.9**count)) / (np.sqrt(v / (1 - 0.999**count)) + 1e-8)
    plain = Network(centre, scale, *state[:3], float(state[3]), 1.0)
    logits = plain.logits(x[kept])
    sign = np.where(y[kept] > 0, 1.0, -1.0)
    grid = np.geomspace(0.25, 8, 81)
    loss = [np.logaddexp(0, -sign * logits / t).mean() for t in grid]
    return Network(centre, scale, *state[:3], float(state[3]), float(grid[int(np.argmin(loss))]))


# ---- the operator -------------------------------------------------------------------------------


@dataclass(frozen=True)
class QualityModel:
    vectors: np.ndarray
    counts: np.ndarray
    network: Network

    def scores(self, texts: pa.Array) -> np.ndarray:
        return self.network.probabilities(pool(texts, self.vectors, self.counts))


def learn_quality(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality"
) -> QualityModel:
    """Word vectors from all of ``docs``, the network from ``labels`` (id and 0 or 1), ``SAMPLE`` of them at most."""
    vectors, counts = word_vectors(docs, text_col)
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((vectors, counts))

    def pooled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                rows = pool(texts_of(part, "text"), *shared.value)
                flat = pa.array(rows.reshape(-1), pa.float32())
                lists = pa.FixedSizeListArray.from_arrays(flat, rows.shape[1]).cast(pa.list_(pa.float32()))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), lists], names=["id", "y", "x"])

    chosen = (
        labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("double").alias("y"))
        .filter("id is not null and y in (0, 1)")
        .orderBy(F.xxhash64("id"), "id", "y")
        .limit(SAMPLE)
    )
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    # SAMPLE rows at most
    known = texts.join(F.broadcast(chosen), "id").select("id", "text", "y")
    some = map_batches(known, pooled, f"id {dict(texts.dtypes)['id']}, y double, x array<float>")
    rows = some.orderBy(F.xxhash64("id"), "id", "y", "x").limit(SAMPLE).toArrow()
    y = rows.column("y").to_numpy()
    x = np.array(rows.column("x").to_pylist(), np.float64).reshape(len(y), 2 * LENGTH)
    return QualityModel(vectors, counts, train(x, y))


def score_quality(docs: DataFrame, model: QualityModel, text_col: str = "text", out_col: str = "score") -> DataFrame:
    """``docs`` with the probability of label 1 for each whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, text_col):
                yield with_columns(part, {out_col: pa.array(shared.value.scores(texts_of(part, text_col)), pa.float64())})

    return map_batches(docs, work, appended(docs, f"`{out_col}` double"))
