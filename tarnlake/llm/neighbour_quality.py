"""Quality scores by nearest-neighbour voting in a latent-semantic space.

A text's terms are pairs of adjacent character classes, hashed words and steps of word repetition; only the
text is looked at. Labelled texts give term weights and a truncated singular value decomposition; every text is
projected onto it. Exact cosines with all labelled vectors are computed in blocks, and the labels of the
``neighbours`` nearest are weighted by a power of similarity.

The fit uses at most ``sample`` labelled rows (a documented bound: those that come first by a hash of their id).
The labelled vectors and the projection have sizes fixed by the parameters, so they are broadcast. Every document
is scored on its whole text.

Null and empty texts, and texts with no known term, score 0. Labels or ids that are null are left out of the fit; a
document labelled twice counts twice. With no labelled row at all every text scores 0. All neighbours
as near as the last one vote, so ties depend on no order. All columns are kept; an old ``score`` is replaced. An empty table
gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnlake.llm import textvec
from tarnlake.llm.common import need

HASHED = 1024
STEPS = np.array([0.02, 0.05, 0.1, 0.2, 0.3, 0.45, 0.6, 0.8])


def _classes() -> np.ndarray:
    """Character class of every byte: space, letters by case, digit, line end, beyond ASCII, each sign by itself."""
    out = np.zeros(256, np.int64)
    out[97:123], out[65:91], out[48:58], out[10], out[128:] = 1, 2, 3, 4, 5
    signs = [b for b in range(33, 127) if not out[b]]
    out[signs] = np.arange(6, 6 + len(signs))
    return out


CLASS = _classes()
CLASSES = int(CLASS.max()) + 1
TERMS = CLASSES * CLASSES + HASHED + len(STEPS)


def terms(texts: pa.Array) -> Iterator[np.ndarray]:
    """Damped term counts, in blocks of rows."""
    for _, data, offsets in textvec.pieces(texts, 1 << 20):
        n = len(offsets) - 1
        for a in range(0, n, 256):
            yield _terms(data[offsets[a] : offsets[min(a + 256, n)]], offsets[a : a + 257] - offsets[a])


def _terms(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    n = len(offsets) - 1
    doc = np.repeat(np.arange(n), np.diff(offsets))
    kind, same = CLASS[data], doc[:-1] == doc[1:]
    hashes, text = textvec.words(data, offsets)
    pairs = (doc[:-1] * TERMS + kind[:-1] * CLASSES + kind[1:])[same]
    hashed = text * TERMS + CLASSES * CLASSES + (hashes % np.uint64(HASHED)).astype(np.int64)
    out = np.log1p(np.bincount(np.concatenate([pairs, hashed]), minlength=n * TERMS).reshape(n, TERMS)).astype(np.float32)
    again = text[1:][(hashes[1:] == hashes[:-1]) & (text[1:] == text[:-1])]
    share = np.bincount(again, minlength=n) / np.maximum(np.bincount(text, minlength=n), 1)
    out[:, -len(STEPS) :] = 3 * (share[:, None] > STEPS)
    return out


@dataclass
class Space:
    """What scoring needs: projection with term weights, labelled vectors, their labels."""

    weights: np.ndarray
    axes: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray

    def project(self, counts: np.ndarray) -> np.ndarray:
        z = (counts * self.weights) @ self.axes
        return z / np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-9)

    def vote(self, counts: np.ndarray, neighbours: int, power: int) -> np.ndarray:
        if not len(self.labels):
            return np.zeros(len(counts))
        near = self.project(counts) @ self.vectors.T
        k = min(neighbours, len(self.labels))
        # Every labelled row at least as near as the k-th, so that ties do not depend on the blocks.
        bar = -np.partition(-near, k - 1, axis=1)[:, k - 1 : k]
        weight = np.where(near >= bar, np.maximum(near, 0), 0).astype(np.float64) ** power
        total = weight.sum(axis=1)
        voted = np.where(total > 0, weight @ self.labels / np.maximum(total, 1e-30), 0.0)
        return np.where(counts.any(axis=1), np.clip(voted, 0, 1), 0.0)


def fit(labelled: DataFrame, label: str, text: str = "text", sample: int = 3000, axes: int = 64, seed: int = 0) -> Space:
    """Term weights, decomposition and vectors of at most ``sample`` rows; ``labelled`` has doc_id, text and label."""
    rows = labelled.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).select(
        "doc_id", F.col(label).cast("double").alias("y"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("t"))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for block in terms(batch.column(2)):
                s = slice(at, at := at + len(block))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[s], batch.column(1)[s], pa.array([r.tobytes() for r in block], pa.binary())],
                    names=["doc_id", "y", "counts"])

    ordered = rows.orderBy(F.xxhash64("doc_id"), "doc_id", "y", F.xxhash64("t")).limit(sample)
    found = ordered.mapInArrow(counted, "doc_id long, y double, counts binary").toArrow()
    counts = np.frombuffer(b"".join(found["counts"].to_pylist()), np.float32).reshape(-1, TERMS)
    order = np.lexsort((found["y"].to_numpy(), found["doc_id"].to_numpy()))
    counts, labels = counts[order], found["y"].to_numpy()[order]
    if not len(labels):
        return Space(np.ones(TERMS, np.float32), np.zeros((TERMS, 1), np.float32), np.zeros((0, 1), np.float32), labels)
    weights = np.log((1 + len(labels)) / (1 + (counts > 0).sum(axis=0))).astype(np.float32)
    a = counts * weights
    a /= np.maximum(np.linalg.norm(a, axis=1, keepdims=True), 1e-9)
    # Truncated decomposition by subspace iteration from a fixed start.
    q = np.random.default_rng(seed).standard_normal((TERMS, axes + 16)).astype(np.float32)
    for _ in range(6):
        q, _r = np.linalg.qr(a.T @ (a @ q))
    _, _, vt = np.linalg.svd(a @ q, full_matrices=False)
    space = Space(weights, np.ascontiguousarray((q @ vt.T)[:, :axes]), np.zeros((0, axes), np.float32), labels)
    space.vectors = np.ascontiguousarray(space.project(counts))
    return space


def score(docs: DataFrame, space: Space, text: str = "text", neighbours: int = 15, power: int = 4) -> DataFrame:
    need(docs, text)
    shared = docs.sparkSession.sparkContext.broadcast(space)

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            blocks = [shared.value.vote(b, neighbours, power) for b in terms(pa.array(batch, pa.large_string()))]
            yield pd.Series(np.concatenate(blocks) if blocks else np.zeros(0))

    return docs.withColumn("score", scored(F.col(text).cast("string")))


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are kept for judging: remainder 2 of a checksum by 4."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, label: str, sample: int) -> DataFrame:
    """At most about ``sample`` labelled ids, chosen before any text is read, with their texts."""
    ids = labels.filter(~held_out(F.col("doc_id")) & F.col(label).isNotNull() & F.col("doc_id").isNotNull())
    ids = ids.select("doc_id", label).orderBy(F.xxhash64("doc_id"), "doc_id", label).limit(sample)
    # Bounded by ``sample``.
    return docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")
