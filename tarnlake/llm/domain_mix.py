"""Mixing to target weights with soft membership in domains.

A table of labelled documents defines the domains. A softmax regression on character-class pairs, word repetition and the
words that tell domains apart gives each document a posterior over domains. With tokens t, posteriors p and rates r
the expected tokens of domain k are the sum of t * p_k * r. Distributed projected-gradient least squares, starting from
rate 1, finds nonnegative rates whose expected totals match the targets.

The step is scaled: by tokens for each document and by the present total for each domain. In that metric the curvature is at
most 1, so a step of 1 always descends, and documents of like membership get like rates. Only one total per domain
reaches the driver in each step. Rates are not stored: the few residuals so far, replayed, give the rate of any document.

Word statistics cover all labelled rows; the regression is fitted on at most ``sample`` of them (a documented bound: the first by
a hash of id). Null and empty texts have no tokens; they get a rate but do not matter to totals. Labels that are null are left
out, and without labels all domains are equally likely. Repeated rows count as often as they come. Targets that cannot be
reached, as of a domain without documents, are approached as closely as least squares allow. An empty table gives an
empty one. All columns are kept; old columns of the names of the results are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarnlake.llm import textvec
from tarnlake.llm.common import need, small, stored
from tarnlake.llm.neighbour_quality import CLASS, CLASSES, STEPS

BUCKETS = 1 << 16
SHAPES = CLASSES * CLASSES + len(STEPS)
BROADCAST_ROWS = 1_000_000
# Weight of the squared coefficients against the mean loss.
RIDGE = 1e-3


def word_buckets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct word buckets of each text: (bucket, text)."""
    hashes, text = textvec.words(data, offsets, textvec.SIGNS)
    pair = np.unique(text * BUCKETS + (hashes % np.uint64(BUCKETS)).astype(np.int64))
    return pair % BUCKETS, pair // BUCKETS


@dataclass
class Model:
    """Chosen word buckets, feature means and scales, regression weights with the constant last."""

    buckets: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    def posteriors(self, x: np.ndarray) -> np.ndarray:
        z = (((x - self.mean) / self.scale) @ self.weights[:-1] + self.weights[-1]).astype(np.float64)
        e = np.exp(z - z.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)


def features(texts: pa.Array, buckets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(features, white-space words) in blocks of rows."""
    where = np.full(BUCKETS, -1)
    where[buckets] = np.arange(len(buckets))
    width = SHAPES + len(buckets)
    for _, data, offsets in textvec.pieces(texts, 1 << 20):
        for a in range(0, len(offsets) - 1, 256):
            part, ends = data[offsets[a] : offsets[min(a + 256, len(offsets) - 1)]], offsets[a : a + 257] - offsets[a]
            n = len(ends) - 1
            doc, kind = np.repeat(np.arange(n), np.diff(ends)), CLASS[part]
            pairs = (doc[:-1] * width + kind[:-1] * CLASSES + kind[1:])[doc[:-1] == doc[1:]]
            x = np.bincount(pairs, minlength=n * width).reshape(n, width).astype(np.float32)
            hashes, text = textvec.words(part, ends)
            count = np.bincount(text, minlength=n)
            # Shares rather than counts, so that length does not decide.
            x /= np.maximum(x.sum(axis=1, keepdims=True), 1)
            x = np.sqrt(x)
            again = text[1:][(hashes[1:] == hashes[:-1]) & (text[1:] == text[:-1])]
            x[:, CLASSES * CLASSES : SHAPES] = (np.bincount(again, minlength=n) / np.maximum(count, 1))[:, None] > STEPS
            bucket, text = word_buckets(part, ends)
            chosen = where[bucket] >= 0
            x[text[chosen], SHAPES + where[bucket[chosen]]] = 1
            yield x, count


def choose_words(labelled: DataFrame, domains: int, most: int = 256, least: float = 6.0) -> np.ndarray:
    """Word buckets whose documents differ from the whole by ``least`` standard deviations in some domain; at most ``most``.

    Each task adds up its own rows; what reaches the driver has a size fixed by buckets and domains."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(domains * (BUCKETS + 1), np.int64)
        for batch in batches:
            domain = batch.column(0).to_numpy()
            for rows, data, offsets in textvec.pieces(batch.column(1)):
                bucket, text = word_buckets(data, offsets)
                own = domain[rows].astype(np.int64) * (BUCKETS + 1)
                total += np.bincount(np.concatenate([own[text] + bucket, own + BUCKETS]), minlength=len(total))
        total = total.reshape(domains, BUCKETS + 1)
        k, b = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(b), pa.array(total[k, b])], names=["k", "b", "n"])

    found = labelled.select("domain", "t").mapInArrow(counted, "k long, b long, n long").groupBy("k", "b").agg(F.sum("n").alias("n")).toArrow()
    total = np.zeros((domains, BUCKETS + 1))
    total[found["k"].to_numpy(), found["b"].to_numpy()] = found["n"].to_numpy()
    share = total[:, BUCKETS:] / max(total[:, BUCKETS].sum(), 1)
    seen = total[:, :BUCKETS].sum(axis=0)
    far = np.abs(total[:, :BUCKETS] - share * seen) / np.sqrt(np.maximum(seen * share * (1 - share), 1e-9) + 1)
    best = np.where(share > 0, far, 0).max(axis=0)
    order = np.argsort(-best, kind="stable")[:most]
    return np.sort(order[best[order] >= least])


def fit(texts: DataFrame, known: DataFrame, domains: int, sample: int = 4000, rounds: int = 300, ridge: float = RIDGE) -> Model:
    """texts: (doc_id, t); known: stored (doc_id, domain from 0)."""
    buckets = choose_words(texts.join(small(known, BROADCAST_ROWS), "doc_id"), domains)
    # The ids are chosen before any text moves; there are ``sample`` of them at most.
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id", "domain").limit(sample)

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for x, _ in features(batch.column(1), buckets):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[at : at + len(x)], pa.array([r.tobytes() for r in x], pa.binary())], names=["domain", "x"])
                at += len(x)

    once = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "domain").agg(F.min("t").alias("t"))
    rows = once.select("domain", "t").mapInArrow(made, "domain int, x binary").toArrow()
    rows = rows.sort_by([("domain", "ascending"), ("x", "ascending")])
    y = rows["domain"].to_numpy()
    x = np.frombuffer(b"".join(rows["x"].to_pylist()), np.float32).reshape(len(y), SHAPES + len(buckets))
    if not len(y):
        return Model(buckets, np.zeros(x.shape[1]), np.ones(x.shape[1]), np.zeros((x.shape[1] + 1, domains)))
    mean = x.mean(axis=0)
    # A feature that hardly varies stays small; chosen words keep their full weight.
    scale = np.maximum(x.std(axis=0), 0.05)
    a = np.hstack([(x - mean) / scale, np.ones((len(y), 1), np.float32)])
    target = np.eye(domains, dtype=np.float32)[y]
    w = np.zeros((a.shape[1], domains), np.float32)
    # The largest singular value bounds the curvature.
    v = np.ones(a.shape[1], np.float32)
    for _ in range(30):
        v = a.T @ (a @ v)
        curve = float(np.linalg.norm(v))
        v /= curve
    ahead, step = w, np.float32(len(y) / (0.5 * 1.05 * curve))
    for k in range(rounds):
        z = a @ ahead
        e = np.exp(z - z.max(axis=1, keepdims=True))
        slope = a.T @ (e / e.sum(axis=1, keepdims=True) - target) / len(y) + np.float32(ridge) * ahead
        old, w = w, ahead - step * slope
        ahead = w + np.float32(k / (k + 3)) * (w - old)
    return Model(buckets, mean, scale, w)


def replay(p: np.ndarray, moves: np.ndarray, highest: float) -> np.ndarray:
    """Rates after all moves so far, from 1, cut at 0 (and at ``highest``) after each."""
    r = np.ones(len(p))
    for move in moves:
        r = np.clip(r - p @ move, 0, highest)
    return r


def mix(
    docs: DataFrame, labelled: DataFrame, targets: Sequence[float], budget: float | None = None, text: str = "text",
    rounds: int = 60, tolerance: float = 1e-4, sample: int = 4000, highest: float = float("inf"),
    capped: Sequence[int] = (),
) -> DataFrame:
    """Add n_tokens (words), posteriors, rate.

    labelled: (doc_id, domain), domains numbered from 0; targets: their weights. ``budget`` is the expected total of tokens
    (by default all there are). The target share of a ``capped`` domain is no more than the share present; the others take the rest.
    """
    need(docs, "doc_id", text)
    need(labelled, "doc_id", "domain")
    domains, weights = len(targets), np.asarray(targets, float) / sum(targets)
    known = stored(labelled.filter(F.col("doc_id").isNotNull() & F.col("domain").between(0, domains - 1)).select(
        "doc_id", F.col("domain").cast("int").alias("domain")), "domain-labels")
    texts = docs.select("doc_id", F.coalesce(F.col(text).cast("string"), F.lit("")).alias("t"))
    model = docs.sparkSession.sparkContext.broadcast(fit(texts, known, domains, sample))

    base = docs.drop(*({"n_tokens", "posteriors", "rate"} & set(docs.columns)))
    at = base.columns.index(text)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blocks = [(model.value.posteriors(x), n) for x, n in features(batch.column(at).cast(pa.string()), model.value.buckets)]
            if blocks:
                p, n = np.vstack([b for b, _ in blocks]), np.concatenate([b for _, b in blocks])
                lists = pa.FixedSizeListArray.from_arrays(pa.array(p.ravel()), domains).cast(pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(n), lists], names=[*batch.schema.names, "n_tokens", "posteriors"])

    schema = T.StructType([*base.schema.fields, T.StructField("n_tokens", T.LongType()), T.StructField("posteriors", T.ArrayType(T.DoubleType()))])
    weighed = base.mapInArrow(read, schema)
    return fit_rates(weighed, weights, budget, rounds, tolerance, highest, text, capped)


def member_sums(rows: DataFrame, moves: np.ndarray, domains: int, highest: float) -> np.ndarray:
    """Expected tokens of each domain at the rates the moves lead to; sums are partial in each task."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(domains)
        for batch in batches:
            p = batch.column(1).flatten().to_numpy().reshape(-1, domains)
            total += (batch.column(0).to_numpy() * replay(p, moves, highest)) @ p
        yield pa.RecordBatch.from_arrays([pa.array([v]) for v in total], names=[f"d{k}" for k in range(domains)])

    columns = [f"d{k}" for k in range(domains)]
    got = rows.mapInArrow(summed, ", ".join(f"{c} double" for c in columns)).agg(*(F.coalesce(F.sum(c), F.lit(0.0)) for c in columns)).first()
    return np.array(got)


def fit_rates(
    weighed: DataFrame, weights: np.ndarray, budget: float | None, rounds: int, tolerance: float, highest: float, text: str,
    capped: Sequence[int] = (),
) -> DataFrame:
    """Projected gradient on rows that carry n_tokens and posteriors."""
    domains = len(weights)
    # Only what the steps need is stored; the rows themselves, texts and all, are not copied.
    rows = stored(weighed.select("n_tokens", "posteriors"), "memberships")
    moves = np.zeros((0, domains))
    present = member_sums(rows, moves, domains, highest)
    if capped and present.sum() > 0:
        bound = np.isin(np.arange(domains), capped)
        held = np.where(bound, np.minimum(weights, present / present.sum()), 0)
        weights = np.where(bound, held, weights * (1 - held.sum()) / max(weights[~bound].sum(), 1e-9))
    goal = weights * (present.sum() if budget is None else budget)
    now = present
    for _ in range(rounds):
        away = now - goal
        if np.abs(away).sum() <= tolerance * max(goal.sum(), 1):
            break
        moves = np.vstack([moves, np.where(present > 0, away / np.maximum(present, 1e-9), 0)])
        now = member_sums(rows, moves, domains, highest)

    @F.pandas_udf("double")
    def rate(posteriors):
        import pandas as pd

        p = np.vstack(posteriors.to_numpy()) if len(posteriors) else np.zeros((0, domains))
        return pd.Series(np.round(replay(p, moves, highest), 9))

    return weighed.withColumn("rate", rate("posteriors"))


def drawn(mixed: DataFrame, text: str = "text", seed: int = 0, keep: Column | None = None) -> DataFrame:
    """Whole copies that come to the rates on average: each row as often as its rate, rounded up by a draw from its id and text.

    Rows where ``keep`` holds come once at least."""
    place = F.pmod(F.xxhash64("doc_id", text, F.lit(seed)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    copies = F.floor(F.col("rate") + place).cast("int")
    if keep is not None:
        copies = F.greatest(copies, keep.cast("int"))
    return mixed.withColumn("_copy", F.explode(F.when(copies > 0, F.sequence(F.lit(1), copies)).otherwise(F.array().cast("array<int>")))).drop("_copy")
