"""Repeated passages: paragraphs that are near copies of each other, and equal runs of words wherever they lie.

A paragraph is a line with at least ``min_words`` words. Its set is its distinct runs of five words. The number of bands and
their rows are tuned so that a pair at the wanted similarity collides with the wanted probability. Paragraphs of equal sets
are one node; colliding nodes are verified by exact Jaccard similarity and joined into clusters by connected
components. The first occurrence of a cluster, by document and line, stays; the others are marked removed.

A passage is a run of ``least`` words or more that occurs elsewhere word for word, over several lines or inside one. The
first occurrence of each window of ``least`` words, by document and word, stays; runs of other occurrences that follow the same
first one are one passage. Each window is known by the lowest hash of its shorter runs: windows whose lowest hash
occurs once are passed over, by a bitmap of fixed size that only saves work. Neighbours of the same lowest hash are one chunk; equal
chunks are one node, and only nodes are opened into windows. Passages are exact up to 64-bit hashes.

Null and blank texts have no paragraphs, and shorter lines are never removed as such. Rows without ``doc_id`` are left out. Repeated
rows have the same place and so are kept or removed together. Other columns are ignored; an empty table gives an empty one.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from tarnlake.llm import textvec
from tarnlake.llm.common import freed, need, stored
from tarnlake.llm.linking import link_by_buckets, shared_postings


def tune(similarity: float, recall: float, hashes: int = 96) -> tuple[int, int]:
    """(bands, rows): the most rows for a band that still reach the recall within a number of hashes."""
    best = None
    for rows in range(1, hashes + 1):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - similarity**rows))
        if bands * rows <= hashes:
            best = (bands, rows)
    if best is None:
        raise ValueError("more hashes are needed for this recall")
    return best


def paragraphs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts of all lines with the end of the last, the text each is in, and its number there."""
    breaks = np.flatnonzero(data == 10) + 1
    starts = np.unique(np.concatenate([offsets[:-1], breaks[breaks < len(data)]]))
    text = np.searchsorted(offsets, starts, "right") - 1
    # A text that ends with a line break has no line after it; equal starts belong to the last text there.
    first = np.searchsorted(starts, offsets[text])
    return np.append(starts, len(data)), text, np.arange(len(starts)) - first


def signatures(docs: DataFrame, min_words: int, size: int, bands: int, rows: int, text: str, seed: int, sets: bool) -> DataFrame:
    """doc_id, paragraph, n_words, n, f1, f2 of every paragraph, with its band hashes or, for ``sets``, its shingles."""
    rng = np.random.default_rng(seed)
    odd = rng.integers(0, 2**63, bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for span, data, offsets in textvec.pieces(batch.column(1)):
                starts, owner, number = paragraphs(data, offsets)
                hashes, line = textvec.words(data, starts)
                count = np.bincount(line, minlength=len(owner))
                wanted = count >= min_words
                keep = wanted[line]
                names = np.cumsum(wanted) - 1
                at = np.flatnonzero(wanted)
                if not len(at):
                    continue
                h, ends = textvec.sets(*textvec.shingles(hashes[keep], names[line[keep]], size), len(at))
                with np.errstate(over="ignore"):
                    f1 = np.add.reduceat(textvec.mix(h), ends[:-1])
                    f2 = np.add.reduceat(textvec.mix(h ^ np.uint64(0x5851F42D4C957F2D)), ends[:-1])
                    if sets:
                        extra = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(h.view(np.int64)))
                    else:
                        marks = np.zeros((len(at), bands), np.uint64)
                        for b in range(bands):
                            for r in range(rows):
                                marks[:, b] = textvec.mix(marks[:, b] + np.minimum.reduceat(h * odd[b * rows + r], ends[:-1]) + np.uint64(b))
                        extra = pa.ListArray.from_arrays(
                            pa.array(np.arange(len(at) + 1) * bands, pa.int32()), pa.array(marks.ravel().view(np.int64)))
                ids = batch.column(0)[span].take(pa.array(owner[at]))
                yield pa.RecordBatch.from_arrays([
                    ids, pa.array(number[at], pa.int32()), pa.array(count[at]), pa.array(np.diff(ends)),
                    pa.array(f1.view(np.int64)), pa.array(f2.view(np.int64)), extra],
                    names=["doc_id", "paragraph", "n_words", "n", "f1", "f2", "tokens"])

    return docs.filter(F.col("doc_id").isNotNull()).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col(text).cast("string").alias("t")).mapInArrow(
        signed, "doc_id long, paragraph int, n_words long, n long, f1 long, f2 long, tokens array<long>")


def repeated_paragraphs(
    docs: DataFrame, percent: int = 80, size: int = 5, min_words: int = 40, recall: float = 0.9998, text: str = "text", seed: int = 1,
) -> DataFrame:
    """Every paragraph that is in a cluster of two or more: its cluster's first occurrence, the cluster's size, whether it goes."""
    need(docs, "doc_id", text)
    bands, rows = tune(percent / 100, recall)
    signed = stored(signatures(docs, min_words, size, bands, rows, text, seed, False), "paragraphs")
    place = F.struct("doc_id", "paragraph")
    # Equal paragraphs meet here once per task, however many copies there are.
    nodes = stored(signed.groupBy("n", "f1", "f2").agg(
        F.min(place).alias("node"), F.count("*").alias("copies"), F.first("tokens").alias("tokens")), "paragraph-nodes")
    lines = stored(signed.drop("tokens"), "lines")
    freed(signed)
    postings = stored(shared_postings(nodes.select("node", F.explode(F.array_distinct("tokens")).alias("token"))), "postings")
    names = stored(nodes.drop("tokens"), "paragraph-names")
    freed(nodes)
    wanted = stored(postings.select("node.doc_id").distinct(), "candidates")
    sets = signatures(docs.join(wanted, "doc_id", "left_semi"), min_words, size, bands, rows, text, seed, True)
    sets = sets.select(place.alias("node"), "tokens").join(postings.select("node").distinct(), "node", "left_semi")
    sets = stored(sets.dropDuplicates(["node", "tokens"]), "sets")
    groups = link_by_buckets(postings, sets, percent)
    placed = stored(names.select("n", "f1", "f2", "node", "copies").join(groups, "node", "left").select(
        "n", "f1", "f2", "copies", F.coalesce("root", "node").alias("root")), "placed")
    freed(postings, wanted, sets, names)
    sizes = placed.groupBy("root").agg(F.sum("copies").alias("cluster_size")).filter("cluster_size > 1")
    clusters = placed.join(sizes, "root").select("n", "f1", "f2", "root", "cluster_size")
    return lines.select("doc_id", "paragraph", "n_words", "n", "f1", "f2").join(clusters, ["n", "f1", "f2"]).select(
        "doc_id", "paragraph", "n_words", F.col("root.doc_id").alias("first_doc_id"), F.col("root.paragraph").alias("first_paragraph"),
        "cluster_size", (place != F.col("root")).alias("removed"))


# Bits of the bitmap of shared lowest hashes, in words of 64.
BITMAP = 1 << 27
INVERSE = np.uint64(pow(int(textvec._ODD), -1, 1 << 64))


def sliding(x: np.ndarray, n: int, pick: np.ufunc) -> np.ndarray:
    """Lowest or highest of every n neighbours."""
    span = 1
    while 2 * span <= n:
        x, span = pick(x[: max(len(x) - span, 0)], x[span:]), 2 * span
    return pick(x[: max(len(x) - n + span, 0)], x[n - span :]) if span < n else x


class Windows:
    """Windows of ``least`` words in a batch of texts: text of each word, hash of each window, its lowest shorter run."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, least: int):
        hashes, self.text = textvec.words(data, offsets)
        self.first = np.searchsorted(self.text, np.arange(len(offsets) - 1))
        n, self.gram = len(hashes), max(1, least * 3 // 8)
        self.reach = least - self.gram + 1
        with np.errstate(over="ignore"):
            self.back = np.cumprod(np.append(np.uint64(1), np.full(n, INVERSE)), dtype=np.uint64)
            self.total = np.append(np.uint64(0), np.cumsum(hashes * textvec.powers(n)[:n], dtype=np.uint64))
        self.valid = self.text[: max(n - least + 1, 0)] == self.text[least - 1 :]
        self.grams = self.runs(np.arange(max(n - self.gram + 1, 0)), self.gram)
        self.low = np.where(self.valid, sliding(self.grams, self.reach, np.minimum)[: len(self.valid)], np.uint64(0))

    def runs(self, at: np.ndarray, length: int | np.ndarray) -> np.ndarray:
        """Hash of the words [at, at + length), wherever they stand."""
        with np.errstate(over="ignore"):
            return textvec.mix((self.total[at + length] - self.total[at]) * self.back[at])

    def lowest(self) -> np.ndarray:
        """Places of shorter runs that are the lowest of a window; equal ones all count."""
        if not self.valid.any():
            return np.zeros(0, np.int64)
        edge = np.zeros(self.reach - 1, np.uint64)
        return np.flatnonzero(sliding(np.concatenate([edge, self.low, edge]), self.reach, np.maximum) == self.grams)


def lowest_runs(texts: DataFrame, least: int) -> DataFrame:
    """mark, doc_id, at: the lowest shorter runs of all windows."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for span, data, offsets in textvec.pieces(batch.column(1)):
                w = Windows(data, offsets, least)
                at = w.lowest()
                text = w.text[at]
                yield pa.RecordBatch.from_arrays([
                    pa.array(w.grams[at].view(np.int64)), batch.column(0)[span].take(pa.array(text)), pa.array(at - w.first[text], pa.int32())],
                    names=["mark", "doc_id", "at"])

    return texts.mapInArrow(found, "mark long, doc_id long, at int")


def bitmap(marks: DataFrame) -> np.ndarray:
    """The marks, modulo its size, as bits; what reaches the driver has at most BITMAP / 64 rows."""
    rows = marks.select(F.pmod("mark", F.lit(BITMAP)).cast("int").alias("m")).selectExpr(
        "shiftright(m, 6) AS k", "shiftleft(1L, m & 63) AS b").groupBy("k").agg(F.bit_or("b").alias("b")).toArrow()
    out = np.zeros(BITMAP // 64, np.int64)
    out[rows["k"].to_numpy()] = rows["b"].to_numpy()
    return out


def chunks(texts: DataFrame, least: int, bits) -> DataFrame:
    """c, doc_id, at, windows: neighbouring windows of one lowest run that is in the bitmap; c is a hash of all their words."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for span, data, offsets in textvec.pieces(batch.column(1)):
                w = Windows(data, offsets, least)
                bit = (w.low % np.uint64(BITMAP)).astype(np.int64)
                at = np.flatnonzero(w.valid & ((bits.value[bit >> 6] >> (bit & 63)) & 1 > 0))
                if not len(at):
                    continue
                new = np.append(True, (np.diff(at) > 1) | (w.low[at[1:]] != w.low[at[:-1]]) | (w.text[at[1:]] != w.text[at[:-1]]))
                ends = np.append(np.flatnonzero(new), len(at))
                start, count = at[ends[:-1]], np.diff(ends)
                text = w.text[start]
                c = textvec.mix(w.runs(start, count + least - 1) ^ count.astype(np.uint64))
                yield pa.RecordBatch.from_arrays([
                    pa.array(c.view(np.int64)), batch.column(0)[span].take(pa.array(text)), pa.array(start - w.first[text], pa.int32()),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(w.runs(at, least).view(np.int64)))],
                    names=["c", "doc_id", "at", "windows"])

    return texts.mapInArrow(found, "c long, doc_id long, at int, windows array<long>")


def repeated_passages(docs: DataFrame, least: int = 50, text: str = "text") -> DataFrame:
    """Every passage, as columns of ``repeated_paragraphs``; its number is -1 - w if it begins at word w of its text, from 0."""
    need(docs, "doc_id", text)
    texts = docs.filter(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).cast("string").alias("t"))
    place = F.struct("doc_id", "at")
    shared = lowest_runs(texts, least).groupBy("mark").agg(F.min(place).alias("a"), F.max(place).alias("b")).filter("a <> b").select("mark")
    found = stored(chunks(texts, least, docs.sparkSession.sparkContext.broadcast(bitmap(shared))), "chunks")
    # A task hands on one row for each chunk it met, whatever the number of copies.
    nodes = stored(found.groupBy("c").agg(F.min(place).alias("node"), F.count("*").alias("copies"), F.first("windows").alias("windows")), "chunk-nodes")
    cut = stored(found.select("c", "doc_id", "at"), "chunk-places")
    freed(found)
    opened = nodes.select("c", "copies", "node.doc_id", "node.at", F.posexplode("windows").alias("i", "h"))
    # Stored, so that a window that very many nodes share is split in the join.
    firsts = stored(opened.groupBy("h").agg(
        F.min(F.struct("doc_id", (F.col("at") + F.col("i")).alias("at"))).alias("f"), F.sum("copies").alias("n")).filter("n > 1"), "first-windows")
    # Runs of windows of a node that follow one first occurrence.
    at = opened.select("c", "i", "h").join(firsts.select("h", "f"), "h").select(
        "c", "i", F.col("f.doc_id").alias("first_doc_id"), (F.col("f.at") - F.col("i")).alias("shift"))
    row = F.row_number().over(W.Window.partitionBy("c", "first_doc_id", "shift").orderBy("i"))
    runs = stored(at.withColumn("run", F.col("i") - row).groupBy("c", "first_doc_id", "shift", "run").agg(
        F.min("i").alias("i"), F.count("*").alias("n")), "runs")
    freed(nodes, firsts)
    # The same runs in every copy of the node; those that touch are one.
    placed = cut.select("c", "doc_id", "at").join(runs, "c").select(
        "doc_id", "first_doc_id", (F.col("at") - F.col("shift")).alias("away"), (F.col("at") + F.col("i")).alias("start"),
        (F.col("at") + F.col("i") + F.col("n")).alias("end")).filter("doc_id <> first_doc_id or away <> 0")
    along = W.Window.partitionBy("doc_id", "first_doc_id", "away").orderBy("start", "end")
    before = F.max("end").over(along.rowsBetween(W.Window.unboundedPreceding, -1))
    joined = placed.withColumn("new", F.coalesce(F.col("start") > before, F.lit(True)).cast("int")).withColumn(
        "run", F.sum("new").over(along.rowsBetween(W.Window.unboundedPreceding, 0))).groupBy("doc_id", "first_doc_id", "away", "run").agg(
        F.min("start").alias("start"), F.max("end").alias("end"))
    gone = stored(joined.select(
        "doc_id", F.col("start").cast("int").alias("at"), (F.col("end") - F.col("start") + least - 1).cast("long").alias("n_words"),
        "first_doc_id", (F.col("start") - F.col("away")).cast("int").alias("first_at")), "passages")
    freed(cut, runs)
    first = stored(gone.groupBy("first_doc_id", "first_at").agg(F.max("n_words").alias("most"), (F.count("*") + 1).alias("cluster_size")), "first-passages")
    number = (-1 - F.col("first_at")).alias("first_paragraph")
    return gone.join(first, ["first_doc_id", "first_at"]).select(
        "doc_id", (-1 - F.col("at")).alias("paragraph"), "n_words", "first_doc_id", number, "cluster_size", F.lit(True).alias("removed")).unionByName(
        first.select(F.col("first_doc_id").alias("doc_id"), number.alias("paragraph"), F.col("most").alias("n_words"), "first_doc_id", number,
                     "cluster_size", F.lit(False).alias("removed")))


WORD = re.compile(r"[^\x20\x09-\x0D]+")


def without_words(text: str, passages: list[tuple[int, int]]) -> str:
    """The text without the passages (first word, words); line breaks stay, so lines keep their numbers."""
    spans = [m.span() for m in WORD.finditer(text)]
    out, done = [], 0
    for at, n in sorted(passages):
        start, end = max(spans[at][0], done), max(spans[min(at + n, len(spans)) - 1][1], done)
        out += [text[done:start], "\n" * text.count("\n", start, end)]
        done = end
    return "".join(out) + text[done:]


def without_repeats(docs: DataFrame, found: DataFrame, text: str = "text") -> DataFrame:
    """The documents with their removed paragraphs and passages cut out; all other columns as they were."""

    @F.pandas_udf("string")
    def cut(texts: pd.Series, passages: pd.Series) -> pd.Series:
        return pd.Series([t if t is None or p is None or not len(p) else without_words(t, [(x["at"], x["n"]) for x in p]) for t, p in zip(texts, passages)], dtype=object)

    gone = found.filter("removed").groupBy(F.col("doc_id").alias("_d")).agg(
        F.collect_set(F.when(F.col("paragraph") >= 0, F.col("paragraph"))).alias("_gone"),
        F.collect_set(F.when(F.col("paragraph") < 0, F.struct((-1 - F.col("paragraph")).alias("at"), F.col("n_words").alias("n")))).alias("_cut"))
    lines = F.filter(F.split("_t", "\n"), lambda line, i: ~F.array_contains("_gone", i))
    return docs.join(gone, docs["doc_id"] == gone["_d"], "left").withColumn("_t", cut(F.col(text), "_cut")).withColumn(
        text, F.when(F.col("_gone").isNull(), F.col(text)).otherwise(F.array_join(lines, "\n"))).select(*docs.columns)
