"""Near copies of documents by one-permutation MinHash.

A document is the set of its distinct runs of five words. One hash deals the set into bins, and a bin keeps its lowest
value. An empty bin takes the value of a filled one, found by a hash of its own number and of the attempt (optimal
densification), so a bin of two sets agrees as often as the sets are similar, however small they are. The bins are
cut into bands, whose hashes are buckets. In a bucket candidates are edges of a star around its most popular member, one for
each node; groups that meet in a bucket without such an edge are compared in blocks (``linking``), so that no link is lost
to the star. Links are confirmed on the full sets. Documents of equal sets are one node from the start.

``bands`` and ``rows`` decide what is missed: a pair at the wanted similarity s shares no bucket with
probability (1 - s^rows)^bands, 2e-6 by default. All else is exact up to 64-bit hashes.

Null and blank texts have empty sets and link with nothing; fewer words than five are one run, and sets so small that no other
set can be similar link with equal ones only. A row without ``doc_id`` links nothing, has no component and is kept. Rows of one
``doc_id`` are placed by their own text, and repeated rows are kept or dropped together. Other columns are ignored, and an
empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnlake.llm import textvec
from tarnlake.llm.common import need, small, stored
from tarnlake.llm.linking import link_by_buckets

BROADCAST_ROWS = 1_000_000
EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def donors(bins: np.ndarray, attempt: int, k: int) -> np.ndarray:
    """The bin that each empty bin looks at in this attempt; the same for all sets."""
    with np.errstate(over="ignore"):
        seen = textvec.mix(bins.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(attempt) * np.uint64(0xD1B54A32D192ED03))
        return ((seen >> np.uint64(32)) % np.uint64(k)).astype(np.int64)


def bins_of(hashes: np.ndarray, ends: np.ndarray, k: int) -> np.ndarray:
    """One row of k values for each set hashes[ends[i]:ends[i + 1]]; sets must not be empty."""
    n = len(ends) - 1
    owner = np.repeat(np.arange(n), np.diff(ends))
    with np.errstate(over="ignore"):
        dealt = textvec.mix(hashes + np.uint64(0x2545F4914F6CDD1D))
    out = np.full(n * k, EMPTY)
    place = owner * k + ((dealt >> np.uint64(40)) % np.uint64(k)).astype(np.int64)
    np.minimum.at(out, place, textvec.mix(dealt))
    out = out.reshape(n, k)
    filled = out != EMPTY
    row, bin_ = np.nonzero(~filled)
    attempt = 0
    while len(row):
        attempt += 1
        from_ = donors(bin_, attempt, k)
        found = filled[row, from_]
        out[row[found], bin_[found]] = out[row[found], from_[found]]
        row, bin_ = row[~found], bin_[~found]
    return out


def band_marks(values: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """Bucket of each band: a hash of its bins and its number."""
    marks = np.zeros((len(values), bands), np.uint64)
    with np.errstate(over="ignore"):
        for b in range(bands):
            mark = np.full(len(values), np.uint64(b + 1))
            for r in range(rows):
                mark = textvec.mix(mark + values[:, b * rows + r])
            marks[:, b] = mark
    return marks


def least_size(percent: int) -> int:
    """The size a set must have for a different set to be similar to it."""
    return -(-percent // (100 - percent)) if percent < 100 else 1 << 62


def signatures(docs: DataFrame, percent: int, size: int, bands: int, rows: int, text: str) -> DataFrame:
    """doc_id, n, f1, f2 (two hashes of the whole set) and the buckets of every row."""
    least = least_size(percent)

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for span, data, offsets in textvec.pieces(batch.column(1)):
                n = len(offsets) - 1
                h, ends = textvec.sets(*textvec.shingles(*textvec.words(data, offsets), size), n)
                sizes = np.diff(ends)
                with np.errstate(over="ignore"):
                    sums = [np.append(np.uint64(0), np.cumsum(textvec.mix(h ^ np.uint64(s)), dtype=np.uint64)) for s in (0, 0x5851F42D4C957F2D)]
                    f1, f2 = (s[ends[1:]] - s[ends[:-1]] for s in sums)
                large = np.flatnonzero(sizes >= least)
                counts = np.zeros(n, np.int64)
                counts[large] = bands
                inside = np.repeat(sizes >= least, sizes)
                marks = np.zeros((0, bands), np.uint64)
                if len(large):
                    marks = band_marks(bins_of(h[inside], np.append(0, np.cumsum(sizes[large])), bands * rows), bands, rows)
                buckets = pa.ListArray.from_arrays(
                    pa.array(np.append(0, np.cumsum(counts)), pa.int32()), pa.array(marks.ravel().view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[span], pa.array(sizes), pa.array(f1.view(np.int64)), pa.array(f2.view(np.int64)), buckets],
                    names=["doc_id", "n", "f1", "f2", "buckets"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).cast("string").alias("t")).mapInArrow(
        signed, "doc_id long, n long, f1 long, f2 long, buckets array<long>")


def full_sets(docs: DataFrame, size: int, text: str) -> DataFrame:
    """doc_id, f1 and tokens: the distinct shingle hashes of every row."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for span, data, offsets in textvec.pieces(batch.column(1)):
                h, ends = textvec.sets(*textvec.shingles(*textvec.words(data, offsets), size), len(offsets) - 1)
                with np.errstate(over="ignore"):
                    total = np.append(np.uint64(0), np.cumsum(textvec.mix(h), dtype=np.uint64))
                    f1 = total[ends[1:]] - total[ends[:-1]]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0)[span], pa.array(f1.view(np.int64)),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(h.view(np.int64)))], names=["doc_id", "f1", "tokens"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).cast("string").alias("t")).mapInArrow(
        made, "doc_id long, f1 long, tokens array<long>")


def near_copies(docs: DataFrame, percent: int = 85, size: int = 5, bands: int = 28, rows: int = 6, text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row; the smallest doc_id of a component is kept."""
    need(docs, "doc_id", text)
    signed = stored(signatures(docs, percent, size, bands, rows, text), "minhash-signatures")
    node = F.struct("doc_id", "f1")
    # Equal sets meet here once per task, however many copies there are.
    nodes = stored(signed.filter("n > 0 and doc_id is not null").groupBy("n", "f1", "f2").agg(
        F.min(node).alias("node"), F.first("buckets").alias("buckets")), "minhash-nodes")
    rows_ = nodes.select("node", F.explode("buckets").alias("token"))
    # Counts are partial before they move, and a hot bucket's rows can be split in the join.
    full = rows_.groupBy("token").agg(F.count("*").alias("n")).filter("n > 1")
    postings = stored(rows_.join(full, "token").select("token", "node", "n"), "minhash-buckets")
    members = stored(postings.select("node").distinct(), "minhash-members")
    ids = small(stored(members.select("node.doc_id").distinct(), "minhash-ids"), BROADCAST_ROWS)
    sets = full_sets(docs.join(ids, "doc_id", "left_semi"), size, text).select(node.alias("node"), "tokens")
    sets = sets.join(members, "node", "left_semi").groupBy("node").agg(F.first("tokens").alias("tokens"))
    groups = link_by_buckets(postings, stored(sets, "minhash-sets"), percent)
    roots = nodes.select("n", "f1", "f2", "node").join(groups, "node", "left").select(
        "n", "f1", "f2", F.coalesce("root", "node")["doc_id"].alias("root"))
    named = signed.select("doc_id", "n", "f1", "f2").join(roots, ["n", "f1", "f2"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("root", "doc_id"))
    return named.select(
        "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))


ORACLE = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS o FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT x, y FROM p JOIN n u ON x = u.doc_id JOIN n v ON y = v.doc_id WHERE 100 * o >= 85 * (u.n + v.n - o)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r AS (SELECT doc_id AS node, doc_id AS root FROM n UNION SELECT e.y, r.root FROM r JOIN e ON e.x = r.node),
m AS (SELECT node, min(root) AS root FROM r GROUP BY node)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, coalesce(m.root, d.doc_id) AS component_id,
  coalesce(m.root, d.doc_id) = d.doc_id AS kept
FROM d LEFT JOIN n ON d.doc_id = n.doc_id LEFT JOIN m ON d.doc_id = m.node"""
