"""N-gram Jaccard self-join of documents by a token-group matrix.

A document is the set of its distinct runs of three words. Documents of equal sets are one node. For sets of nearby
sizes the hashes are dealt into m blocks, where m exceeds the most hashes in which two similar sets can
differ; a difference spoils one block at most, so at least the surplus is equal. Blocks are the tokens of the matrix:
documents that share enough of them are put into groups, a group keeps the union of its tokens, and a
document is compared with a group's members only if its overlap with that union reaches the bound (``linking``).
Shared runs alone, as of a passage found in many documents, fill hardly any block and cost nothing.

The join is exact up to 64-bit hashes. A size class also takes the sets just below it, for pairs across a border.

Null and blank texts have empty sets and link with nothing; fewer words than three are one run. A row without ``doc_id``
links nothing and has no component. Rows of one ``doc_id`` are placed by their own text: a node is an id with a set. Other columns
are ignored, and an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from tarnlake.llm import textvec
from tarnlake.llm.common import freed, need, small, stored
from tarnlake.llm.linking import differ, link_by_matrix, shared_postings

WIDTH = 1.5
BROADCAST_ROWS = 1_000_000


@cache
def block_numbers(percent: int, classes: int, start: int) -> tuple[tuple[int, int], ...]:
    """(upper end, blocks m) of each size class. m exceeds the most hashes in which two similar sets of the class can differ,
    and names the class, so no two classes have the same."""
    out: list[tuple[int, int]] = []
    end = start
    for _ in range(classes):
        most = 2 * end * (100 - percent) // (100 + percent)
        # The further apart similar sets may be, the more blocks there are anyway: fewer to spare then.
        spare = most // 2 if percent >= 90 else most // 8
        out.append((end, max(most + max(2, spare), out[-1][1] + 1 if out else 0)))
        end = max(end + 1, int(end * WIDTH))
    return tuple(out)


def blocks_of(hashes: np.ndarray, percent: int) -> list[tuple[int, int, list[int]]]:
    """For each size class a set is in: (blocks m, empty blocks, block tokens)."""
    size, out = len(hashes), []
    # Below this size no two different sets are similar.
    floor = 100 // (100 - percent) if percent < 100 else size + 2
    if size + 1 < floor:
        return out
    table = block_numbers(percent, 64, max(1, floor))
    own = next(c for c, (end, _) in enumerate(table) if size <= end)
    # A similar set may be as large as the next class's first size.
    classes = [own, own + 1] if size * 100 >= (table[own][0] + 1) * percent else [own]
    for c in classes:
        m = table[c][1]
        salt = np.uint64(c + 1)
        mixed = textvec.mix(hashes + salt)
        with np.errstate(over="ignore"):
            where = ((mixed >> np.uint64(32)) % np.uint64(m)).astype(np.int64)
            total = np.zeros(m, np.uint64)
            np.add.at(total, where, textvec.mix(mixed))
            full = np.bincount(where, minlength=m) > 0
            marks = textvec.mix(total + textvec.mix(np.arange(m, dtype=np.uint64) * np.uint64(1 << 20) + salt))
            tokens = marks[full].view(np.int64).tolist()
            empty = np.flatnonzero(~full)
            # Blocks that are equal whatever the partner; where they outnumber the empty ones, one of them is filled.
            equal = m - (size + size * 100 // percent) * (100 - percent) // (100 + percent)
            if len(empty) > 1 and equal <= len(empty):
                # Blocks empty in both are equal too. If all that two sets share is empty, they share two such: name the pairs.
                i, j = np.triu_indices(len(empty), 1)
                names = (empty[i].astype(np.uint64) << np.uint64(32)) + empty[j].astype(np.uint64)
                tokens += textvec.mix(textvec.mix(names) + salt * np.uint64(7919)).view(np.int64).tolist()
        out.append((m, len(empty), tokens))
    return out


def text_hash(text: str) -> Column:
    return F.xxhash64(F.col(text).cast("string"))


def signatures(docs: DataFrame, percent: int, size: int, text: str) -> DataFrame:
    """doc_id, th (hash of the text), n, f1, f2 (two hashes of the whole set) and the blocks of every document."""

    kind = pa.list_(pa.struct([("m", pa.int32()), ("free", pa.int32()), ("tokens", pa.list_(pa.int64()))]))

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in textvec.pieces(batch.column(2)):
                n = len(offsets) - 1
                h, ends = textvec.sets(*textvec.shingles(*textvec.words(data, offsets), size), n)
                found, f1, f2 = [], [], []
                with np.errstate(over="ignore"):
                    for a, b in zip(ends[:-1], ends[1:]):
                        found.append([{"m": m, "free": e, "tokens": t} for m, e, t in blocks_of(h[a:b], percent)])
                        f1.append(textvec.mix(h[a:b]).sum(dtype=np.uint64))
                        f2.append(textvec.mix(h[a:b] ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64))
                yield pa.RecordBatch.from_arrays([
                    batch.column(0)[rows], batch.column(1)[rows], pa.array(np.diff(ends)), pa.array(np.array(f1, np.uint64).view(np.int64)),
                    pa.array(np.array(f2, np.uint64).view(np.int64)), pa.array(found, kind)],
                    names=["doc_id", "th", "n", "f1", "f2", "blocks"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_hash(text).alias("th"), F.col(text).cast("string").alias("t")).mapInArrow(
        signed, "doc_id long, th long, n long, f1 long, f2 long, blocks array<struct<m:int,free:int,tokens:array<long>>>")


def token_sets(docs: DataFrame, size: int, text: str) -> DataFrame:
    """node (id and hash of the set) and tokens: the distinct shingle hashes of every document."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in textvec.pieces(batch.column(1)):
                h, ends = textvec.sets(*textvec.shingles(*textvec.words(data, offsets), size), len(offsets) - 1)
                with np.errstate(over="ignore"):
                    f1 = [textvec.mix(h[a:b]).sum(dtype=np.uint64) for a, b in zip(ends[:-1], ends[1:])]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0)[rows], pa.array(np.array(f1, np.uint64).view(np.int64)),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(h.view(np.int64)))], names=["doc_id", "f1", "tokens"])

    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).cast("string").alias("t")).mapInArrow(
        made, "doc_id long, f1 long, tokens array<long>")
    return found.select(F.struct("doc_id", "f1").alias("node"), "tokens")


def rooted(docs: DataFrame, percent: int, size: int, text: str) -> DataFrame:
    """doc_id, th, n, f1 and root (id and hash of the set of a group's first node) of every row."""
    need(docs, "doc_id", text)
    found = stored(signatures(docs, percent, size, text), "signatures")
    # Equal sets meet here once per task, however many copies there are.
    nodes = stored(found.filter("n > 0 and doc_id is not null").groupBy("n", "f1", "f2").agg(
        F.min(F.struct("doc_id", "f1")).alias("node"), F.first("blocks").alias("blocks")), "nodes")
    signed = stored(found.drop("blocks"), "signed")
    freed(found)
    rows = nodes.select("node", F.col("n").alias("size"), F.posexplode("blocks").alias("k", "b")).select(
        "node", "size", (F.col("k") > 0).alias("guest"), "b.m", "b.free", F.size("b.tokens").alias("all"), F.explode("b.tokens").alias("token"))
    shared = stored(shared_postings(rows), "postings")
    names = stored(nodes.select("n", "f1", "f2", "node"), "names")
    freed(nodes)
    # A document that shares too little even with the largest set it could be similar to is out.
    enough = F.col("c") + F.col("free") >= F.col("m") - differ(F.col("size"), F.floor(F.col("size") * 100 / percent), percent)
    wanted = stored(shared.groupBy("node", "m", "free", "size").agg(F.count("*").alias("c")).filter(enough).select("node").distinct(), "candidates")
    postings = stored(shared.join(wanted, "node", "left_semi"), "postings")
    freed(shared)
    chosen = docs.join(small(stored(wanted.select("node.doc_id").distinct(), "candidate-ids"), BROADCAST_ROWS), "doc_id", "left_semi")
    sets = token_sets(chosen, size, text).join(wanted, "node", "left_semi")
    sets = stored(sets.groupBy("node").agg(F.first("tokens").alias("tokens")), "sets")
    groups = link_by_matrix(postings, sets, percent)
    roots = names.join(groups, "node", "left").select(
        "n", "f1", "f2", F.coalesce("root", "node").alias("root"))
    return signed.select("doc_id", "th", "n", "f1", "f2").join(roots, ["n", "f1", "f2"], "left").select("doc_id", "th", "n", "f1", "root")


def join_documents(docs: DataFrame, percent: int = 90, size: int = 3, text: str = "text") -> DataFrame:
    """doc_id, n_shingles and component_id of every row."""
    return rooted(docs, percent, size, text).select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("root.doc_id", "doc_id")).alias("component_id"))


def representatives(docs: DataFrame, percent: int = 80, size: int = 5, text: str = "text") -> DataFrame:
    """One row of each group: of its first node, the text of the lowest hash; rows without id or words stay. All columns are kept."""
    joined = stored(rooted(docs, percent, size, text).filter("n > 0 and doc_id is not null"), "joined")
    rows = joined.groupBy("doc_id", "th").agg(F.count("*").alias("copies"), F.first("f1").alias("f1"), F.first("root").alias("root"))
    first = F.min("th").over(W.Window.partitionBy("doc_id", "f1"))
    judged = stored(rows.withColumn("stays", (F.struct("doc_id", "f1") == F.col("root")) & (F.col("th") == first)).select(
        F.col("doc_id").alias("_d"), F.col("th").alias("_th"), "copies", "stays"), "judged")
    same = (F.col("doc_id").cast("long") == F.col("_d")) & (text_hash(text) == F.col("_th"))
    gone = small(stored(judged.filter("not stays"), "copies"), BROADCAST_ROWS)
    left = docs.join(gone, same, "left_anti").select(*docs.columns)
    # The same row given again is a copy as well.
    again = stored(judged.filter("stays and copies > 1"), "again")
    if again.isEmpty():
        return left
    again = small(again, BROADCAST_ROWS)
    return left.join(again, same, "left_anti").select(*docs.columns).unionByName(
        left.join(again, same, "left_semi").select(*docs.columns).dropDuplicates(["doc_id", text]))


ORACLE = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i : i + 2], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS o FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT x, y FROM p JOIN n u ON x = u.doc_id JOIN n v ON y = v.doc_id WHERE 100 * o >= 90 * (u.n + v.n - o)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r AS (SELECT doc_id AS node, doc_id AS root FROM n UNION SELECT e.y, r.root FROM r JOIN e ON e.x = r.node)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, coalesce(m.root, d.doc_id) AS component_id
FROM d LEFT JOIN n ON d.doc_id = n.doc_id LEFT JOIN (SELECT node, min(root) AS root FROM r GROUP BY node) m ON d.doc_id = m.node"""
