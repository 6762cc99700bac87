"""Token sequences in training order, as binary shards of a fixed record size.

Every text becomes token ids closed by an end mark, cut into sequences of ``length`` ids; the last one is
filled up with the mark. A sequence's place is made of the document's number, its id less the lowest, and the part.
A keyed Feistel network permutes places; results that name no place walk on through the cycle
until they do. Shards are equal ranges of permuted places, so a shard needs no sampling
and no count of what others hold. Sorted shards laid end to end give each sequence its global slot.

The order depends on key, ids and texts only, not on partitions. Equal places (repeated ``doc_id``) are ordered
by content. Ids may lie as far apart as 64 bits allow. Null and empty texts hold the mark alone; rows without ``doc_id`` have places
of their own. Other columns are ignored. An empty table gives no shard.

A record is: doc_id (int64, 0 if null), part (int32; -1 - part if doc_id is null), ids in use (int32), then ``length`` ids, little-endian:
uint16, or uint32 if the vocabulary and its mark need more than 16 bits.
"""

from __future__ import annotations

import base64
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnlake.llm.common import need, small, stored
from tarnlake.session import fresh_folder

HEAD = 16
ROUNDS = 4


def round_keys(key: str) -> list[int]:
    """Odd 31-bit multipliers and addends drawn from the key."""
    import hashlib

    raw = hashlib.sha256(key.encode()).digest()
    return [int.from_bytes(raw[4 * k : 4 * k + 4], "little") >> 1 | 1 for k in range(2 * ROUNDS)]


@dataclass(frozen=True)
class Places:
    """Places of sequences: document numbers 0 .. span - 1 times parts, and those of rows without id where there are any.

    A place is held as two halves of ``half`` bits, so that ids may lie as far apart as 64 bits allow."""

    span: int
    parts: int
    nulls: bool

    @property
    def widths(self) -> tuple[int, int, int]:
        """Bits of number and part, and of half a place."""
        number, part = max(1, (self.span - 1).bit_length()), (self.parts - 1).bit_length()
        return number, part, max(1, (number + part + int(self.nulls) + 1) // 2)

    def halves(self, null: np.ndarray, number: np.ndarray, part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n, p, half = self.widths
        if p >= half:
            low, high = part & ones(half), part >> np.uint64(half) | number << np.uint64(p - half)
        else:
            low, high = part | (number & ones(half - p)) << np.uint64(p), number >> np.uint64(half - p)
        return high | null.astype(np.uint64) << np.uint64(n + p - half), low

    def inside(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        """Whether the halves name a place there is."""
        n, p, half = self.widths
        null, rest = high >> np.uint64(n + p - half), high & ones(n + p - half)
        if p >= half:
            part, number = low | (rest & ones(p - half)) << np.uint64(half), rest >> np.uint64(p - half)
        else:
            part, number = low & ones(p), low >> np.uint64(p) | rest << np.uint64(half - p)
        known = (null == 0) & (number <= np.uint64(self.span - 1))
        return (known | ((null == 1) & (number == 0) & self.nulls)) & (part < np.uint64(self.parts))

    def permute(self, high: np.ndarray, low: np.ndarray, key: str) -> tuple[np.ndarray, np.ndarray]:
        """A bijection of the places, drawn by the key: a Feistel network walked on until it is back among them."""
        half, keys = self.widths[2], [np.uint64(k) for k in round_keys(key)]

        def network(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            for r in range(ROUNDS):
                mixed = (right + keys[2 * r + 1]) * keys[2 * r]
                mixed ^= mixed >> np.uint64(29)
                mixed *= np.uint64(0xBF58476D1CE4E5B9)
                mixed ^= mixed >> np.uint64(32)
                left, right = right, left ^ (mixed & ones(half))
            return left, right

        with np.errstate(over="ignore"):
            high, low = network(high, low)
            while (far := ~self.inside(high, low)).any():
                high[far], low[far] = network(high[far], low[far])
        return high, low

    def shard(self, high: np.ndarray, shards: int) -> np.ndarray:
        """Equal ranges of permuted places, by their leading bits."""
        half = self.widths[2]
        lead = min(half, 40)
        return ((high >> np.uint64(half - lead)) * np.uint64(shards) >> np.uint64(lead)).astype(np.int32)


def ones(bits: int) -> np.uint64:
    return np.uint64((1 << bits) - 1)


def load_ranks(path: str) -> dict[bytes, int]:
    source, name = pa.fs.FileSystem.from_uri(path) if "://" in path else (pa.fs.LocalFileSystem(), path)
    with source.open_input_stream(name) as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f.read().splitlines())}


def write_shards(
    docs: DataFrame, folder: str, ranks_path: str, pattern: str, key: str = "0", length: int = 512,
    shard_text: int = 64 << 20, text: str = "text",
) -> tuple[DataFrame, DataFrame]:
    """Write the shards and return (sequences, shards).

    Sequences: doc_id, part, n_tokens, shard, row, slot, offset (bytes into the shard's file).
    Shards: shard, first_slot, n_rows, file. ``shard_text`` is the text, in bytes, that a shard stands for.
    """
    need(docs, "doc_id", text)
    spark = docs.sparkSession
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("t"))
    # Tokens never outnumber bytes, which bounds the sequences of a document before any is cut.
    got = base.agg(
        F.min("doc_id"), F.max("doc_id"), F.max(F.octet_length("t")), F.sum(F.octet_length("t").cast("long")), F.count_if(F.col("doc_id").isNull())).first()
    low, high, longest, total, nulls = (0 if v is None else v for v in got)
    places = Places(high - low + 1, -(-(longest + 1) // length), nulls > 0)
    shards = max(1, -(-total // shard_text))
    ranks = load_ranks(ranks_path)
    shared, kind = spark.sparkContext.broadcast({"ranks": ranks, "pattern": pattern}), id_type(len(ranks))
    stride = HEAD + np.dtype(kind).itemsize * length

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken

        ranks = shared.value["ranks"]
        encoding = tiktoken.Encoding("shards", pat_str=shared.value["pattern"], mergeable_ranks=ranks, special_tokens={})
        mark = len(ranks)
        for batch in batches:
            ids, payloads, where, used, numbers = batch.column(0).to_pylist(), [], [], [], []
            for doc, text_ in zip(ids, batch.column(1).to_pylist()):
                tokens = np.append(np.frombuffer(encoding.encode_to_numpy(text_), dtype=np.uint32), mark).astype(kind)
                n = -(-len(tokens) // length)
                filled = np.full(n * length, mark, dtype=kind)
                filled[: len(tokens)] = tokens
                for part in range(n):
                    payloads.append(filled[part * length : (part + 1) * length].tobytes())
                    used.append(min(length, len(tokens) - part * length))
                    numbers.append((doc, part))
                    where.append((doc is None, 0 if doc is None else doc - low, part))
            null, number, part_ = (np.array(x, np.uint64) for x in (zip(*where) if where else ((), (), ())))
            front, back = places.permute(*places.halves(null, number, part_), key)
            shard = places.shard(front, shards)
            front, back = front.astype(np.int64), back.astype(np.int64)
            for k in range(0, len(shard), 2000):
                s = slice(k, k + 2000)
                yield pa.RecordBatch.from_arrays([
                    pa.array([d for d, _ in numbers[s]], pa.int64()), pa.array([p for _, p in numbers[s]], pa.int32()),
                    pa.array(used[s], pa.int32()), pa.array(front[s]), pa.array(back[s]), pa.array(shard[s]),
                    pa.array(payloads[s], pa.binary())], names=["doc_id", "part", "n_tokens", "front", "back", "shard", "payload"])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target, root = pa.fs.FileSystem.from_uri(folder)
        target.create_dir(root, recursive=True)
        now, out, row, partial = None, None, 0, ""

        def close() -> None:
            if out is not None:
                out.close()
                # Rename last: a lost or repeated attempt never shows half a shard, and all attempts write the same bytes.
                target.move(partial, f"{root}/shard-{now:07d}.bin")

        for batch in batches:
            shard, doc, part, used, payload = (batch.column(k).to_pylist() for k in ("shard", "doc_id", "part", "n_tokens", "payload"))
            rows = []
            for s, d, p, u, body in zip(shard, doc, part, used, payload):
                if s != now:
                    close()
                    now, row, partial = s, 0, f"{root}/.partial-{s:07d}-{uuid.uuid4().hex}"
                    out = target.open_output_stream(partial)
                out.write(np.array([d or 0], "<i8").tobytes() + np.array([-1 - p if d is None else p, u], "<i4").tobytes() + body)
                rows.append(row)
                row += 1
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("part"), batch.column("n_tokens"), batch.column("shard"), pa.array(rows, pa.int64())],
                names=["doc_id", "part", "n_tokens", "shard", "row"])
        close()

    cuts = base.mapInArrow(cut, "doc_id long, part int, n_tokens int, front long, back long, shard int, payload binary")
    ordered = cuts.repartitionById(shards, F.col("shard")).sortWithinPartitions("shard", "front", "back", "payload")
    rows = stored(ordered.mapInArrow(write, "doc_id long, part int, n_tokens int, shard int, row long"), "sequences")
    # One row per shard: their number is known, so the running total may sit in one task.
    sizes = rows.groupBy("shard").agg(F.count("*").alias("n_rows"))
    manifest = stored(sizes.select(
        "shard", "n_rows",
        F.expr("coalesce(sum(n_rows) over (order by shard rows between unbounded preceding and 1 preceding), 0)").alias("first_slot"),
        F.format_string("shard-%07d.bin", F.col("shard")).alias("file")), "manifest")
    sequences = rows.join(small(manifest, 100_000), "shard").select(
        "doc_id", "part", "n_tokens", "shard", "row",
        (F.col("first_slot") + F.col("row")).alias("slot"), (F.col("row") * stride).alias("offset"))
    return sequences, manifest


def id_type(highest: int) -> str:
    """The narrowest type that holds all ids up to the mark."""
    return "<u2" if highest < 1 << 16 else "<u4"


def read_sequences(folder: str, manifest: list, length: int, start: int = 0, kind: str = "<u2") -> Iterator[tuple[int, int | None, int, np.ndarray]]:
    """Sequences from slot ``start`` on, in order, without touching earlier ones: (slot, doc_id, part, ids)."""
    source, root = pa.fs.FileSystem.from_uri(folder)
    stride = HEAD + np.dtype(kind).itemsize * length
    for entry in sorted(manifest, key=lambda r: r["shard"]):
        first, count = entry["first_slot"], entry["n_rows"]
        if first + count <= start:
            continue
        skip = max(0, start - first)
        with source.open_input_file(f"{root}/{entry['file']}") as f:
            f.seek(skip * stride)
            for row in range(skip, count):
                record = f.read(stride)
                part, used = np.frombuffer(record, "<i4", 2, 8)
                doc, part = (None, -1 - int(part)) if part < 0 else (int(np.frombuffer(record, "<i8", 1)[0]), int(part))
                yield first + row, doc, part, np.frombuffer(record, kind, used, HEAD)


def shard_folder(spark: SparkSession) -> str:
    """A new folder for shards below the shared one, as a URI."""
    path = fresh_folder(spark, "shards")
    return path if "://" in path or path.startswith("/") else path.replace("file:/", "file:///", 1)


