"""Alignment of two tokenizers' tokens over the same bytes, in Arrow columns.

Both encode space and text. Lists of ids are flattened, parent indices say whose each token is, and running sums of token
lengths, taken anew in each document, are the byte at which each token ends. A full outer hash join of both sides on (document,
end) gives every stretch of bytes that one token of each side covers: one link for each pair of tokens that overlap. Ends met by
both cut the groups. Id pairs are counted per batch by Arrow's group-by, runs of batches are merged in the task and all of them
by Spark. The second pass looks the corpus counts up for every link.

Null and empty texts, and texts whose joined token bytes on either side differ from space and text, have no tokens: zeros and an
empty digest. Every row stands for itself, so repeated rows, ties and null ``doc_id`` change nothing but the counts. Texts
are never cut: a long one makes a batch by itself. Other columns are ignored, and an empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnlake.llm import textvec
from tarnlake.llm.common import need, stored
from tarnlake.llm.token_counts import byte_letters

# Pairs up to which their counts are broadcast: 16 bytes each. Beyond it links meet them in a shuffle join.
BROADCAST_PAIRS = 3_000_000
# Pairs a task holds before it hands its partial counts on.
HELD_PAIRS = 500_000
ALIGNED = "key long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, a binary, b binary"
# Link ids are held as bytes, so that nothing handles them one by one between tasks.
IDS = np.dtype("<u4")
PAIR = pa.schema([("a", pa.int32()), ("b", pa.int32()), ("n", pa.int64())])


def file_bytes(path: str) -> bytes:
    source, name = pa.fs.FileSystem.from_uri(path) if "://" in path else (pa.fs.LocalFileSystem(), path)
    with source.open_input_stream(name) as f:
        return f.read()


def lists(parts: list[np.ndarray]) -> pa.LargeListArray:
    """One list of ids for each array."""
    cuts = np.append(0, np.cumsum([len(p) for p in parts], dtype=np.int64))
    flat = np.concatenate(parts).astype(np.int32, copy=False) if parts else np.zeros(0, np.int32)
    return pa.LargeListArray.from_arrays(pa.array(cuts), pa.array(flat))


class Side:
    """One tokenizer: ids of texts, and the bytes that each id stands for."""

    def __init__(self, entries: list[bytes]):
        if not all(entries):
            raise ValueError("a token of no bytes cannot be placed")
        self.bytes = pa.array(entries, pa.large_binary())
        self.lengths = pc.binary_length(self.bytes)

    def encode(self, texts: list[str]) -> pa.LargeListArray:
        raise NotImplementedError


def packed(ids: pa.Array, cuts: np.ndarray) -> pa.BinaryArray:
    """The ids of each row as bytes."""
    data = pa.py_buffer(ids.to_numpy().astype(IDS).tobytes())
    return pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [None, pa.py_buffer((cuts * IDS.itemsize).astype(np.int32).tobytes()), data])


def unpacked(column: pa.BinaryArray) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a column end to end, and where each row's begin and end."""
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    ids = np.frombuffer(data, IDS, (at[-1] - at[0]) // IDS.itemsize, at[0]) if len(column) and at[-1] > at[0] else np.zeros(0, IDS)
    return ids.astype(np.int32), (at - at[0]) // IDS.itemsize


def byte_ranks(file: bytes) -> dict[bytes, int]:
    """Bytes and id of every entry of a byte-level file but added ones, if ids are ranks too.

    Then merging the pair whose join has the lowest id is merging by the file's list: ids rise along the list, and every entry is what
    the list makes of its own bytes, so two neighbours that spell an entry are always the pair the list names."""
    import tokenizers

    described = json.loads(file)
    model, added = described["model"], {t["content"] for t in described["added_tokens"]}
    plain = described["normalizer"] is None and (described["pre_tokenizer"] or {}).get("type") == "ByteLevel"
    if not plain or model["type"] != "BPE" or described["pre_tokenizer"]["add_prefix_space"] or any(
            model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")):
        raise ValueError("not a plain byte-level vocabulary")
    letters = {c: b for b, c in byte_letters().items()}
    entries = {t: k for t, k in model["vocab"].items() if t not in added}
    merged = [entries["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
    library = tokenizers.Tokenizer.from_str(file.decode()).model
    if merged != sorted(merged) or any([x.id for x in library.tokenize(t)] != [k] for t, k in entries.items()):
        raise ValueError("ids of this vocabulary are no ranks")
    return {bytes(letters[c] for c in t): k for t, k in entries.items()}


class ByteLevel(Side):
    """A byte-level vocabulary; special strings in texts are plain text."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import tiktoken

        self.model = tiktoken.Encoding("first", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        entries = [b"?"] * (max(ranks.values()) + 1)
        for token, k in ranks.items():
            entries[k] = token
        super().__init__(entries)

    def encode(self, texts: list[str]) -> pa.LargeListArray:
        return lists([self.model.encode_to_numpy(" " + t, disallowed_special=()) for t in texts])


class Pieces(Side):
    """A sentencepiece model, which puts the space before the text itself."""

    def __init__(self, file: bytes):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=file)
        n = self.model.vocab_size()
        names = [self.model.id_to_piece(k) for k in range(n)]
        super().__init__([
            bytes([int(p[3:5], 16)]) if self.model.is_byte(k) else p.replace("▁", " ").encode() for k, p in enumerate(names)])

    def encode(self, texts: list[str]) -> pa.LargeListArray:
        return pa.array(self.model.encode(texts, num_threads=1), pa.large_list(pa.int32()))


def spelled(ids: pa.LargeListArray, side: Side) -> tuple[memoryview, np.ndarray]:
    """The bytes of all documents' tokens end to end, and where each document's begin and end."""
    flat = ids.flatten()
    ends = np.append(0, np.cumsum(side.lengths.take(flat).to_numpy()))
    joined = side.bytes.take(flat)
    data = joined.buffers()[2]
    # Unsigned, as bytes are: signed items would never equal theirs.
    return memoryview(data if data is not None else b"").cast("B"), ends[ids.offsets.to_numpy()]


def faithful(ids: pa.LargeListArray, side: Side, wanted: list[bytes]) -> np.ndarray:
    """Whether each document's tokens spell exactly the wanted bytes."""
    data, at = spelled(ids, side)
    return np.array([data[s:e] == w for s, e, w in zip(at[:-1], at[1:], wanted)], dtype=bool)


def placed(ids: pa.LargeListArray, side: Side, name: str) -> pa.Table:
    """doc, end and number of every token: the byte of its document at which it ends, by a running sum begun anew in each."""
    parent, flat = pc.list_parent_indices(ids), pc.list_flatten(ids)
    run = pc.cumulative_sum(pc.cast(side.lengths.take(flat), pa.int64()))
    before = np.append(0, run.to_numpy())[ids.offsets.to_numpy()[:-1]]
    return pa.table({"doc": parent, "end": pc.subtract(run, pa.array(before, pa.int64()).take(parent)), name: pa.array(np.arange(len(flat)))})


def digest(numbers: pa.Array, cuts: np.ndarray) -> pa.Array:
    """Ids of each group, comma-joined; cuts: offsets of the groups."""
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pc.cast(numbers, pa.large_string())), pa.scalar(",", pa.large_string()))


def align(a: pa.LargeListArray, b: pa.LargeListArray, first: Side, second: Side) -> tuple[np.ndarray, np.ndarray, list[str], pa.Array, pa.Array]:
    """Groups, links, digest and link ids of documents whose tokens spell the same bytes on both sides."""
    n, flat_a, flat_b = len(a), a.flatten(), b.flatten()
    met = placed(a, first, "ia").join(placed(b, second, "ib"), keys=["doc", "end"], join_type="full outer", use_threads=False)
    order = np.lexsort((met["end"].to_numpy(), met["doc"].to_numpy()))
    doc, has_a, has_b = met["doc"].to_numpy()[order], met["ia"].is_valid().to_numpy()[order], met["ib"].is_valid().to_numpy()[order]
    # A token covers the stretches from the end before its own up to its own.
    link_a = flat_a.take(pa.array(np.cumsum(has_a) - has_a))
    link_b = flat_b.take(pa.array(np.cumsum(has_b) - has_b))
    common = has_a & has_b
    groups, links = np.bincount(doc[common], minlength=n), np.bincount(doc, minlength=n)
    ends_a, ends_b = np.cumsum(has_a)[common], np.cumsum(has_b)[common]
    text = pc.binary_join_element_wise(
        digest(flat_a, np.append(0, ends_a)), digest(flat_b, np.append(0, ends_b)), pa.scalar("|", pa.large_string()))
    whole = pc.binary_join(pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(groups)), pa.int32()), text), pa.scalar(";", pa.large_string()))
    return groups, links, [hashlib.sha256(x.as_buffer()).hexdigest() for x in whole], link_a, link_b


def aligned(docs: DataFrame, first: bytes, pattern: str, second: bytes, text: str = "text") -> DataFrame:
    """Every row with its counts, its digest and the ids of its links in order; first: a byte-level file, second: a piece model."""
    shared = docs.sparkSession.sparkContext.broadcast((byte_ranks(first), second))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, two = ByteLevel(shared.value[0], pattern), Pieces(shared.value[1])
        for batch in batches:
            for span, _, _ in textvec.pieces(batch.column(2), 1 << 20):
                texts = batch.column(2)[span].to_pylist()
                n, filled = len(texts), [k for k, t in enumerate(texts) if t]
                some = [texts[k] for k in filled]
                a, b = one.encode(some), two.encode(some)
                wanted = [b" " + t.encode() for t in some]
                good = faithful(a, one, wanted) & faithful(b, two, wanted)
                a, b, at = a.filter(pa.array(good)), b.filter(pa.array(good)), np.array(filled, np.int64)[good]
                groups, links, marks, link_a, link_b = align(a, b, one, two)

                def spread(values: np.ndarray) -> np.ndarray:
                    out = np.zeros(n, np.int64)
                    out[at] = values
                    return out

                names = [""] * n
                for k, mark in zip(at, marks):
                    names[k] = mark
                cuts = np.append(0, np.cumsum(spread(links)))
                yield pa.RecordBatch.from_arrays([
                    batch.column(0)[span], batch.column(1)[span], pa.array(spread(pc.list_value_length(a).to_numpy(zero_copy_only=False))),
                    pa.array(spread(pc.list_value_length(b).to_numpy(zero_copy_only=False))), pa.array(spread(groups)), pa.array(spread(links)),
                    pa.array(names, pa.string()), packed(link_a, cuts), packed(link_b, cuts)],
                    names=["key", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "a", "b"])

    return docs.select(
        F.monotonically_increasing_id().alias("key"), F.col("doc_id").cast("long").alias("doc_id"), F.col(text).cast("string").alias("t")).mapInArrow(run, ALIGNED)


def pair_counts(rows: DataFrame) -> DataFrame:
    """a, b, n and best of every linked pair: how many links hold it, and whether no other pair of its b has more."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def merged(parts: list[pa.Table]) -> pa.Table:
            found = pa.concat_tables(parts).group_by(["a", "b"], use_threads=False).aggregate([("n", "sum")])
            return found.rename_columns({"n_sum": "n"}).select(["a", "b", "n"]).cast(PAIR)

        held: list[pa.Table] = []
        for batch in batches:
            pairs = pa.table({"a": unpacked(batch.column(0))[0], "b": unpacked(batch.column(1))[0]})
            counted = pairs.group_by(["a", "b"], use_threads=False).aggregate([([], "count_all")])
            held.append(counted.rename_columns({"count_all": "n"}).select(["a", "b", "n"]).cast(PAIR))
            if sum(t.num_rows for t in held) > 2 * HELD_PAIRS:
                held = [merged(held)]
                if held[0].num_rows > HELD_PAIRS:
                    yield from held.pop().to_batches(65536)
        if held:
            yield from merged(held).to_batches(65536)

    total = stored(rows.select("a", "b").mapInArrow(partial, "a int, b int, n long").groupBy("a", "b").agg(F.sum("n").alias("n")), "pairs")
    # One row for each id of the second vocabulary at most.
    top = F.broadcast(total.groupBy("b").agg(F.max("n").alias("top")))
    return stored(total.join(top, "b").select("a", "b", "n", (F.col("n") == F.col("top")).alias("best")), "ranked-pairs")


OWN = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]


def with_sums_by_lookup(rows: DataFrame, pairs: DataFrame) -> DataFrame:
    """Adds n_best and count_sum by a sorted table of all pairs that each task holds."""
    table = pairs.select((F.col("a").cast("long") * (1 << 32) + F.col("b")).alias("code"), (F.col("n") * 2 + F.col("best").cast("int")).alias("n")).toArrow().sort_by("code")
    shared = rows.sparkSession.sparkContext.broadcast((table["code"].to_numpy(), table["n"].to_numpy()))

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, counts = shared.value
        for batch in batches:
            (a, cuts), (b, _) = unpacked(batch.column("a")), unpacked(batch.column("b"))
            wanted = (a.astype(np.int64) << 32) + b
            found = counts[np.searchsorted(codes, wanted)] if len(codes) else wanted
            best, total = (np.append(0, np.cumsum(x)) for x in (found & 1, found >> 1))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in OWN), pa.array(best[cuts[1:]] - best[cuts[:-1]]), pa.array(total[cuts[1:]] - total[cuts[:-1]])],
                names=[*OWN, "n_best", "count_sum"])

    return rows.select(*OWN, "a", "b").mapInArrow(
        summed, "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long")


def with_sums_by_join(rows: DataFrame, pairs: DataFrame) -> DataFrame:
    """The same by a shuffle join, whatever the number of pairs."""

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            (a, cuts), (b, _) = unpacked(batch.column("a")), unpacked(batch.column("b"))
            links = pa.table({"key": np.repeat(batch.column("key").to_numpy(), np.diff(cuts)), "a": a, "b": b})
            counted = links.group_by(["key", "a", "b"], use_threads=False).aggregate([([], "count_all")])
            yield from counted.rename_columns({"count_all": "k"}).select(["key", "a", "b", "k"]).to_batches(65536)

    links = rows.select("key", "a", "b").mapInArrow(opened, "key long, a int, b int, k long")
    sums = links.join(pairs, ["a", "b"]).groupBy("key").agg(
        F.sum(F.when(F.col("best"), F.col("k")).otherwise(0)).alias("n_best"), F.sum(F.col("k") * F.col("n")).alias("count_sum"))
    zero = F.lit(0).cast("long")
    return rows.select("key", *OWN).join(sums, "key", "left").select(
        *OWN, F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum"))


def alignment(docs: DataFrame, first: str, pattern: str, second: str, text: str = "text", broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """doc_id, the counts and the digest of every row; first: path of a byte-level file, which parts texts by
    ``pattern``, second: of a piece model."""
    need(docs, "doc_id", text)
    rows = stored(aligned(docs, file_bytes(first), pattern, file_bytes(second), text), "aligned", "zstd")
    pairs = pair_counts(rows)
    few = pairs.count() <= broadcast_pairs
    return (with_sums_by_lookup if few else with_sums_by_join)(rows, pairs).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
