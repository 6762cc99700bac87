"""Token counts by byte-pair merging with a heap over a linked list.

A piece of text starts as one symbol per byte. The adjacent pair of lowest rank is merged until
none is left; the count is the symbols at the start minus the merges. No identifiers are made.

Null and empty texts count 0. Every row is counted alone, so ties and repeated rows do not matter,
an empty table gives an empty one, and all other columns are kept (an old ``n_tokens`` is replaced).
A piece of any length costs n log n.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.fs
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnlake.llm.common import need

# Fixed values of the vocabulary's own description: what parts pieces, and what is white space there.
SPACE = r"\t-\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^" + SPACE + r"\p{L}\p{N}]+"
# Letters whose lower case is newer than this Python's tables.
NEWER = {0xA7CB: 0x0264, 0xA7CC: 0xA7CD, 0xA7DA: 0xA7DB, 0xA7DC: 0x019B}
# Pieces remembered by a worker before it starts anew; bounds its memory, not its results.
REMEMBERED = 400_000


def byte_letters() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}


def load_merges(path: str) -> dict:
    """What counting needs from a vocabulary file: ranks of pairs, word end, special strings."""
    source, name = pa.fs.FileSystem.from_uri(path) if "://" in path else (pa.fs.LocalFileSystem(), path)
    with source.open_input_stream(name) as f:
        file = json.loads(f.read())
    model = file["model"]
    if model["type"] != "BPE" or any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix")):
        raise ValueError("not a plain byte-pair vocabulary")
    pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
    return {
        "ranks": {tuple(p): k for k, p in enumerate(pairs)},
        "end": model.get("end_of_word_suffix") or "",
        "special": [t["content"] for t in file["added_tokens"] if t["special"]],
    }


def merge_count(symbols: list[str], ranks: dict[tuple[str, str], int]) -> int:
    """Merges done when the lowest-ranked, then leftmost, adjacent pair always goes first."""
    n = len(symbols)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(r, i, p) for i, p in enumerate(zip(symbols, symbols[1:])) if (r := ranks.get(p)) is not None]
    heapq.heapify(heap)
    merges, live = 0, symbols[:]
    while heap:
        _, i, pair = heapq.heappop(heap)
        j = after[i]
        if live[i] is None or j >= n or (live[i], live[j]) != pair:
            continue  # one side has been merged since
        live[i], live[j] = pair[0] + pair[1], None
        merges += 1
        after[i] = k = after[j]
        if k < n:
            before[k] = i
            if (r := ranks.get(p := (live[i], live[k]))) is not None:
                heapq.heappush(heap, (r, i, p))
        if (k := before[i]) >= 0 and (r := ranks.get(p := (live[k], live[i]))) is not None:
            heapq.heappush(heap, (r, k, p))
    return merges


class PieceCounts(dict):
    """Tokens of a piece, worked out when first asked for."""

    def __init__(self, merges: dict):
        super().__init__()
        self.ranks, self.end, self.letters = merges["ranks"], merges["end"], byte_letters()

    def __missing__(self, piece: str) -> int:
        symbols = [self.letters[b] for b in piece.encode()]
        symbols[-1] += self.end
        found = len(symbols) - merge_count(symbols, self.ranks)
        if len(piece) < 64:
            self[piece] = found
        return found


class TokenCounter:
    def __init__(self, merges: dict):
        self.pieces = PieceCounts(merges)
        self.cut = regex.compile(PIECES)
        special = sorted(merges["special"], key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None

    def __call__(self, text: str | None) -> int:
        if not text:
            return 0
        if self.special is None or not self.special.search(text):
            return self.plain(text)
        parts = self.special.split(text)
        return len(parts) - 1 + sum(map(self.plain, parts))

    def plain(self, text: str) -> int:
        if len(self.pieces) > REMEMBERED:
            self.pieces.clear()
        # Lower-casing goes letter by letter: a final sigma is like any other.
        lowered = unicodedata.normalize("NFC", text).replace("Σ", "σ").translate(NEWER).lower()
        return sum(map(self.pieces.__getitem__, self.cut.findall(lowered)))


def count_tokens(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """Add ``n_tokens``. The vocabulary, of a fixed size, is read once and broadcast."""
    need(docs, text)
    shared = docs.sparkSession.sparkContext.broadcast(load_merges(path))

    @F.pandas_udf("long")
    def counted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        count = TokenCounter(shared.value)
        for batch in batches:
            yield pd.Series([count(t) for t in batch], dtype="int64")

    return docs.withColumn("n_tokens", counted(F.col(text).cast("string")))
