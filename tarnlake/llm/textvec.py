"""Whole batches of texts as numpy arrays: bytes, word hashes, shingles. Used inside tasks only."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_ODD = np.uint64(0x9E3779B97F4A7C15)
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[32, *range(9, 14)]] = True
#: Everything in ASCII but letters and digits.
SIGNS = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[65:91] += np.uint64(32)
_powers = np.ones(1, dtype=np.uint64)


def powers(n: int) -> np.ndarray:
    """The first n powers of an odd number, modulo 2^64."""
    global _powers
    if len(_powers) < n:
        with np.errstate(over="ignore"):
            _powers = np.concatenate([[np.uint64(1)], np.cumprod(np.full(2 * n, _ODD, dtype=np.uint64))])
    return _powers


def mix(x: np.ndarray) -> np.ndarray:
    """Scatter 64 bits (the finaliser of splitmix64)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def pieces(texts: pa.Array, size: int = 2 << 20) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """(rows, bytes, offsets) of runs of texts of about ``size`` bytes; null counts as empty.

    A longer text makes a run by itself: texts are never cut.
    """
    texts = texts.cast(pa.large_string()).fill_null("")
    if not len(texts):
        return
    buffers = texts.buffers()
    ends = np.frombuffer(buffers[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] else np.zeros(0, np.uint8)
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(ends, ends[at] + size, "right")) - 1)
        yield slice(at, to), data[ends[at] : ends[to]], ends[at : to + 1] - ends[at]
        at = to


def words(data: np.ndarray, offsets: np.ndarray, parts: np.ndarray = _IS_SPACE) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of every word, A-Z lowered, and the text it is in; ``parts``: which bytes part words."""
    inside = ~parts[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    edges = offsets[:-1][offsets[:-1] < len(data)]
    first[edges] = inside[edges]
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    lengths = np.diff(np.append(starts, len(data)))
    place = np.arange(starts[0], len(data), dtype=np.int64) - np.repeat(starts, lengths)
    with np.errstate(over="ignore"):
        value = (_LOWER[data[starts[0] :]] + np.uint64(1)) * powers(int(lengths.max()))[place]
        value[~inside[starts[0] :]] = 0
        return mix(np.add.reduceat(value, starts - starts[0])), np.searchsorted(offsets, starts, "right") - 1


def shingles(hashes: np.ndarray, text: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of ``size`` words, and its text; a shorter text is one run of all its words."""
    with np.errstate(over="ignore"):
        n = len(hashes) - size + 1
        whole = np.flatnonzero(text[: max(n, 0)] == text[size - 1 :]) if n > 0 else np.zeros(0, np.int64)
        out = np.zeros(len(whole), np.uint64)
        for k in range(size):
            out = mix(out + hashes[whole + k] + _ODD)
        firsts = np.flatnonzero(np.append(True, text[1:] != text[:-1])) if len(text) else np.zeros(0, np.int64)
        count = np.diff(np.append(firsts, len(text)))
        shorts, many = firsts[count < size], count[count < size]
        short = np.zeros(len(shorts), np.uint64)
        for k in range(size - 1):
            has = many > k
            short[has] = mix(short[has] + hashes[shorts[has] + k] + _ODD)
        short = mix(short ^ many.astype(np.uint64))
    where = np.concatenate([text[whole], text[shorts]])
    order = np.argsort(where, kind="stable")
    return np.concatenate([out, short])[order], where[order]


def sets(hashes: np.ndarray, text: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct sorted hashes of each of n texts, end to end, and n + 1 offsets."""
    order = np.lexsort((hashes, text))
    h, t = hashes[order], text[order]
    if len(h):
        keep = np.append(True, (h[1:] != h[:-1]) | (t[1:] != t[:-1]))
        h, t = h[keep], t[keep]
    return h, np.searchsorted(t, np.arange(n + 1))
