"""Whole columns of text as numpy bytes: word bounds, prefix hashes and sliding minima without a Python loop per word."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

#: ASCII letters to lower case; everything else stays.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Bytes of words: digits, ASCII letters and every byte of a non-ASCII character.
WORD = np.zeros(256, bool)
WORD[48:58] = WORD[65:91] = WORD[97:123] = WORD[128:] = True


def text_column(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of a string array; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return (at - at[0]) if len(at) else np.zeros(1, np.int64), whole[at[0] : at[-1]] if len(at) else whole


def slices(offsets: np.ndarray, limit: int = 1 << 19) -> Iterator[tuple[int, int]]:
    """Runs of rows of about `limit` bytes; a longer text is a run of its own."""
    n, lo = len(offsets) - 1, 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        yield lo, hi
        lo = hi


#: Powers up to so many are kept for the worker's life; of longer data they are made anew.
KEPT = 1 << 22


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of BASE and of its inverse, modulo 2^64."""
    if len(_powers[0]) >= n:
        return _powers[0], _powers[1]
    size = 1 << int(n - 1).bit_length() if n <= KEPT else n
    out = []
    for b in (BASE, _INVERSE):
        p = np.full(size, b, np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    if n <= KEPT:
        _powers[:] = out
    return out[0], out[1]


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """H with H[e] - H[s] = sum of (byte + 1) * BASE^place over data[s:e]."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(len(data) + 1)[0][: len(data)], out=out[1:])
    return out


def mixed(x: np.ndarray) -> np.ndarray:
    """The hashes with all bits stirred."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def span_hash(h: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of data[start:end], alike wherever the bytes stand."""
    return mixed((h[end] - h[start]) * powers(len(h))[1][start])


def word_bounds(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, document) of the maximal runs of word bytes; no run crosses a document's end."""
    m = np.zeros(len(data) + 2, bool)
    m[1:-1] = is_word[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    starts = np.flatnonzero(m[1:] & (~m[:-1] | edge))
    ends = np.flatnonzero(m[:-1] & (~m[1:] | edge))
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum over x[i:i+w] for every i that has w entries."""
    if len(x) < w:
        return x[:0]
    size = 1
    while size * 2 <= w:
        x = np.minimum(x[: len(x) - size], x[size:])
        size *= 2
    rest = w - size
    return np.minimum(x[: len(x) - rest], x[rest:]) if rest else x
