"""Vectorised text helpers for Arrow batches: whole columns as one byte array."""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32
#: Bytes of words: 0-9, a-z and every non-ASCII character.
ALNUM = np.zeros(256, bool)
ALNUM[ord("0"):ord("9") + 1] = ALNUM[ord("a"):ord("z") + 1] = ALNUM[0x80:] = True
#: Bytes of words between blanks.
NONBLANK = np.ones(256, bool)
NONBLANK[[0x20, *range(0x09, 0x0E)]] = False

_rng = np.random.default_rng(20240607)
BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
BASE = np.uint64(0x9E3779B97F4A7C15)
MIX1, MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * MIX1
    x = (x ^ (x >> np.uint64(27))) * MIX2
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> np.ndarray:
    out = np.full(max(n, 1), BASE, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def slices(column: pa.Array, most: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of consecutive rows whose texts hold
    about ``most`` bytes; one longer text is a slice of its own.  Null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    col = column.cast(pa.large_string()).fill_null("")
    if not len(col):
        return
    offsets = np.frombuffer(col.buffers()[1], np.int64)[col.offset:col.offset + len(col) + 1]
    data = np.frombuffer(col.buffers()[2] or b"", np.uint8)
    first = 0
    while first < len(col):
        end = int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1
        end = min(max(end, first + 1), len(col))
        yield first, end, data[offsets[first]:offsets[end]], offsets[first:end + 1] - offsets[first]
        first = end


def word_hashes(low: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, number of words per row) for the byte classes of ``is_word``."""
    inside = is_word[low]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    rows = offsets[:-1][np.diff(offsets) > 0]
    begins[rows] = inside[rows]
    starts = np.flatnonzero(begins)
    counts = np.searchsorted(starts, offsets[1:]) - np.searchsorted(starts, offsets[:-1])
    if not len(starts):
        return np.zeros(0, np.uint64), counts
    kept = np.flatnonzero(inside)
    first = np.searchsorted(kept, starts)
    length = np.diff(np.append(first, len(kept)))
    place = np.arange(len(kept)) - np.repeat(first, length)
    value = np.add.reduceat(BYTE[low[kept]] * powers(int(length.max()))[place], first)
    return mix64(value + length.astype(np.uint64)), counts


def window_hashes(words: np.ndarray, counts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of each run of ``width`` words inside a row; a row with fewer
    words, but some, has one window of all of them."""
    n = len(words)
    row = np.repeat(np.arange(len(counts)), counts)
    ends = np.cumsum(counts)
    firsts = ends - counts
    out, rows = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    if n >= width:
        value = np.zeros(n - width + 1, np.uint64)
        for j in range(width):
            value = value * BASE + words[j:n - width + 1 + j]
        ok = row[:n - width + 1] == row[width - 1:]
        out, rows = mix64(value[ok]), row[:n - width + 1][ok]
    short = np.flatnonzero((counts > 0) & (counts < width))
    if len(short):
        more = np.zeros(len(short), np.uint64)
        for j in range(width - 1):
            has = counts[short] > j
            at = np.minimum(firsts[short] + j, n - 1)
            more = np.where(has, more * BASE + words[at], more)
        out, rows = np.append(out, mix64(more + np.uint64(1))), np.append(rows, short)
    return out, rows


def runs_of(flags: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """[start, end) of the maximal true runs; a run never crosses a row start."""
    if not len(flags):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    begin = flags.copy()
    begin[1:] &= ~flags[:-1]
    inner = firsts[firsts < len(flags)]
    begin[inner] = flags[inner]
    stop = np.zeros(len(flags) + 1, bool)
    stop[1:len(flags)] = flags[:-1] & (~flags[1:] | begin[1:])
    stop[len(flags)] = flags[-1]
    return np.flatnonzero(begin), np.flatnonzero(stop)
