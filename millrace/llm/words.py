"""Words and hashes of whole Arrow text columns, half a megabyte at a time, in numpy.

Hashes are taken from running sums over the bytes, so that no word becomes a Python object.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 19
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def table_of(separators: bytes, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """For each byte value: is it in a word, and its value after lower-casing A-Z."""
    inside = np.ones(256, bool)
    inside[list(separators)] = False
    value = np.arange(256, dtype=np.uint8)
    if lower:
        value[65:91] += 32
    return inside, value


def texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts in a row, and where each begins; null counts as empty."""
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def slices(at: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about so many bytes; a longer text is a range of its own."""
    first, rows = 0, len(at) - 1
    while first < rows:
        last = int(np.searchsorted(at, at[first] + most, "right")) - 1
        last = min(rows, max(last, first + 1))
        yield first, last
        first = last


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers
    if len(_powers[0]) < n:
        n = max(n, 1 << 16)
        up, down = np.full(n, _BASE, np.uint64), np.full(n, _INVERSE, np.uint64)
        up[0] = down[0] = 1
        _powers = (np.cumprod(up), np.cumprod(down))
    return _powers


def find_words(
    data: np.ndarray, at: np.ndarray, inside: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of each word, and for each text the number of its first word."""
    n = len(data)
    flag = inside[data]
    begins, ends = flag.copy(), flag.copy()
    if n:
        begins[1:] &= ~flag[:-1]
        ends[:-1] &= ~flag[1:]
        edges = at[(at > 0) & (at < n)]
        begins[edges] = flag[edges]
        ends[edges - 1] = flag[edges - 1]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, at)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word."""
    up, down = _power_tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts])


def shingles(hashes: np.ndarray, first: np.ndarray, width: int) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of its runs of so many words.

    A text with fewer words, but not none, is one run.
    """
    n = len(hashes)
    runs = np.zeros(max(0, n - width + 1), np.uint64)
    factor = int(_BASE)
    for k in range(width):
        runs += hashes[k : k + len(runs)] * np.uint64(pow(factor, k + 1, 1 << 64))
    runs = mix(runs)
    for lo, hi in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if hi - lo >= width:
            found = np.sort(runs[lo : hi - width + 1])
            yield found[np.r_[True, found[1:] != found[:-1]]]
        elif hi > lo:
            whole = np.uint64(hi - lo)
            for h in hashes[lo:hi]:
                whole = mix(np.array([whole ^ h]))[0]
            yield np.array([whole], np.uint64)
        else:
            yield np.zeros(0, np.uint64)
