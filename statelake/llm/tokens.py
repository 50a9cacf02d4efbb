"""Texts of an Arrow batch as arrays: bytes, word bounds, and 64-bit hashes of words and word runs."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))
_powers: dict[int, np.ndarray] = {}

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
# Bytes that belong to words: all but white space; or letters, digits and all beyond ASCII.
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[9, 10, 11, 12, 13, 32]] = False
ALPHANUMERIC = np.zeros(256, dtype=bool)
ALPHANUMERIC[0x30:0x3A] = ALPHANUMERIC[0x61:0x7B] = ALPHANUMERIC[0x80:] = True


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column, and where each row starts (one more bound than rows). NULL is empty."""
    if column.null_count:
        column = column.fill_null("")
    large = pa.types.is_large_string(column.type)
    _, bounds, data = column.buffers()
    width = np.int64 if large else np.int32
    at = np.frombuffer(bounds, dtype=width)[column.offset : column.offset + len(column) + 1].astype(np.int64) if bounds else np.zeros(1, np.int64)
    raw = np.frombuffer(data, dtype=np.uint8)[at[0] : at[-1]] if data else np.zeros(0, np.uint8)
    return raw, at - at[0]


def word_bounds(data: np.ndarray, at: np.ndarray, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words in bytes, and the first word of each row (one more than rows)."""
    inside = letters[data]
    before = np.empty_like(inside)
    before[:1] = False
    before[1:] = inside[:-1]
    firsts = at[:-1][at[:-1] < len(data)]
    before[firsts] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty_like(inside)
    after[-1:] = False
    after[:-1] = inside[1:]
    after[firsts[firsts > 0] - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, at)


def _power(base: np.uint64, n: int) -> np.ndarray:
    known = _powers.get(int(base))
    if known is None or len(known) < n:
        size = max(n, 1 << 20)
        known = np.full(size, base, dtype=np.uint64)
        known[0] = 1
        known = np.cumprod(known)
        if size <= 1 << 24:
            _powers[int(base)] = known
    return known[:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers (the finalizer of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of ``values[start:end]`` for every span, from one prefix sum."""
    n = len(values)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * _power(_BASE, n), out=sums[1:])
    shifted = (sums[ends] - sums[starts]) * _power(_INVERSE, n + 1)[starts]
    return mixed(shifted + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def word_hashes(column: pa.Array, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of a column, ASCII letters lowered, and the first word of each row."""
    data, at = text_bytes(column)
    data = LOWER[data]
    starts, ends, rows = word_bounds(data, at, letters)
    return span_hashes(data, starts, ends), rows


def row_of(rows: np.ndarray) -> np.ndarray:
    """The row number of every word, from the first word of each row."""
    return np.repeat(np.arange(len(rows) - 1), np.diff(rows))
