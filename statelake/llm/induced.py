"""Suffix order with common prefixes by external induced sorting.

The suffixes that start at local minima are sorted first, by sorting and naming the pieces between
minima and ordering the string of names. Two scans then induce all others: a suffix
that is taken from the front of a queue puts the one before it at the end of the queue of its first
symbol. The queues are monotone priority queues over symbols; they hold suffix positions with the
common prefix to their predecessor and spill to disk beyond a bound. The common prefix of two
neighbours in a queue is one more than the least common prefix between their sources.

Order and common prefixes are exact up to ``DEPTH`` symbols; longer prefixes count as ``DEPTH``.
"""

from __future__ import annotations

import os
import tempfile

import numpy as np

DEPTH = 100
SPILL_BYTES = 96 * 1024 * 1024
_TUPLE = np.dtype([("at", np.int32), ("lcp", np.uint8)])


class Queues:
    """One first-in-first-out queue of suffix tuples per symbol; the fullest go to disk beyond a bound."""

    def __init__(self, folder: str, limit: int) -> None:
        self.folder, self.limit, self.size = folder, limit, 0
        self.held: dict[int, list[np.ndarray]] = {}
        self.sizes: dict[int, int] = {}

    def _file(self, symbol: int) -> str:
        return os.path.join(self.folder, f"{id(self)}-{symbol}")

    def push(self, symbol: int, tuples: np.ndarray) -> None:
        self.held.setdefault(symbol, []).append(tuples)
        self.sizes[symbol] = self.sizes.get(symbol, 0) + tuples.nbytes
        self.size += tuples.nbytes
        while self.size > self.limit:
            fullest = max(self.sizes, key=self.sizes.get)
            with open(self._file(fullest), "ab") as file:
                for part in self.held.pop(fullest):
                    part.tofile(file)
            self.size -= self.sizes.pop(fullest)

    def pop(self, symbol: int) -> np.ndarray:
        parts = self.held.pop(symbol, [])
        self.size -= self.sizes.pop(symbol, 0)
        path = self._file(symbol)
        if os.path.exists(path):
            parts.insert(0, np.fromfile(path, dtype=_TUPLE))
            os.remove(path)
        return np.concatenate(parts) if parts else np.zeros(0, _TUPLE)


def is_small(text: np.ndarray) -> np.ndarray:
    """Which suffixes are smaller than the one after them; the last symbol is the unique least one."""
    step = np.sign(np.diff(text.astype(np.int32)))
    place = np.where(step != 0, np.arange(len(step)), len(step))
    following = np.minimum.accumulate(place[::-1])[::-1]
    return np.append(step[np.minimum(following, len(step) - 1)] > 0, True)


def packed(text: np.ndarray) -> tuple[np.ndarray, int]:
    """From every place on the next symbols in one number, the first one lowest, and the bits of a symbol.

    Symbols are numbered densely, so of 256 at most eight make a number; behind the end are zeros.
    """
    dense = (np.cumsum(np.bincount(text) > 0) - 1)[text]
    bits = 8 if dense.max() < 256 else 16
    words = np.append(dense, np.zeros(64 // bits, dtype=np.int64)).astype(np.uint64)
    step = 1
    while step * bits < 64:
        words[:-step] |= words[step:] << np.uint64(step * bits)
        step *= 2
    return words, bits


def common_prefix(words: np.ndarray, bits: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Common prefixes of pairs of different suffixes of a ``packed`` text, up to ``DEPTH`` symbols."""
    result = np.full(len(left), DEPTH, dtype=np.uint8)
    alive = np.arange(len(left))
    edges = np.uint64(1) << np.arange(bits, 64, bits, dtype=np.uint64)
    for k in range(0, DEPTH, 64 // bits):
        apart = words[left[alive] + k] ^ words[right[alive] + k]
        over = apart != 0
        lowest = apart[over] & (~apart[over] + np.uint64(1))
        result[alive[over]] = np.minimum(k + np.searchsorted(edges, lowest, side="right"), DEPTH)
        alive = alive[~over]
        if not len(alive):
            break
    return result


def _least_between(values: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The least of ``values[first:last + 1]`` for many ranges; 255 for an empty one."""
    table = [values]
    while 2 << (len(table) - 1) <= len(values):
        half = 1 << (len(table) - 1)
        table.append(np.minimum(table[-1][:-half], table[-1][half:]))
    length = last - first + 1
    result = np.full(len(first), 255, dtype=np.uint8)
    level = np.zeros(len(first), dtype=np.int64)
    some = length > 0
    level[some] = np.log2(length[some]).astype(np.int64)
    for k in np.flatnonzero(np.bincount(level[some])):
        own = np.flatnonzero(some & (level == k))
        result[own] = np.minimum(table[k][first[own]], table[k][last[own] - (1 << int(k)) + 1])
    return result


class _Scan:
    """One scan: takes sources in order and queues the suffixes before them that are of one type."""

    def __init__(self, text: np.ndarray, wanted: np.ndarray, queues: Queues) -> None:
        self.text, self.wanted, self.queues = text, wanted, queues
        self.least = np.full(int(text.max()) + 1, 255, dtype=np.uint8)  # since the last one queued, per symbol

    def take(self, sources: np.ndarray) -> None:
        """``sources`` continue the scan; their ``lcp`` is to the source before them."""
        if not len(sources):
            return
        before = sources["at"].astype(np.int64) - 1
        chosen = np.flatnonzero((before >= 0) & self.wanted[np.maximum(before, 0)])
        symbols = self.text[before[chosen]]
        order = np.argsort(symbols, kind="stable")
        at, symbols = chosen[order], symbols[order]
        tuples = np.zeros(len(at), dtype=_TUPLE)
        tuples["at"] = before[at]
        new = np.concatenate([[True], symbols[1:] != symbols[:-1]]) if len(at) else np.zeros(0, bool)
        bounds = np.append(np.flatnonzero(new), len(at))
        lcp = np.ascontiguousarray(sources["lcp"])
        start = np.where(new, 0, np.concatenate([[0], at[:-1] + 1])) if len(at) else at
        low = _least_between(lcp, start, at)
        low = np.where(new, np.minimum(low, self.least[symbols]), low) if len(at) else low
        tuples["lcp"] = np.minimum(low.astype(np.int16) + 1, DEPTH)
        np.minimum(self.least, lcp.min(), out=self.least)
        if len(at):
            ends = at[bounds[1:] - 1]
            self.least[symbols[bounds[:-1]]] = _least_between(lcp, ends + 1, np.full(len(ends), len(lcp) - 1))
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            self.queues.push(int(symbols[a]), tuples[a:b])


def _joined(words: np.ndarray, bits: int, upper: np.ndarray, lower: np.ndarray) -> None:
    """Sets the common prefix at the seam between two parts of one bucket, the first scanned first."""
    if len(upper) and len(lower):
        lower["lcp"][0] = common_prefix(words, bits, upper["at"][-1:].astype(np.int64), lower["at"][:1].astype(np.int64))[0]
    elif len(lower):
        lower["lcp"][0] = 0


def induce(text: np.ndarray, small: np.ndarray, minima: np.ndarray, limit: int = SPILL_BYTES) -> tuple[np.ndarray, np.ndarray]:
    """All suffixes in order with their common prefixes, from the sorted suffixes at the ``minima``."""
    words, bits = packed(text)
    starts = np.zeros(len(minima), dtype=_TUPLE)
    starts["at"] = minima
    starts["lcp"][1:] = common_prefix(words, bits, minima[:-1], minima[1:])
    present = np.flatnonzero(np.bincount(text))
    bounds = np.searchsorted(text[minima], np.append(present, present[-1] + 1))
    with tempfile.TemporaryDirectory() as folder:
        large, rest = Queues(folder, limit), Queues(folder, limit)
        done = Queues(folder, limit)  # the large suffixes of each bucket, in order

        def scan(symbol: int, queues: Queues, scanner: _Scan) -> list[np.ndarray]:
            rounds = []
            while len(batch := queues.pop(symbol)):
                if not rounds:
                    batch["lcp"][0] = 0
                rounds.append(batch)
                scanner.take(batch)
            return rounds

        up = _Scan(text, ~small, large)
        for k, symbol in enumerate(present):
            rounds = scan(int(symbol), large, up)
            for part in rounds:
                done.push(int(symbol), part)
            own = starts[bounds[k] : bounds[k + 1]]
            _joined(words, bits, rounds[-1] if rounds else own[:0], own)
            up.take(own)
        down = _Scan(text, small, rest)
        order, lcps = [], []
        for symbol in present[::-1]:
            rounds = scan(int(symbol), rest, down)
            smaller = np.concatenate(rounds) if rounds else np.zeros(0, _TUPLE)
            bigger = done.pop(int(symbol))[::-1]
            if symbol == text[-1]:
                last = np.zeros(1, dtype=_TUPLE)  # the least symbol itself has no successor to induce it
                last["at"] = len(text) - 1
                smaller, bigger = last, bigger[:0]
            scanned = bigger.copy()
            scanned["lcp"][1:] = bigger["lcp"][:-1]
            _joined(words, bits, smaller, scanned)
            down.take(scanned)
            found = np.concatenate([smaller, scanned])[::-1]
            order.append(found["at"].astype(np.int64))
            lcps.append(np.append(0, found["lcp"][:-1]).astype(np.uint8))
        return np.concatenate(order[::-1]), np.concatenate(lcps[::-1])


def _refined(rank: np.ndarray, some: np.ndarray, *keys: np.ndarray) -> np.ndarray:
    """Splits groups of equal rank by rank and ``keys``; returns those that still share theirs.

    A rank is the number of members of lesser groups; ``some`` holds all members of its groups.
    """
    by = np.argsort(keys[0]) if len(keys) == 1 else np.lexsort(keys[::-1])
    some = some[by]
    old = rank[some]
    group = np.ones(len(some), dtype=bool)
    group[1:] = old[1:] != old[:-1]
    new = group.copy()
    for key in keys:
        new[1:] |= key[by[1:]] != key[by[:-1]]
    place = np.arange(len(some))
    rank[some] = old + np.maximum.accumulate(np.where(new, place, 0)) - np.maximum.accumulate(np.where(group, place, 0))
    return some[~(new & np.append(new[1:], True))]


def _named(text: np.ndarray, small: np.ndarray, minima: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranks of the pieces between minima, both ends included, and which pieces are not the only ones of theirs.

    Pieces compare by symbol and type, so none is the beginning of another.
    """
    bits = int(text.max()).bit_length() + 1
    each = 64 // bits
    symbols = np.append(text.astype(np.uint64) * np.uint64(2) + small, np.zeros(each, dtype=np.uint64))
    length = np.append(np.diff(minima) + 1, len(text) - minima[-1])
    inside = np.array([(1 << each * bits) - (1 << (each - k) * bits) for k in range(each + 1)], dtype=np.uint64)
    rank = np.zeros(len(minima), dtype=np.int64)
    shared = longer = np.arange(len(minima))
    done = 0
    while len(longer):
        at = minima[longer] + done
        key = symbols[at]
        for k in range(1, each):
            key = key << np.uint64(bits) | symbols[at + k]
        key &= inside[np.minimum(length[longer] - done, each)]
        if done:
            shared = np.concatenate([shared[length[shared] <= done], _refined(rank, longer, rank[longer], key)])
        else:
            shared = _refined(rank, longer, key)
        done += each
        longer = shared[length[shared] > done]
    return rank, shared


def _ranked(rank: np.ndarray, shared: np.ndarray, reach: int) -> np.ndarray:
    """The order of the suffixes of a string of names, by their first ``reach`` names at least.

    ``rank`` and ``shared`` are those of the names. A round joins the ranks of as many neighbours as a
    number holds, and sorts only what still shares its rank.
    """
    n = len(rank)
    bits = n.bit_length()
    joined = max(2, 64 // bits)
    step = 1
    while step < reach and len(shared):
        ahead = np.append(rank + 1, 0).astype(np.uint64)
        key = ahead[shared]
        for k in range(1, joined):
            key = key << np.uint64(bits) | ahead[np.minimum(shared + k * step, n)]
        shared = _refined(rank, shared, key)
        step *= joined
    return np.argsort(rank)


def suffix_order(text: np.ndarray, limit: int = SPILL_BYTES) -> tuple[np.ndarray, np.ndarray]:
    """Suffix and common-prefix array of ``text``, an array of small numbers that ends in a unique zero."""
    small = is_small(text)
    minima = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    if len(minima) > 1:
        minima = minima[_ranked(*_named(text, small, minima), DEPTH // 2 + 1)]
    return induce(text, small, minima, limit)
