"""Vectorised kernels over UTF-8 buffers.

Documents arrive as Arrow string columns.  Their bytes are viewed as one ``uint8`` array and words, word windows and
byte windows are hashed for many documents at once, with prefix sums of a polynomial in an odd base (odd numbers have
inverses modulo 2**64, so that every window's hash is a difference of two prefix sums times one inverse power).
No document is cut: a slice holds whole documents, and a document larger than a slice is a slice of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = (1 << 18) - 1  # its prefix sums fill the tables of 2**18 powers

_U = np.uint64
_BASE, _WORD_BASE = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95


def _table(seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(1, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)


_BYTES = _table(11)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
#: ASCII other than letters.
NO_LETTER = np.zeros(256, bool)
NO_LETTER[:128] = [not chr(b).isalpha() for b in range(128)]
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit words."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of an odd base modulo 2**64, and their inverses."""
    have = _powers.get(base)
    if have is None or len(have[0]) < n:
        size = 1 << max(10, (n - 1).bit_length())
        out = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.full(size, b, np.uint64)
            p[0] = 1
            out.append(np.multiply.accumulate(p))
        have = (out[0], out[1])
        if size <= 1 << 21:  # a single huge document does not leave its tables behind
            _powers[base] = have
    return have[0][:n], have[1][:n]


def prefix(values: np.ndarray, base: int) -> np.ndarray:
    """Prefix sums of values[i] * base**i; one longer than values."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(base, len(values))[0], out=out[1:])
    return out


def spans(sums: np.ndarray, base: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the spans [starts, ends) that depend on their content alone."""
    return mix((sums[ends] - sums[starts]) * powers(base, len(sums))[1][starts])


class Slice:
    """Whole documents side by side: rows [row, row + n) of a batch, with bytes and bounds."""

    def __init__(self, row: int, data: np.ndarray, lo: np.ndarray, hi: np.ndarray):
        self.row, self.n, self.data, self.lo, self.hi = row, len(lo), data, lo, hi

    def words(self, between: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of the words, and for each document the range of its words; `between` marks separating bytes."""
        n = len(self.data)
        inside = np.empty(n + 2, bool)
        inside[0] = inside[-1] = False
        np.logical_not(between[self.data], out=inside[1:-1])
        begins = inside[1:-1] & ~inside[:-2]
        stops = inside[1:-1] & ~inside[2:]
        edge = self.lo[(self.lo > 0) & (self.lo < n)]
        begins[edge] |= inside[1:-1][edge]
        stops[edge - 1] |= inside[1:-1][edge - 1]
        starts = np.flatnonzero(begins)
        return starts, np.flatnonzero(stops) + 1, np.searchsorted(starts, self.lo), np.searchsorted(starts, self.hi)

    def word_hashes(self, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
        data = _LOWER[self.data] if lower else self.data
        return spans(prefix(_BYTES[data], _BASE), _BASE, starts, ends)


def slices(column: pa.Array, size: int = SLICE_BYTES) -> Iterator[Slice]:
    """Cuts a string or binary column (null: empty) into slices of whole documents."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    i = 0
    while i < len(column):
        j = max(i + 1, int(np.searchsorted(bounds, bounds[i] + size, "right")) - 1)
        at = bounds[i : j + 1] - bounds[i]
        yield Slice(i, data[bounds[i] : bounds[j]], at[:-1], at[1:])
        i = j


def word_windows(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all windows of k consecutive words, across documents too; callers keep those within one."""
    if len(hashes) < k:
        return np.zeros(0, np.uint64)
    at = np.arange(len(hashes) - k + 1)
    return spans(prefix(hashes, _WORD_BASE), _WORD_BASE, at, at + k)


def byte_windows(data: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all windows of k bytes."""
    if len(data) < k:
        return np.zeros(0, np.uint64)
    sums = prefix(_BYTES[data], _BASE)
    return mix((sums[k:] - sums[:-k]) * powers(_BASE, len(sums))[1][: len(data) - k + 1])


def minimizers(hashes: np.ndarray, width: int, step: int = 1 << 23) -> np.ndarray:
    """For each window of `width` consecutive hashes the place of its smallest, the leftmost among equal ones.

    Hashes count by their upper 40 bits, so that a window's choice depends on its content alone.
    """
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    if n > step:  # places have 24 bits; longer rows are done in overlapping parts of `step` windows
        return np.concatenate([minimizers(hashes[i : i + step + width - 1], width, step) + i for i in range(0, n, step)])
    low = _U((1 << 24) - 1)
    best, reach = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64), 1
    while reach * 2 <= width:
        best = np.minimum(best[:-reach], best[reach:])
        reach *= 2
    if reach < width:
        best = np.minimum(best[: n], best[width - reach : width - reach + n])
    return (best[:n] & low).astype(np.int64)


class Numbering:
    """Numbers of distinct 64-bit hashes, found many at a time: a few tables of slots, each for what met another there."""

    def __init__(self, keys: np.ndarray):
        self.keys, self.slots = keys, []
        self.bits = max(8, len(keys).bit_length() + 1)
        rest = np.arange(len(keys), dtype=np.int32)
        while len(rest):
            slots, at = np.full(1 << self.bits, -1, np.int32), self._at(keys[rest], len(self.slots))
            slots[at] = rest
            self.slots.append(slots)
            rest = rest[slots[at] != rest]

    def _at(self, keys: np.ndarray, level: int) -> np.ndarray:
        return mix(keys + _U(level)) >> _U(64 - self.bits)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The keys' numbers, -1 for those that have none."""
        out, todo = np.full(len(keys), -1, np.int32), np.arange(len(keys))
        for level, slots in enumerate(self.slots):
            number = slots[self._at(keys[todo], level)]
            there = number >= 0
            todo, number = todo[there], number[there]
            hit = self.keys[number] == keys[todo]
            out[todo[hit]] = number[hit]
            todo = todo[~hit]
        return out
