"""Vectorised word and window hashing over Arrow string columns.

Every text operator of this subpackage reads documents through ``mapInArrow``
and works on the raw UTF-8 bytes of a batch: one pass marks word boundaries by
a 256-entry class table, one pass builds polynomial prefix sums modulo 2**64,
and a word's or window's hash is then a difference of two prefix sums.  Work is
done in blocks of whole rows of about ``BLOCK_BYTES`` bytes, so the memory of a
Python worker follows the block (or the longest single text), not the batch.

Nulls count as empty texts everywhere here.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 20

_U = np.uint64
_RNG = np.random.Generator(np.random.PCG64(20240611))
#: Random values of the 256 bytes, and odd multipliers with their inverses modulo 2**64.
_BYTE = _RNG.integers(1, 2**63, size=256, dtype=np.uint64) | _U(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_LOWER = _BYTE.copy()
_LOWER[65:91] = _BYTE[97:123]
_MASK64 = (1 << 64) - 1

#: Bytes that separate words: blanks; and all ASCII but letters and digits.
BLANK = np.zeros(256, bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True
NON_ALNUM = np.zeros(256, bool)
NON_ALNUM[0:0x30] = NON_ALNUM[0x3A:0x41] = NON_ALNUM[0x5B:0x61] = NON_ALNUM[0x7B:0x80] = True

_pow_cache: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """``base ** [0..n)`` modulo 2**64; the table kept is the longest asked for, up to a block."""
    have = _pow_cache.get(base)
    if have is None or len(have) < n:
        size = max(n, 1 << 12)
        have = np.empty(size, np.uint64)
        have[0], done = 1, 1
        while done < size:
            step = min(done, size - done)
            have[done : done + step] = have[:step] * _U(pow(base, done, 1 << 64))
            done += step
        if size <= 4 * BLOCK_BYTES:
            _pow_cache[base] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser: spreads polynomial hashes over all bits."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def prefix_hashes(values: np.ndarray, base: int = _BASE) -> np.ndarray:
    """S with S[0] = 0 and S[i] = sum of values[j] * base**j for j < i."""
    out = np.empty(len(values) + 1, np.uint64)
    out[0] = 0
    np.cumsum(values * powers(base, len(values)), out=out[1:])
    return out


def span_hashes(prefix: np.ndarray, start: np.ndarray, end: np.ndarray, base: int = _BASE) -> np.ndarray:
    """Hash of each [start, end), whatever its place: difference of prefix sums times base**-start."""
    return mix((prefix[end] - prefix[start]) * powers(pow(base, -1, 1 << 64), len(prefix))[start])


def window_hashes(values: np.ndarray, width: int, base: int = _BASE) -> np.ndarray:
    """Rabin-Karp hash of every window of `width` consecutive values."""
    n = len(values) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    p = prefix_hashes(values, base)
    return mix((p[width:] - p[:n]) * powers(pow(base, -1, 1 << 64), n))


def rows_of(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the len + 1 offsets of its rows; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    n = len(column)
    _, offsets, data = column.buffers()
    if n == 0 or data is None:
        return np.empty(0, np.uint8), np.zeros(n + 1, np.int64)
    return np.frombuffer(data, np.uint8), np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]


def blocks(offsets: np.ndarray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most `limit` bytes, or of one longer row."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1
        j = min(n, max(i + 1, j))
        yield i, j
        i = j


@dataclass
class Words:
    """Words of a block of rows: byte spans in `data`, 64-bit hashes, and each row's first word."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray  # len(rows) + 1 positions in start, end and hash

    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def text(self, i: int, j: int) -> list[bytes]:
        raw = self.data.tobytes() if len(self.data) < 4096 else None
        if raw is not None:
            return [raw[a:b] for a, b in zip(self.start[i:j].tolist(), self.end[i:j].tolist(), strict=True)]
        lo, hi = int(self.start[i]), int(self.end[j - 1])
        raw = self.data[lo:hi].tobytes()
        return [raw[a - lo : b - lo] for a, b in zip(self.start[i:j].tolist(), self.end[i:j].tolist(), strict=True)]


def words_of(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray, lower: bool) -> Words:
    """Words of the rows `offsets` (of one block), hashed; words never run over a row's end."""
    base = int(offsets[0])
    data = data[base : int(offsets[-1])]
    ends = (offsets[1:] - base).astype(np.int64)
    if len(data) == 0:
        none = np.empty(0, np.int64)
        return Words(data, none, none, np.empty(0, np.uint64), np.zeros(len(offsets), np.int64))
    inside = ~separators[data]
    starts_here = inside.copy()
    starts_here[1:] &= ~inside[:-1]
    ends_here = inside.copy()
    ends_here[:-1] &= ~inside[1:]
    edge = ends[ends < len(data)]
    edge = edge[edge > 0]
    starts_here[edge] = inside[edge]
    ends_here[edge - 1] = inside[edge - 1]
    start = np.flatnonzero(starts_here)
    end = np.flatnonzero(ends_here) + 1
    prefix = prefix_hashes((_LOWER if lower else _BYTE)[data])
    first = np.concatenate(([0], np.searchsorted(start, ends, "left")))
    return Words(data, start, end, span_hashes(prefix, start, end), first)


def windows_within(first: np.ndarray, width: int, total: int) -> np.ndarray:
    """Mask over window starts 0..total-width: those whose window stays in one row."""
    n = total - width + 1
    if n <= 0:
        return np.zeros(0, bool)
    ok = np.ones(n, bool)
    edges = first[1:-1]
    for shift in range(1, width):  # a window that starts up to width - 1 before a row's end runs over it
        at = edges - shift
        at = at[(at >= 0) & (at < n)]
        ok[at] = False
    return ok


def strings(values: list[bytes | None]) -> pa.Array:
    return pa.array(values, pa.binary()).cast(pa.string())
