"""Vectorised text primitives over Arrow string columns.

Everything works on the UTF-8 bytes of a whole column slice at once: the
words, their 64-bit hashes and the word range of every row come out as NumPy
arrays, so the cost per word is a few nanoseconds and memory is bounded by the
slice (``slices``), never by the column.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
_STEP = 0x9E3779B97F4A7C15
_PRIME = 0x5851F42D4C957F2D  # 5 modulo 8: its powers have the longest period
SLICE_BYTES = 1 << 19


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every output bit depends on every input bit."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def constants(seed: int, n: int) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit constants."""
    with np.errstate(over="ignore"):
        return mix(np.arange(1, n + 1, dtype=U) * U(_STEP) + U(seed & (2**64 - 1)))


def _space() -> np.ndarray:
    t = np.zeros(256, bool)
    t[[0x20, *range(0x09, 0x0E)]] = True
    return t


def _lower() -> np.ndarray:
    t = np.arange(256, dtype=np.uint8)
    t[ord("A"):ord("Z") + 1] += 32
    return t


SPACE, LOWER, BYTE_VALUE = _space(), _lower(), constants(11, 256)
_powers: dict[str, np.ndarray] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "p" not in _powers or len(_powers["p"]) < n:
        size = max(n, SLICE_BYTES + 1)
        p, q = np.full(size, _PRIME, U), np.full(size, pow(_PRIME, -1, 2**64), U)
        p[0] = q[0] = 1
        _powers["p"], _powers["q"] = np.cumprod(p), np.cumprod(q)
    return _powers["p"], _powers["q"]


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes and the row offsets of a string column; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    if pa.types.is_null(column.type):
        column = column.cast(pa.string()).fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    kind = np.int64 if wide else np.int32
    _, where, what = column.buffers()
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(where, kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(what, np.uint8) if what is not None and what.size else np.zeros(0, np.uint8)
    return data[at[0]:at[-1]], at - at[0]


def slices(offsets: np.ndarray, size: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``size`` bytes each (one longer row stands alone)."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + size, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def spans(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of ``inside`` that stay within a row: starts, ends, and
    for row ``r`` the runs ``ranges[r]:ranges[r + 1]``."""
    n = len(inside)
    if n == 0:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    before, after = np.empty(n, bool), np.empty(n, bool)
    before[0], before[1:] = False, inside[:-1]
    after[-1], after[:-1] = False, inside[1:]
    cut = offsets[1:-1]
    cut = cut[(cut > 0) & (cut < n)]
    before[cut] = False
    after[cut - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every span of ``data``, equal for equal bytes."""
    if len(starts) == 0:
        return np.zeros(0, U)
    p, q = _power_tables(len(data) + 1)
    total = np.zeros(len(data) + 1, U)
    value = BYTE_VALUE.take(data)
    value *= p[:len(data)]
    np.cumsum(value, out=total[1:])
    return mix((total.take(ends) - total.take(starts)) * q.take(starts) + (ends - starts).astype(U))


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """ASCII-lower-cased, white-space separated words of every row: starts,
    ends, hashes and the word ranges of the rows."""
    low = LOWER[data]
    starts, ends, ranges = spans(~SPACE[low], offsets)
    return starts, ends, hashes(low, starts, ends), ranges


def longs(a: np.ndarray) -> pa.Array:
    """Unsigned 64-bit values as an Arrow int64 column, bit for bit."""
    return pa.array(np.ascontiguousarray(a).view(np.int64))
