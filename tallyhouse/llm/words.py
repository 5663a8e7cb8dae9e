"""Hashes of all words of a block of texts at once (numpy, inside tasks)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
#: Texts are handled in pieces of about this many bytes; a longer text is a piece of its own.
PIECE = 1 << 18

_STEP = 0x9E3779B97F4A7C15
_BACK = pow(_STEP, -1, 1 << 64)
_BYTES = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64)
_SPACES = np.zeros(256, bool)
_SPACES[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWERED = np.arange(256)
_LOWERED[65:91] += 32
_BYTES_LOWERED = _BYTES[_LOWERED]
_powers: list[np.ndarray] = []


def scramble(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit (overflow is meant)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
        return x ^ (x >> U64(31))


def _power_tables(n: int) -> list[np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        _powers[:] = []
        for base in (_STEP, _BACK):
            p = np.full(max(n, PIECE + 1), base, U64)
            p[0] = 1
            _powers.append(np.cumprod(p, dtype=U64))
    return _powers


def hash_words(data: np.ndarray, offsets: np.ndarray, lower: bool) -> tuple[np.ndarray, ...]:
    """First word of each text (and the number of words), and hash, start and end of every word."""
    n = len(data)
    if n == 0:
        none = np.zeros(0, np.int64)
        return np.zeros(len(offsets), np.int64), np.zeros(0, U64), none, none
    inside = ~_SPACES[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    cuts = offsets[(offsets > 0) & (offsets < n)]
    first[cuts] = inside[cuts]
    last[cuts - 1] = inside[cuts - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    up, down = _power_tables(n)
    sums = np.zeros(n + 1, U64)
    np.cumsum((_BYTES_LOWERED if lower else _BYTES)[data] * up[:n], dtype=U64, out=sums[1:])
    return np.searchsorted(start, offsets), scramble((sums[end] - sums[start]) * down[start]), start, end


def byte_pieces(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(row, offsets, data)``: from ``row`` on, the text ``row + k`` is
    ``data[offsets[k]:offsets[k + 1]]`` in UTF-8; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    if len(column) == 0:
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        end = int(np.searchsorted(offsets, offsets[row] + PIECE, side="right")) - 1
        end = min(max(end, row + 1), len(column))
        lo, hi = int(offsets[row]), int(offsets[end])
        yield row, offsets[row : end + 1] - lo, data[lo:hi]
        row = end


def pieces(column: pa.Array, lower: bool) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(row, bounds, hashes)``: from ``row`` on, the text ``row + k`` has the words
    ``hashes[bounds[k]:bounds[k + 1]]``.  Words are runs without ASCII white space; null has none.
    With ``lower``, A-Z count as a-z."""
    for row, offsets, data in byte_pieces(column):
        yield row, *hash_words(data, offsets, lower)[:2]


def runs(hashes: np.ndarray, k: int, seed: int) -> np.ndarray:
    """Hash of every ``k`` consecutive words; entry ``i`` starts at word ``i``."""
    if len(hashes) < k:
        return np.zeros(0, U64)
    odd = np.random.default_rng(seed).integers(1, 1 << 63, k, dtype=np.uint64) | U64(1)
    n = len(hashes) - k + 1
    total = np.zeros(n, U64)
    for j in range(k):
        total += hashes[j : j + n] * odd[j]
    return scramble(total)


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
