"""Directly addressable codes for integers.

A value is split into chunks of ``WIDTHS`` bits, lowest first.  Level 0 holds the lowest chunk of
every value; a bitmap says which values continue, and level 1 holds the next chunk of these alone,
and so on.  A rank directory counts the continuing values before every ``BLOCK`` bits, so the place of
value ``i`` on the next level is one directory entry plus the bits of at most one block: any value, or
any range of values, is read without decoding what stands before it.

Layout, little endian: ``DAC1``, u64 number of values, u8 levels; per level u8 width in bits, u64
number of chunks, the chunks; on every level but the last the bitmap (bit ``i`` of byte ``i // 8``)
and the directory (u64 per block).
"""

from __future__ import annotations

import struct

import numpy as np

MAGIC = b"DAC1"
WIDTHS = (8, 8, 16)
BLOCK = 512
_ONES = np.array([bin(x).count("1") for x in range(256)], np.int64)


def encode(values: np.ndarray) -> bytes:
    kind = np.uint32 if getattr(values, "dtype", None) == np.uint32 else np.uint64  # ids stay as short as they come
    values = np.asarray(values, kind)
    out = [MAGIC, struct.pack("<QB", len(values), len(WIDTHS))]
    for k, width in enumerate(WIDTHS):
        out.append(struct.pack("<BQ", width, len(values)))
        out.append((values & kind((1 << width) - 1)).astype(f"<u{width // 8}").tobytes())
        values = values >> kind(width)
        if k < len(WIDTHS) - 1:
            more = values > 0
            bits = np.packbits(more, bitorder="little")
            ones = np.add.reduceat(_ONES[bits], np.arange(0, len(bits), BLOCK // 8)) if len(bits) else bits
            before = np.concatenate([[0], np.cumsum(ones, dtype=np.int64)])
            out += [bits.tobytes(), before.astype("<u8").tobytes()]
            values = values[more]
    if len(values) and values.any():
        raise ValueError("a value does not fit into the levels")
    return b"".join(out)


class Codes:
    """Read access to encoded bytes; nothing is decoded in advance."""

    def __init__(self, data: bytes):
        if data[:4] != MAGIC:
            raise ValueError("not a code block")
        self.n, levels = struct.unpack_from("<QB", data, 4)
        at, self.levels = 13, []
        for k in range(levels):
            width, count = struct.unpack_from("<BQ", data, at)
            at += 9
            chunks = np.frombuffer(data, f"<u{width // 8}", count, at)
            at += count * width // 8
            bits = before = None
            if k < levels - 1:
                size, blocks = -(-count // 8), -(-count // BLOCK) + 1
                bits = np.frombuffer(data, np.uint8, size, at)
                before = np.frombuffer(data, "<u8", blocks, at + size)
                at += size + 8 * blocks
            self.levels.append((width, chunks, bits, before))

    def __len__(self) -> int:
        return self.n

    @staticmethod
    def _rank(bits: np.ndarray, before: np.ndarray, i: int) -> int:
        """Set bits before ``i``."""
        block = i // BLOCK
        lo, hi = block * BLOCK // 8, i // 8
        rank = int(before[block]) + int(_ONES[bits[lo:hi]].sum())
        return rank + (int(_ONES[int(bits[hi]) & ((1 << (i % 8)) - 1)]) if i % 8 else 0)

    def __getitem__(self, i: int) -> int:
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = shift = 0
        for width, chunks, bits, before in self.levels:
            value |= int(chunks[i]) << shift
            if bits is None or not (int(bits[i // 8]) >> (i % 8)) & 1:
                return value
            shift += width
            i = self._rank(bits, before, i)
        return value

    def read(self, start: int, stop: int) -> np.ndarray:
        """Values ``start`` to ``stop`` (exclusive)."""
        start, stop = max(0, start), min(stop, self.n)
        out = np.zeros(max(0, stop - start), np.uint64)
        where, shift = np.arange(len(out)), 0
        for width, chunks, bits, before in self.levels:
            if not len(where):
                break
            out[where] |= chunks[start:stop].astype(np.uint64) << np.uint64(shift)
            if bits is None:
                break
            lo = start // 8
            more = np.unpackbits(bits[lo : -(-stop // 8)], bitorder="little")[start - 8 * lo : stop - 8 * lo].astype(bool)
            start = self._rank(bits, before, start)
            where, shift = where[more], shift + width
            stop = start + len(where)
        return out
