"""Elias-Fano sequences: sorted numbers in near-minimal space, with select.

Of n values up to u, the low ``floor(log2(u / n))`` bits stand packed one after
another; the rest of value i is a set bit at (rest + i) of a bit string of about
2n bits. Every ``RATE``-th set bit has its position in a table of 32-bit numbers,
so the value at an index is found from the nearest entry on, without a table of
64-bit offsets: about 2 + log2(u / n) bits a value in all.
"""

from __future__ import annotations

import struct

import numpy as np

#: Set bits from one entry of the select table to the next.
RATE = 256
_HEAD = struct.Struct("<IQB")
#: Values packed at once.
_CHUNK = 1 << 16
#: Wider low parts would not fit in one unaligned 64-bit read.
_WIDEST = 56


def _packed(values: np.ndarray, width: int) -> bytes:
    out = []
    for a in range(0, len(values) if width else 0, _CHUNK):
        bits = values[a : a + _CHUNK, None] >> np.arange(width, dtype=np.uint64) & np.uint64(1)
        out.append(np.packbits(bits.astype(np.uint8).ravel(), bitorder="little").tobytes())
    return b"".join(out)


class EliasFano:
    """Values that never fall, each less than 2**63 and 2**32 of them at most.
    ``select(i)`` and ``select_range(a, b)`` return values by index."""

    def __init__(self, n: int, largest: int, low_bits: int, low: bytes, high: bytes, samples: np.ndarray):
        self.n, self.largest, self.low_bits = n, largest, low_bits
        self.low, self.high, self.samples = low, high, samples

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.uint64)
        n = len(values)
        if not n:
            return cls(0, 0, 0, b"", b"", np.zeros(0, "<u4"))
        if (values[1:] < values[:-1]).any():
            raise ValueError("the values fall")
        largest = int(values[-1])
        low_bits = min(max((largest // n).bit_length() - 1, 0), _WIDEST)
        at = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        if n >= 1 << 32 or at[-1] >= 1 << 32:
            raise ValueError("too many values for 32-bit positions")
        bits = np.zeros(int(at[-1]) + 1, np.uint8)
        bits[at] = 1
        low = _packed(values & np.uint64((1 << low_bits) - 1), low_bits)
        return cls(n, largest, low_bits, low, np.packbits(bits, bitorder="little").tobytes(), at[::RATE].astype("<u4"))

    def to_bytes(self) -> bytes:
        sizes = struct.pack("<III", len(self.low), len(self.high), len(self.samples))
        return b"".join([_HEAD.pack(self.n, self.largest, self.low_bits), sizes, self.low, self.high, self.samples.tobytes()])

    @classmethod
    def from_bytes(cls, data: bytes, at: int = 0) -> tuple[EliasFano, int]:
        """The sequence that begins at ``at``, and the place after it."""
        n, largest, low_bits = _HEAD.unpack_from(data, at)
        at += _HEAD.size
        n_low, n_high, n_samples = struct.unpack_from("<III", data, at)
        at += 12
        low, high = data[at : at + n_low], data[at + n_low : at + n_low + n_high]
        at += n_low + n_high
        return cls(n, largest, low_bits, low, high, np.frombuffer(data, "<u4", n_samples, at)), at + 4 * n_samples

    def _low(self, a: int, b: int) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(b - a, np.uint64)
        bit = np.arange(a, b) * self.low_bits
        first, last = int(bit[0]) >> 3, (b * self.low_bits + 7) >> 3
        raw = np.frombuffer(self.low[first:last] + bytes(8), np.uint8)
        word = np.ndarray((len(raw) - 7,), "<u8", raw, strides=(1,))
        return word[(bit >> 3) - first] >> (bit & 7).astype(np.uint64) & np.uint64((1 << self.low_bits) - 1)

    def select_range(self, a: int, b: int) -> np.ndarray:
        """Values a to b - 1."""
        if not 0 <= a <= b <= self.n:
            raise IndexError((a, b, self.n))
        if a == b:
            return np.zeros(0, np.uint64)
        entry, stop = a // RATE, -(-b // RATE)
        begin = int(self.samples[entry])
        end = int(self.samples[stop]) if stop < len(self.samples) else 8 * len(self.high)
        bits = np.unpackbits(np.frombuffer(self.high, np.uint8, (end + 7 >> 3) - (begin >> 3), begin >> 3), bitorder="little")
        at = np.flatnonzero(bits) + (begin & ~7)
        at = at[np.searchsorted(at, begin) :][a - entry * RATE : b - entry * RATE]
        return (at - np.arange(a, b)).astype(np.uint64) << np.uint64(self.low_bits) | self._low(a, b)

    def select(self, i: int) -> int:
        return int(self.select_range(i, i + 1)[0])
