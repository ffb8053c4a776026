"""Elias-Fano sequences: non-decreasing numbers in about 2 + log2(largest / count) bits each, with a sampled select.

A number's low bits stand side by side in one array; the high bits are kept in unary, a one per number behind as many zeros as the
high part has grown. select(i) finds the i-th one: the place of every 64th one is kept, so a lookup reads the few bytes between two samples.
"""

from __future__ import annotations

import struct

import numpy as np

SAMPLE = 64
_HEAD = struct.Struct("<QQBI")


class EliasFano:
    """The sequence, opened from the bytes of :func:`encode`; nothing is unpacked before it's asked for."""

    def __init__(self, data: bytes):
        self.n, self.largest, self.low_bits, n_upper = _HEAD.unpack_from(data)
        view = np.frombuffer(data, np.uint8, offset=_HEAD.size)
        n_lower = (self.n * self.low_bits + 7) // 8
        self.lower, self.upper = view[:n_lower], view[n_lower : n_lower + n_upper]
        self.samples = np.frombuffer(data, "<u4", offset=_HEAD.size + n_lower + n_upper)

    def __len__(self) -> int:
        return self.n

    def select(self, i: int) -> int:
        """The i-th number, from 0."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        at = int(self.samples[i // SAMPLE])
        stop = int(self.samples[i // SAMPLE + 1]) if i // SAMPLE + 1 < len(self.samples) else 8 * len(self.upper)
        ones = np.flatnonzero(np.unpackbits(self.upper[at // 8 : stop // 8 + 1], bitorder="little"))
        # ones of the first byte that stand before the sample belong to earlier numbers
        place = int(ones[np.searchsorted(ones, at % 8) + i % SAMPLE]) + at // 8 * 8
        return (place - i << self.low_bits) | self._low(i)

    def _low(self, i: int) -> int:
        if not self.low_bits:
            return 0
        first = i * self.low_bits
        some = int.from_bytes(self.lower[first // 8 : (first + self.low_bits + 7) // 8].tobytes(), "little")
        return some >> first % 8 & (1 << self.low_bits) - 1

    def values(self) -> np.ndarray:
        """All numbers, as unsigned 64-bit integers."""
        high = np.flatnonzero(np.unpackbits(self.upper, bitorder="little"))[: self.n].astype(np.uint64) - np.arange(self.n, dtype=np.uint64)
        out = high << np.uint64(self.low_bits)
        if self.low_bits:
            bits = np.unpackbits(self.lower, count=self.n * self.low_bits, bitorder="little").reshape(self.n, self.low_bits)
            for k in range(self.low_bits):
                out |= bits[:, k].astype(np.uint64) << np.uint64(k)
        return out

    def first_at_least(self, x: int) -> int:
        """Index of the first number that isn't below ``x``; the count of numbers if there's none. A binary search by select."""
        low, high = 0, self.n
        while low < high:
            middle = (low + high) // 2
            low, high = (middle + 1, high) if self.select(middle) < x else (low, middle)
        return low


def encode(numbers: np.ndarray) -> bytes:
    """Bytes of a non-decreasing sequence of unsigned 64-bit integers; may be empty."""
    v = np.ascontiguousarray(numbers, dtype=np.uint64)
    n = len(v)
    if not n:
        return _HEAD.pack(0, 0, 0, 0)
    if (v[1:] < v[:-1]).any():
        raise ValueError("an Elias-Fano sequence doesn't fall")
    largest = int(v[-1])
    low_bits = max(0, (largest // n).bit_length() - 1)
    places = (v >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
    bits = np.zeros(int(places[-1]) + 1, dtype=np.uint8)
    bits[places] = 1
    upper = np.packbits(bits, bitorder="little")
    lower = np.empty((n, low_bits), dtype=np.uint8)
    for k in range(low_bits):
        lower[:, k] = (v >> np.uint64(k) & np.uint64(1)).astype(np.uint8)
    return _HEAD.pack(n, largest, low_bits, len(upper)) + np.packbits(lower, bitorder="little").tobytes() + upper.tobytes() + places[::SAMPLE].astype("<u4").tobytes()
