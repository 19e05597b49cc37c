"""Elias-Fano coding of ascending whole numbers, with a select structure.

Each value is cut into `low_bits` low bits, stored as they are, and a high part, stored
in unary: the i-th value sets bit (high + i) of a bit vector. That takes about
2 + log2(largest / count) bits a value. Positions of every 256th set bit let `select`
return any value after looking at a few words; no table of 64-bit offsets is stored.
"""

from __future__ import annotations

import struct

import numpy as np

_SAMPLE = 256
_HEAD = "<QQBQQQ"


def _pack_bits(values: np.ndarray, width: int) -> bytes:
    """The lowest `width` bits of each value, one after the other."""
    if not width or not len(values):
        return b""
    shifts = np.arange(width, dtype=np.uint64)
    bits = ((values[:, None] >> shifts) & np.uint64(1)).astype(np.uint8)
    return np.packbits(bits.ravel(), bitorder="little").tobytes()


def encode(values: np.ndarray) -> bytes:
    """Bytes for ascending values (equal ones allowed) from 0 to 2**64 - 1."""
    values = np.asarray(values, np.uint64)
    count = len(values)
    largest = int(values[-1]) if count else 0
    width = max(0, (largest // count).bit_length() - 1) if count else 0
    low = _pack_bits(values, width)
    ones = (values >> np.uint64(width)).astype(np.int64) + np.arange(count)
    bits = np.zeros(int(ones[-1]) + 1 if count else 0, np.uint8)
    bits[ones] = 1
    high = np.packbits(bits, bitorder="little").tobytes()
    samples = ones[::_SAMPLE].astype("<u4" if len(bits) < 1 << 32 else "<u8").tobytes()
    return struct.pack(_HEAD, count, largest, width, len(low), len(high), len(samples)) + low + high + samples


class EliasFano:
    """Reads what `encode` wrote: `select(i)` for one value, `all()` for every value."""

    def __init__(self, data: bytes):
        self.count, self.largest, self.width, n_low, n_high, n_samples = struct.unpack_from(_HEAD, data)
        at = struct.calcsize(_HEAD)
        self.low = np.frombuffer(data, np.uint8, n_low, at)
        self.high = np.frombuffer(data, np.uint8, n_high, at + n_low)
        wide = n_samples > 4 * -(-self.count // _SAMPLE)
        raw = data[at + n_low + n_high : at + n_low + n_high + n_samples]
        self.samples = np.frombuffer(raw, "<u8" if wide else "<u4")

    def __len__(self) -> int:
        return self.count

    def select(self, i: int) -> int:
        """The i-th value: skip to the sampled set bit before it, then count bits byte by byte."""
        if not 0 <= i < self.count:
            raise IndexError(i)
        start = int(self.samples[i // _SAMPLE])
        left = i % _SAMPLE  # set bits to pass after `start`
        byte = start >> 3
        bits = int(self.high[byte]) >> (start & 7) << (start & 7)
        while left >= bits.bit_count():
            left -= bits.bit_count()
            byte += 1
            bits = int(self.high[byte])
        for _ in range(left):
            bits &= bits - 1
        one = (byte << 3) + (bits & -bits).bit_length() - 1
        return ((one - i) << self.width) | self._low(i)

    def _low(self, i: int) -> int:
        if not self.width:
            return 0
        first, last = i * self.width, (i + 1) * self.width
        word = int.from_bytes(self.low[first >> 3 : (last + 7) >> 3].tobytes(), "little")
        return (word >> (first & 7)) & ((1 << self.width) - 1)

    def all(self) -> np.ndarray:
        ones = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[: self.count]
        values = (ones - np.arange(self.count)).astype(np.uint64) << np.uint64(self.width)
        if self.width:
            bits = np.unpackbits(self.low, count=self.count * self.width, bitorder="little")
            shifts = np.arange(self.width, dtype=np.uint64)
            values |= (bits.reshape(self.count, self.width).astype(np.uint64) << shifts).sum(axis=1, dtype=np.uint64)
        return values
