"""Elias-Fano code of ascending integers, with random access by sampled select.

Of n values below u, the low log2(u / n) bits are kept as they are and the high ones as a
bit vector with one bit set for each value: about 2 + log2(u / n) bits a value in all. The
position of every 64th set bit is kept as a 32-bit integer; select counts bits from there.
"""

from __future__ import annotations

import struct

import numpy as np

_HEAD = struct.Struct("<QQB")
STEP = 64


def encode(values: np.ndarray) -> bytes:
    """Ascending integers of 0 or more; there may be none, and equal ones."""
    values = np.asarray(values, np.uint64)
    n, top = len(values), int(values[-1]) + 1 if len(values) else 0
    low = max(0, (top // n).bit_length() - 1) if n else 0
    head = _HEAD.pack(n, top, low)
    if not n:
        return head
    shifts = np.arange(low, dtype=np.uint64)
    bits = ((values[:, None] >> shifts) & np.uint64(1)).astype(np.uint8)
    places = (values >> np.uint64(low)).astype(np.int64) + np.arange(n)
    high = np.zeros(int(places[-1]) + 1, np.uint8)
    high[places] = 1
    samples = places[::STEP].astype("<u4").tobytes()
    return head + np.packbits(bits.ravel(), bitorder="little").tobytes() + samples + np.packbits(high, bitorder="little").tobytes()


class Values:
    """Reads the code of `encode` from a buffer; `size` is its length in bytes."""

    def __init__(self, buffer: bytes, at: int = 0):
        self.n, top, self.low = _HEAD.unpack_from(buffer, at)
        start = at + _HEAD.size
        lows = (self.n * self.low + 7) // 8
        self.lows = np.frombuffer(buffer, np.uint8, lows, start)
        count = -(-self.n // STEP)
        self.samples = np.frombuffer(buffer, "<u4", count, start + lows)
        highs = ((top - 1 >> self.low) + self.n + 7) // 8 if self.n else 0
        self.highs = np.frombuffer(buffer, np.uint8, highs, start + lows + 4 * count)
        self.size = _HEAD.size + lows + 4 * count + highs

    def __len__(self) -> int:
        return self.n

    def __getitem__(self, i: int) -> int:
        """Value i, by select of the i-th set bit."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        place, left = int(self.samples[i // STEP]), i % STEP
        byte, value = place >> 3, int(self.highs[place >> 3]) >> (place & 7) << (place & 7)
        while (ones := value.bit_count()) <= left:
            left -= ones
            byte += 1
            value = int(self.highs[byte])
        for _ in range(left):
            value &= value - 1
        place = byte * 8 + (value & -value).bit_length() - 1
        first = i * self.low
        window = int.from_bytes(self.lows[first >> 3 : (first + self.low + 7) >> 3].tobytes(), "little") >> (first & 7)
        return (place - i << self.low) | (window & ((1 << self.low) - 1))

    def all(self) -> np.ndarray:
        """All values as 64-bit integers."""
        if not self.n:
            return np.zeros(0, np.int64)
        places = np.flatnonzero(np.unpackbits(self.highs, bitorder="little"))[: self.n]
        out = (places - np.arange(self.n)) << self.low
        if self.low:
            bits = np.unpackbits(self.lows, count=self.n * self.low, bitorder="little").reshape(self.n, self.low)
            out |= bits.astype(np.int64) @ (1 << np.arange(self.low, dtype=np.int64))
        return out
