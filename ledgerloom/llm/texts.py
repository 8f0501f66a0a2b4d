"""Blocks of texts as byte arrays: words, shingles and n-grams without a loop over words.

All hashes are polynomials over 64-bit integers that wrap around, mixed at the end.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at a time; a longer text is a block of its own.
BLOCK = 1 << 18

#: Bytes of ASCII that are no letters or digits become spaces, upper case becomes lower.
_FOLD = np.array([b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)], np.uint8)
_FOLD[65:91] += 32
#: First byte, range of the second, and length of punctuation beyond ASCII.
_PUNCTUATION = [(0xC2, 0x80, 0xA9, 2), (0xC2, 0xAB, 0xB4, 2), (0xC2, 0xB6, 0xB9, 2), (0xC2, 0xBB, 0xBF, 2), (0xC3, 0x97, 0x97, 2), (0xC3, 0xB7, 0xB7, 2), (0xE2, 0x80, 0x81, 3), (0xE3, 0x80, 0x80, 3)]
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_LETTERS = np.random.Generator(np.random.PCG64(11)).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SYMBOLS = _LETTERS.copy()
_LETTERS[32] = 0
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def blocks(batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = BLOCK) -> Iterator[pa.RecordBatch]:
    """The rows of the batches in slices of at most `limit` bytes of text, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + limit, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def strings(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts of a batch, empty ones for nulls."""
    return [x or "" for x in batch.column(column).to_pylist()]


def mixed(values: np.ndarray) -> np.ndarray:
    """Spreads 64-bit hashes over all their bits."""
    x = values ^ (values >> np.uint64(33))
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse."""
    if len(_powers[0]) < n:
        size = max(n, 2 * BLOCK)
        for k, factor in enumerate((_BASE, _INVERSE)):
            steps = np.full(size, factor, np.uint64)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers[0][:n], _powers[1][:n]


def raw_bytes(batch: pa.RecordBatch, column: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column and where each text starts (with the end); nulls are empty."""
    texts = pc.fill_null(batch.column(column), "").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    return np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def folded(batch: pa.RecordBatch, column: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column and where each text starts (with the end), ready for comparison.

    ASCII and Latin-1 letters become lower case. What is no letter or digit becomes a
    space: in ASCII, Latin-1, general and CJK punctuation. Nulls are empty.
    """
    raw, begins = raw_bytes(batch, column)
    data = _FOLD[raw]
    wide = np.flatnonzero(raw[:-1] >= 0xC2)
    if len(wide):
        lead, follow = raw[wide], raw[wide + 1]
        upper = wide[(lead == 0xC3) & (follow >= 0x80) & (follow <= 0x9E) & (follow != 0x97)]
        data[upper + 1] |= 0x20
        for lead_byte, low, high, width in _PUNCTUATION:
            at = wide[(lead == lead_byte) & (follow >= low) & (follow <= high)]
            for k in range(width):
                data[at + k] = 32
    return data, begins


def collapsed(data: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Folded texts with one space at most between words and none at their starts."""
    keep = data != 32
    keep[1:] |= keep[:-1]
    edges = begins[:-1][begins[:-1] < len(data)]
    keep[edges] = data[edges] != 32
    return data[keep], np.concatenate(([0], np.cumsum(keep)))[begins]


def grams(data: np.ndarray, size: int) -> np.ndarray:
    """A hash of the `size` bytes from each place on; there are len(data) - size + 1."""
    n = len(data)
    if n < size:
        return np.zeros(0, np.uint64)
    power, inverse = powers(n)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_SYMBOLS[data] * power, dtype=np.uint64)))
    return mixed((sums[size:] - sums[:-size]) * inverse[: n - size + 1])


def words(data: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes and byte positions of the words of folded texts; text i holds words offsets[i]:offsets[i + 1]."""
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(len(begins), np.int64)
    inside = data != 32
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    edges = begins[:-1][begins[:-1] < len(data)]
    first[edges] = inside[edges]
    starts = np.flatnonzero(first)
    offsets = np.searchsorted(starts, begins)
    if not len(starts):
        return np.zeros(0, np.uint64), starts, offsets
    power, inverse = powers(len(data))
    sums = np.add.reduceat(_LETTERS[data] * power, starts)
    return mixed(sums * inverse[starts]), starts, offsets


def shingles(hashes: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(text number, hash) of each run of `size` words; a shorter text is one run of all its words."""
    n = len(hashes)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    lengths = np.diff(offsets)
    text = np.repeat(np.arange(len(lengths)), lengths)
    sums = hashes.copy()
    factor = np.ones(1, np.uint64)
    ends = offsets[1:][text]
    at = np.arange(n)
    for j in range(1, min(size, n)):
        factor = factor * np.uint64(_BASE)
        shifted = np.zeros(n, np.uint64)
        shifted[: n - j] = hashes[j:] * factor
        shifted[at + j >= ends] = 0
        sums += shifted
    whole = at + size <= ends
    short = (lengths[text] < size) & (at == offsets[:-1][text])
    keep = whole | short
    return text[keep], mixed(sums[keep])


def counted(text: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (text number, hash) pairs in order with their counts; hashes keep 44 bits."""
    keys = (text.astype(np.uint64) << np.uint64(44)) | (hashes >> np.uint64(20))
    keys.sort()
    first = np.ones(len(keys), bool)
    first[1:] = keys[1:] != keys[:-1]
    at = np.flatnonzero(first)
    counts = np.diff(np.append(at, len(keys)))
    keys = keys[at]
    return (keys >> np.uint64(44)).astype(np.int64), keys & np.uint64((1 << 44) - 1), counts
