"""Word shingles of whole texts as 64-bit hashes, computed on Arrow buffers without a loop over words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
#: Bytes of text handled at once: the working arrays take about forty times as much.
SLICE_BYTES = 1 << 20
_P = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambler of 64-bit words."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


BYTE_CODES = mix((np.arange(256, dtype=np.uint64) + U(1)) * U(0xD1B54A32D192ED03))
PLACE_CODES = mix((np.arange(64, dtype=np.uint64) + U(77)) * U(0x8CB92BA72F3D8DD7)) | U(1)


class _Powers:
    """Powers of an odd number and of its inverse, modulo 2**64, grown as needed."""

    def __init__(self) -> None:
        self.up, self.down = np.ones(1, np.uint64), np.ones(1, np.uint64)

    def of(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            for name, base in (("up", _P), ("down", pow(_P, -1, 1 << 64))):
                a = np.full(n, base, np.uint64)
                a[0] = 1
                setattr(self, name, np.cumprod(a, dtype=np.uint64))
        return self.up[:n], self.down[:n]


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts (null: empty) and the offsets of each, from 0."""
    texts = texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts
    if texts.null_count:
        texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(texts.buffers()[1], np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0] : offsets[-1]] if texts.buffers()[2] is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def slices(offsets: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``most`` bytes; a longer text is a range of its own."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + most, side="right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)


def word_hashes(data: np.ndarray, offsets: np.ndarray, powers: _Powers, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """A hash for each word, and where each row's words begin (one more entry than rows)."""
    n = len(data)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    cut = np.zeros(n + 1, bool)
    cut[offsets] = True
    before = np.ones(n, bool)
    before[1:] = blank[:-1]
    starts = np.flatnonzero(~blank & (before | cut[:n]))
    after = np.ones(n, bool)
    after[:-1] = blank[1:]
    ends = np.flatnonzero(~blank & (after | cut[1:])) + 1
    if lower:
        data = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
    up, down = powers.of(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(BYTE_CODES[data] * up[:n], dtype=np.uint64, out=total[1:])
    words = mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    return words, np.searchsorted(starts, offsets)


def sets(texts: pa.Array, k: int, powers: _Powers | None = None) -> Iterator[np.ndarray]:
    """For each text its distinct shingles of k words, sorted; fewer words are one shingle, none no shingle."""
    powers = powers or _Powers()
    data, offsets = buffers(texts)
    for lo, hi in slices(offsets):
        own = offsets[lo : hi + 1] - offsets[lo]
        words, first = word_hashes(data[offsets[lo] : offsets[hi]], own, powers)
        m = max(0, len(words) - k + 1)
        grams = np.zeros(m, np.uint64)
        for j in range(k):
            grams += words[j : j + m] * PLACE_CODES[j]
        grams = mix(grams)
        for r in range(hi - lo):
            a, b = int(first[r]), int(first[r + 1])
            if b - a >= k:
                yield np.unique(grams[a : b - k + 1])
            elif b > a:
                yield mix((words[a:b] * PLACE_CODES[32 : 32 + b - a]).sum(dtype=np.uint64, keepdims=True) + U(b - a))
            else:
                yield np.zeros(0, np.uint64)


def as_long(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


Powers = _Powers
