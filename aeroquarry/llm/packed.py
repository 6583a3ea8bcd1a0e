"""Rows of many small numbers as one binary value: compact in a shuffle, and arrays again on arrival."""

from __future__ import annotations

import numpy as np
import zstandard


def pack(*arrays: np.ndarray) -> bytes:
    head = np.array([len(arrays), *(a.nbytes for a in arrays)], np.int64).tobytes()
    kinds = b"".join(a.dtype.str.encode().ljust(4) for a in arrays)
    return zstandard.ZstdCompressor(level=1).compress(head + kinds + b"".join(np.ascontiguousarray(a).tobytes() for a in arrays))


def unpack(data: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    n = int(np.frombuffer(raw, np.int64, 1)[0])
    sizes = np.frombuffer(raw, np.int64, n, 8).tolist()
    at, out = 8 + 12 * n, []
    for i, size in enumerate(sizes):
        kind = np.dtype(raw[8 + 8 * n + 4 * i : 12 + 8 * n + 4 * i].decode().strip())
        out.append(np.frombuffer(raw, kind, size // kind.itemsize, at))
        at += size
    return out


def merged(payloads) -> list[np.ndarray]:
    parts = [unpack(bytes(p)) for p in payloads]
    return [np.concatenate(x) for x in zip(*parts, strict=True)]


def split_by(place: np.ndarray, *arrays: np.ndarray):
    order = np.argsort(place, kind="stable")
    sorted_place = place[order]
    cuts = np.flatnonzero(np.diff(sorted_place)) + 1
    lo = 0
    for hi in [*cuts.tolist(), len(order)]:
        if hi > lo:
            part = order[lo:hi]
            yield int(sorted_place[lo]), [a[part] for a in arrays]
        lo = hi
