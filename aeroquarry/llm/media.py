"""Operator 8: media columns over content-addressed tar shards.

Payloads (a text's UTF-8 bytes, zero-padded to a multiple of 64) are stored as
8-bit greyscale PNG images 64 samples wide. Each writing task appends its images
to a tar shard of its own in the shared folder, once for each digest, and
reports (digest, shard, offset, length) for every row; a repeated task writes a
new file, and only the successful one is ever referred to. Metadata columns
come from reading an image's first 33 bytes at its offset; features come from
reading, decoding and checking the stored bytes.

Shards are read and written through Arrow's file systems, so any store that it
knows will do.

Defined results: a null text is empty and has 64 zero bytes; equal texts have
equal values; rows with null ids and repeated rows are stored like others and
share the bytes of equal texts; a very long text is one image, as high as its
length asks; an empty table gives an empty result; further columns are ignored,
whatever their names.
"""

from __future__ import annotations

import hashlib
import struct
import tarfile
import uuid
import zlib

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._util import Scratch

WIDTH = 64
HEADER_BYTES = 33
SIGNATURE = b"\x89PNG\r\n\x1a\n"
CATALOG = "doc_id long, n_bytes long, digest string, shard string, offset long, length long"
META = CATALOG + ", width int, height int, bit_depth int"
FEATURES = META + ", payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
#: Bytes of shards that one reading task takes.
READ_BYTES = 16 << 20


def payload_of(text: str | None) -> tuple[bytes, int]:
    data = (text or "").encode("utf-8", "surrogatepass")
    return data + bytes(-len(data) % WIDTH if data else WIDTH), len(data)


def _chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


def encode(payload: bytes) -> bytes:
    """A greyscale PNG with a row for each 64 bytes."""
    rows = np.frombuffer(payload, np.uint8).reshape(-1, WIDTH)
    lines = np.zeros((len(rows), WIDTH + 1), np.uint8)  # the first byte of a row: no filter
    lines[:, 1:] = rows
    head = struct.pack(">IIBBBBB", WIDTH, len(rows), 8, 0, 0, 0, 0)
    return SIGNATURE + _chunk(b"IHDR", head) + _chunk(b"IDAT", zlib.compress(lines.tobytes(), 6)) + _chunk(b"IEND", b"")


def header(data: bytes) -> tuple[int, int, int]:
    """Width, height and bit depth from the first bytes of an image."""
    if data[:8] != SIGNATURE or data[12:16] != b"IHDR":
        raise ValueError("not an image")
    width, height, depth = struct.unpack(">IIB", data[16:25])
    return width, height, depth


def decode(data: bytes) -> np.ndarray:
    width, height, _ = header(data)
    at, body = 8, []
    while at < len(data):
        size, kind = struct.unpack(">I4s", data[at : at + 8])
        chunk = data[at + 8 : at + 8 + size]
        if zlib.crc32(kind + chunk) != struct.unpack(">I", data[at + 8 + size : at + 12 + size])[0]:
            raise ValueError("damaged image")
        if kind == b"IDAT":
            body.append(chunk)
        at += 12 + size
    lines = np.frombuffer(zlib.decompress(b"".join(body)), np.uint8).reshape(height, width + 1)
    if lines[:, 0].any():
        raise ValueError("unexpected row filter")
    return np.ascontiguousarray(lines[:, 1:])


def feature(samples: np.ndarray) -> str:
    """A bit for each column whose mean is at least the mean of all, in hex."""
    bits = samples.mean(0, dtype=np.float64) >= samples.mean(dtype=np.float64)
    return np.packbits(bits).tobytes().hex()


def _opened(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def _writer(folder: str):
    def write(frames):
        files, base = _opened(folder)
        files.create_dir(base, recursive=True)
        task = TaskContext.get()
        name = f"shard-{task.partitionId():06d}-{task.taskAttemptId()}-{uuid.uuid4().hex[:8]}.tar"
        out, at, stored = None, 0, {}
        try:
            for pdf in frames:
                rows = []
                for doc_id, text in zip(pdf["doc_id"], pdf["text"], strict=True):
                    payload, n_bytes = payload_of(text if isinstance(text, str) else None)
                    digest = hashlib.sha256(payload).hexdigest()
                    if digest not in stored:
                        image = encode(payload)
                        info = tarfile.TarInfo(f"{digest[:2]}/{digest}.png")
                        info.size = len(image)
                        head = info.tobuf(tarfile.USTAR_FORMAT)
                        out = out or files.open_output_stream(f"{base}/{name}")
                        out.write(head + image + bytes(-len(image) % 512))
                        stored[digest] = (at + len(head), len(image))
                        at += len(head) + len(image) + (-len(image) % 512)
                    rows.append((doc_id, n_bytes, digest, name, *stored[digest]))
                yield pd.DataFrame(rows, columns=["doc_id", "n_bytes", "digest", "shard", "offset", "length"])
            if out:
                out.write(bytes(1024))
        finally:
            if out:
                out.close()

    return write


def store(docs: DataFrame, scratch: Scratch) -> tuple[DataFrame, str]:
    """Write the shards; the stored catalogue of all rows, and the folder that its shards lie in."""
    folder = scratch.path("shards")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return scratch.save(rows.mapInPandas(_writer(folder), CATALOG), "catalog"), folder


def _by_range(catalog: DataFrame) -> DataFrame:
    """Rows dealt so that each task reads a few stretches of shards, in order."""
    total = catalog.agg(F.sum("length")).first()[0] or 0
    stretch = F.floor(F.col("offset") / READ_BYTES)
    dealt = catalog.repartition(max(1, -(-int(total) // READ_BYTES)), "shard", stretch)
    return dealt.sortWithinPartitions("shard", "offset")


class _Reader:
    """Ranges of shards; the last one read is kept, as copies follow each other."""

    def __init__(self, folder: str) -> None:
        self.files, self.base = _opened(folder)
        self.name, self.file, self.key, self.data = None, None, None, b""

    def read(self, shard: str, offset: int, length: int) -> bytes:
        if self.name != shard:
            self.close()
            self.name, self.file = shard, self.files.open_input_file(f"{self.base}/{shard}")
        if self.key != (shard, offset, length):
            self.key, self.data = (shard, offset, length), self.file.read_at(length, offset)
        return self.data

    def close(self) -> None:
        if self.file:
            self.file.close()


def with_metadata(catalog: DataFrame, folder: str) -> DataFrame:
    """Adds width, height and bit depth by header-only range reads."""

    def read(frames):
        reader = _Reader(folder)
        for pdf in frames:
            heads = [header(reader.read(s, o, HEADER_BYTES)) for s, o in zip(pdf["shard"], pdf["offset"], strict=True)]
            pdf["width"], pdf["height"], pdf["bit_depth"] = zip(*heads, strict=True) if heads else ([], [], [])
            yield pdf
        reader.close()

    return catalog.mapInPandas(read, META)


def with_features(rows: DataFrame, folder: str) -> DataFrame:
    """Adds digests and features of the stored bytes, read back and decoded."""

    def read(frames):
        reader, key, last = _Reader(folder), None, ()
        for pdf in frames:
            out = []
            for digest, shard, offset, length in zip(pdf["digest"], pdf["shard"], pdf["offset"], pdf["length"], strict=True):
                if key != (shard, offset):
                    image = reader.read(shard, offset, length)
                    samples = decode(image)
                    payload = samples.tobytes()
                    sha = hashlib.sha256(payload).hexdigest()
                    if sha != digest:
                        raise ValueError(f"shard {shard} does not hold {digest} at {offset}")
                    key, last = (shard, offset), (len(payload), sha, zlib.crc32(payload[-WIDTH:]), len(image), hashlib.sha256(image).hexdigest(), feature(samples))
                out.append(last)
            for k, name in enumerate(("payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature")):
                pdf[name] = [r[k] for r in out]
            yield pdf
        reader.close()

    return rows.mapInPandas(read, FEATURES)


def media(docs: DataFrame) -> DataFrame:
    """Store every document's payload and return its catalogue row with metadata and features."""
    catalog, folder = store(docs, Scratch(docs.sparkSession, "media"))
    return with_features(with_metadata(_by_range(catalog), folder), folder)
