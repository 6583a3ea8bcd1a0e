"""Operator 7: substring dedup with suffix arrays built by external induced sorting.

A byte goes if it lies in a string of ``LENGTH`` bytes that also starts in a
document with a smaller id.

Only strings that occur twice need sorting. Anchors (the least hash of the
``GRAM``-byte grams in each string of ``LENGTH`` bytes) are picked from the text
alone, so equal strings have equal anchors at equal places, and every match
shares the context of an anchor: the bytes that any such string around it can
reach. Equal contexts are found by hash, within a task first; all but those of
the least document are covered as they stand. Two contexts with a common string
agree on the bytes beside the anchor, on one side or the other. Where an anchor
has several contexts that do, by a hash of those bytes, one of each is sent to a
shard, and the shard's suffixes, sorted by
induction with queues that go to files in the shared folder beyond
``QUEUE_BYTES``, arrive with their common prefixes: neighbours that share
``LENGTH`` bytes hold the same string, which goes wherever a smaller document
holds it. An anchor with very many contexts is split by those bytes, each
context going by either side. Covered stretches of all anchors are joined by
document. No anchor, context or copy is dropped, and a stretch of text that many
documents share leaves each task at most once.

Defined results: a null text is empty; copies of a text with a smaller id are
removed whole if they have ``LENGTH`` bytes, else kept; rows with the same id are
the same document and don't cover each other; rows without an id cover nothing
and stay whole; very long texts are searched whole; an empty table gives an
empty result; further columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bitfilter, shingles
from ._util import Scratch
from .induced_sort import sort_suffixes
from .packed import merged, pack, split_by, unpack

LENGTH, GRAM = 50, 20
SPAN = LENGTH - GRAM  # anchors lie at most that far from the start of a string
#: Text that a task combines at once, that a bucket of anchors or a group of documents stands for, and that a shard sorts.
FLUSH_BYTES, BUCKET_BYTES, GROUP_BYTES, SHARD_BYTES = 32 << 20, 16 << 20, 4 << 20, 2 << 20
#: Memory of a sort's queues; contexts of one anchor beyond which they are dealt by the bytes beside it; so many bytes on either side.
QUEUE_BYTES, HOT_CONTEXTS, SIDE = 1 << 20, 4096, SPAN // 2
NO_HASH = np.uint64(2**64 - 1)
ROWS = "kind int, place int, items long, payload binary"


def row_key(doc_id: np.ndarray, node: np.ndarray) -> np.ndarray:
    """One hash for a row's id and text."""
    return shingles.mix(doc_id.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + node.view(np.uint64))


def sliding(x: np.ndarray, width: int, op, fill) -> np.ndarray:
    """``op`` over x[i : i + width] for each i; beyond the end stands ``fill``."""
    out, have = x, 1
    while have < width:
        step = min(have, width - have)
        moved = np.full(len(x), fill, x.dtype)
        moved[:-step] = out[step:] if step < len(x) else moved[:-step]
        out, have = op(out, moved), have + step
    return out


def anchors(data: np.ndarray, offsets: np.ndarray, powers) -> tuple[np.ndarray, ...]:
    """Of every anchor of the rows that ``offsets`` cut ``data`` into: row, place in the row, hashes of gram and context, and of the bytes to its left and right.

    A common string reaches ``SIDE`` bytes to the left of its anchor or more than that to the right; a side that a
    text is too short for has the hash 0.
    """
    n = len(data)
    none = np.zeros(0, np.int64)
    if n < LENGTH:
        return none, none, none.view(np.uint64), none.view(np.uint64), none.astype(np.uint16), none.astype(np.uint16)
    up, down = powers.of(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(shingles.BYTE_CODES[data] * up[:n], dtype=np.uint64, out=total[1:])
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    end = offsets[1:][row]
    at = np.arange(n)
    grams = np.full(n, NO_HASH, np.uint64)
    grams[: n - GRAM + 1] = shingles.mix((total[GRAM:] - total[: n - GRAM + 1]) * down[: n - GRAM + 1])
    grams[at + GRAM > end] = NO_HASH
    least = sliding(grams, SPAN + 1, np.minimum, NO_HASH)
    least[at + LENGTH > end] = 0  # no whole string starts here
    most = sliding(least[::-1], SPAN + 1, np.maximum, np.uint64(0))[::-1]  # over the strings that reach back from here
    p = np.flatnonzero((grams == most) & (most > 0) & (grams != NO_HASH))
    r = row[p]
    lo, hi = np.maximum(p - SPAN, offsets[r]), np.minimum(p + LENGTH, offsets[r + 1])
    context = shingles.mix((total[hi] - total[lo]) * down[lo] + ((hi - lo) * 64 + (p - lo)).astype(np.uint64) * np.uint64(0xA24BAED4963EE407))
    left = np.where(p - SIDE >= offsets[r], _short((total[p] - total[np.maximum(p - SIDE, 0)]) * down[np.maximum(p - SIDE, 0)]), 0)
    a, b = np.minimum(p + GRAM, n), np.minimum(p + GRAM + SPAN - SIDE + 1, n)
    right = np.where(p + GRAM + SPAN - SIDE + 1 <= offsets[r + 1], _short((total[b] - total[a]) * down[a]), 0)
    return r, p - offsets[r], grams[p], context, left.astype(np.uint16), right.astype(np.uint16)


def _short(x: np.ndarray) -> np.ndarray:
    """Hashes from 1 to 65535."""
    return shingles.mix(x) % np.uint64(65535) + np.uint64(1)


def cover_rows(doc, node, start, end, groups: int):
    """Rows that carry covered stretches to the group of their document."""
    place = (row_key(doc, node) % np.uint64(groups)).astype(np.int64)
    for g, (d, x, s, e) in split_by(place, doc, node, start.astype(np.uint32), end.astype(np.uint32)):
        yield (0, g, len(d), pack(d, x, s, e))


def _picked(buckets: int, groups: int):
    """Anchors of each task by bucket (kind 1), combined; stretches that the task itself can decide (kind 0)."""

    def flush(docs: list, texts: list):
        ids = np.array([d[0] for d in docs], np.int64)
        order = np.argsort(ids, kind="stable")
        seen, keep = set(), []
        for i in order.tolist():  # one row of each text, the least id
            if docs[i][1] not in seen:
                seen.add(docs[i][1])
                keep.append(i)
        ids = ids[keep]
        nodes = np.array([docs[i][1] for i in keep], np.int64)
        sizes = np.array([len(texts[i]) for i in keep], np.int64)
        powers, found = shingles.Powers(), []
        ends = np.concatenate([[0], np.cumsum(sizes)])
        for lo, hi in shingles.slices(ends):
            data = np.frombuffer(b"".join(texts[i] for i in keep[lo:hi]), np.uint8)
            r, p, g, c, left, right = anchors(data, ends[lo : hi + 1] - ends[lo], powers)
            found.append(((r + lo).astype(np.int32), p.astype(np.uint32), g, c, left, right))
        if not found:
            return
        r, p, g, c, left, right = (np.concatenate(x) for x in zip(*found, strict=True))
        by = np.argsort(c, kind="stable")  # rows are in id order, so each context's least id comes first
        first = np.ones(len(by), bool)
        first[1:] = c[by[1:]] != c[by[:-1]]
        head = by[np.flatnonzero(first)][np.cumsum(first) - 1]
        later = np.zeros(len(by), bool)
        later[by] = ids[r[by]] > ids[r[head]]
        done = np.flatnonzero(later)
        if len(done):
            q = p[done].astype(np.int64)
            yield from cover_rows(ids[r[done]], nodes[r[done]], np.maximum(q - SPAN, 0), np.minimum(q + LENGTH, sizes[r[done]]), groups)
        rest = np.flatnonzero(~later)
        bucket = ((g[rest] >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
        for b, (x,) in split_by(bucket, rest):
            rows, counts = np.unique(r[x], return_counts=True)  # x is in row order
            short = (g[x] & np.uint64(0xFFFFFFFF)).astype(np.uint32)
            yield (1, b, len(x), pack(ids[rows], nodes[rows], sizes[rows], counts.astype(np.uint32), p[x], short, c[x], left[x], right[x]))

    def run(batches):
        docs, texts, held = [], [], 0
        for batch in batches:
            for d, x, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                raw = t.encode("utf-8", "surrogatepass")
                if len(raw) >= LENGTH and d is not None:
                    docs.append((d, x))
                    texts.append(raw)
                    held += len(raw)
                if held >= FLUSH_BYTES:
                    yield from _batches(flush(docs, texts))
                    docs, texts, held = [], [], 0
        yield from _batches(flush(docs, texts))

    return run


def _batches(rows):
    for kind, place, items, payload in rows:
        yield pa.RecordBatch.from_arrays([pa.array([kind], pa.int32()), pa.array([place], pa.int32()), pa.array([items], pa.int64()), pa.array([payload], pa.binary())], ["kind", "place", "items", "payload"])


def _met(gram: np.ndarray, side: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Contexts that have the bytes on one side of their anchor in common with a context of another document."""
    key = gram.astype(np.int64) << 16 | side
    order = np.argsort(key, kind="stable")
    heads = np.flatnonzero(np.append(True, key[order[1:]] != key[order[:-1]])) if len(order) else order
    mixed = np.minimum.reduceat(doc[order], heads) < np.maximum.reduceat(doc[order], heads)
    out = np.zeros(len(key), bool)
    out[order] = np.repeat(mixed, np.diff(np.append(heads, len(key))))
    return out & (side > 0)


def _matched(groups: int):
    """Of a bucket's anchors: stretches whose whole context a smaller document has (0), and contexts to be sorted (2)."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        kind, bucket = int(pdf["kind"].iloc[0]), int(pdf["place"].iloc[0])
        if kind == 0:
            return pdf
        parts = [unpack(bytes(x)) for x in pdf["payload"]]
        counts = [x[3].astype(np.int64) for x in parts]
        doc, node, size = (np.concatenate([np.repeat(x[i], n) for x, n in zip(parts, counts, strict=True)]) for i in range(3))
        p, short, context, left, right = (np.concatenate([x[i] for x in parts]) for i in (4, 5, 6, 7, 8))
        p = p.astype(np.int64)
        order = np.lexsort((p, doc, context, short))
        doc, node, size, p, short, context, left, right = (a[order] for a in (doc, node, size, p, short, context, left, right))
        n = len(doc)
        new_gram = np.ones(n, bool)
        new_gram[1:] = short[1:] != short[:-1]
        new_context = new_gram.copy()
        new_context[1:] |= context[1:] != context[:-1]
        heads = np.flatnonzero(new_context)
        which = np.cumsum(new_context) - 1
        least = doc[heads]
        later = doc > least[which]
        out = list(cover_rows(doc[later], node[later], np.maximum(p - SPAN, 0)[later], np.minimum(p + LENGTH, size)[later], groups)) if later.any() else []
        gram_of = (np.cumsum(new_gram) - 1)[heads]
        edges = np.flatnonzero(np.append(True, gram_of[1:] != gram_of[:-1]))
        differ = _met(gram_of, left[heads], least) | _met(gram_of, right[heads], least)
        ask = differ[which] & ~later
        if ask.any():
            place = (row_key(doc[ask], node[ask]) % np.uint64(groups)).astype(np.int64)
            gram = (np.int64(bucket) << 32) | short[ask].astype(np.int64)
            hot = (np.diff(np.append(edges, len(heads))) > HOT_CONTEXTS)[gram_of][which[ask]]
            for g, arrays in split_by(place, doc[ask], node[ask], gram, which[ask].astype(np.int64), p[ask], hot):
                out.append((2, g, len(np.unique(arrays[3])), pack(*arrays)))
        return pd.DataFrame(out, columns=["kind", "place", "items", "payload"])

    return run


def _keys(pdfs):
    for pdf in pdfs:
        found = [np.unique(row_key(x[0], x[1])) for x in (unpack(bytes(p)) for p in pdf["payload"])]
        yield pd.DataFrame({"key": np.concatenate(found).view(np.int64) if found else np.zeros(0, np.int64)})


def _texts(bits, groups: int):
    """Texts of the rows that the filter lets through, with their group."""

    def run(batches):
        table = bits.value
        for batch in batches:
            doc, node = (np.ascontiguousarray(batch.column(i).to_numpy(zero_copy_only=False)) for i in (0, 1))
            key = row_key(doc, node)
            hit = np.flatnonzero(bitfilter.hits(table, key))
            if len(hit):
                taken = batch.take(pa.array(hit))
                place = pa.array((key[hit] % np.uint64(groups)).astype(np.int32))
                yield pa.RecordBatch.from_arrays([place, *taken.columns], ["place", "doc_id", "node", "text"])

    return run


def _by_row(doc: np.ndarray, node: np.ndarray) -> dict[tuple[int, int], np.ndarray]:
    """Indexes of each (id, text)."""
    order = np.lexsort((node, doc))
    cut = np.flatnonzero((np.diff(doc[order]) != 0) | (np.diff(node[order]) != 0)) + 1
    return {(int(doc[x[0]]), int(node[x[0]])): x for x in np.split(order, cut) if len(x)}


def _shards_of(gram: int, raw: bytes, at: int, shards: int) -> set[int]:
    """Where a context of a hot anchor goes. A common string reaches ``SIDE`` bytes to the left of the anchor or more than that to the right."""
    sides = []
    if at >= SIDE:
        sides.append((1, raw[at - SIDE : at]))
    if len(raw) >= at + GRAM + SPAN - SIDE + 1:
        sides.append((2, raw[at + GRAM : at + GRAM + SPAN - SIDE + 1]))
    return {zlib.crc32(b, zlib.crc32(gram.to_bytes(8, "big", signed=True), side)) % shards for side, b in sides}


def _cut(shards: int):
    """Context bytes of the asked anchors, by shard."""

    def run(texts: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(texts) and len(asked):
            doc, node, gram, context, p, hot = merged(asked["payload"])
            rows = _by_row(doc, node)
            found: dict[int, list] = {}
            for d, x, t in texts.drop_duplicates(["doc_id", "node"])[["doc_id", "node", "text"]].itertuples(index=False):
                at = rows.get((d, x))
                if at is None:
                    continue
                raw = t.encode("utf-8", "surrogatepass")
                at = at[np.lexsort((p[at], context[at], gram[at]))]
                g, c, q = gram[at], context[at], p[at]
                cuts = np.flatnonzero((np.diff(g) != 0) | (np.diff(c) != 0)) + 1
                for same in np.split(np.arange(len(at)), cuts):
                    first = int(q[same[0]])
                    lo = max(first - SPAN, 0)
                    for shard in _shards_of(int(g[same[0]]), raw, first, shards) if hot[at[same[0]]] else (int(shingles.mix(g[same[:1]].view(np.uint64))[0] % np.uint64(shards)),):
                        found.setdefault(shard, []).append((d, x, first - lo, raw[lo : first + LENGTH], q[same]))
            for shard, items in found.items():
                out.append((
                    3, shard, len(items),
                    pack(
                        np.array([i[0] for i in items], np.int64), np.array([i[1] for i in items], np.int64), np.array([i[2] for i in items], np.int64),
                        np.array([len(i[3]) for i in items], np.int64), np.array([len(i[4]) for i in items], np.int64),
                        np.frombuffer(b"".join(i[3] for i in items), np.uint8), np.concatenate([i[4] for i in items]),
                    ),
                ))
        return pd.DataFrame(out, columns=["kind", "place", "items", "payload"])

    return run


class _Repeats:
    """Takes sorted suffixes block by block and keeps the starts of strings that a smaller document holds too."""

    def __init__(self, doc_of: np.ndarray) -> None:
        self.doc_of, self.open, self.hits = doc_of, np.zeros(0, np.int32), []

    def emit(self, pos: np.ndarray, shared: np.ndarray) -> None:
        new = np.concatenate([np.arange(len(self.open)) == 0, shared < LENGTH])
        new[:1] = True
        pos = np.concatenate([self.open, pos])
        heads = np.flatnonzero(new)
        self._close(pos[: heads[-1]], heads[:-1])
        self.open = pos[heads[-1] :].copy()

    def _close(self, pos: np.ndarray, heads: np.ndarray) -> None:
        if len(pos):
            doc = self.doc_of[pos]
            least = np.repeat(np.minimum.reduceat(doc, heads), np.diff(np.append(heads, len(pos))))
            self.hits.append(pos[doc > least])

    def finish(self) -> np.ndarray:
        self._close(self.open, np.zeros(1, np.int64))
        return np.sort(np.concatenate(self.hits)) if self.hits else np.zeros(0, np.int32)


def repeated(doc: np.ndarray, sizes: np.ndarray, data: np.ndarray, folder: str) -> tuple[np.ndarray, np.ndarray, int]:
    """Strings that a smaller document holds too: their context and their start in it; and the bytes that the sort's queues wrote."""
    begins = np.concatenate([[0], np.cumsum(sizes + 1)])
    text = np.zeros(int(begins[-1]), np.uint16)
    inside = np.ones(len(text), bool)
    inside[begins[1:] - 1] = False
    text[inside] = data.astype(np.uint16) + 1
    # A suffix shorter than a string shares too little with any other, so only whole strings are ever compared.
    found = _Repeats(np.repeat(doc, sizes + 1))
    written = sort_suffixes(text, folder, found.emit, QUEUE_BYTES, LENGTH)
    hit = found.finish()
    owner = np.searchsorted(begins, hit, side="right") - 1
    return owner, hit - begins[owner], written


def _sorted(groups: int, folder: str):
    """Covered stretches from a shard's sorted suffixes (kind 0); what its queues wrote (kind 4)."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        doc, node, left, sizes, places, data, p = merged(pdf["payload"])
        which, start, written = repeated(doc, sizes, data, folder)
        out = []
        if len(which):
            # Runs of neighbouring starts are one stretch; it lies at each place where the document has the context.
            new = np.ones(len(which), bool)
            new[1:] = (np.diff(which) != 0) | (np.diff(start) != 1)
            head = np.flatnonzero(new)
            tail = np.append(head[1:], len(which)) - 1
            w, lo, hi = which[head], start[head], start[tail] + LENGTH
            first = np.concatenate([[0], np.cumsum(places)])
            each = places[w]
            at = np.repeat(first[w], each) + (np.arange(int(each.sum())) - np.repeat(np.cumsum(each) - each, each))
            base = p[at] - np.repeat(left[w], each)
            out = list(cover_rows(np.repeat(doc[w], each), np.repeat(node[w], each), base + np.repeat(lo, each), base + np.repeat(hi, each), groups))
        out.append((4, 0, written, b""))
        return pd.DataFrame(out, columns=["kind", "place", "items", "payload"])

    return run


CUT_ROWS = "doc_id long, node long, n_removed long, n_spans long, kept_sha256 string"


def _removed(texts: pd.DataFrame, covered: pd.DataFrame) -> pd.DataFrame:
    out = []
    if len(texts) and len(covered):
        doc, node, start, end = merged(covered["payload"])
        rows = _by_row(doc, node)
        for d, x, t in texts.drop_duplicates(["doc_id", "node"])[["doc_id", "node", "text"]].itertuples(index=False):
            at = rows.get((d, x))
            if at is None:
                continue
            raw = np.frombuffer(t.encode("utf-8", "surrogatepass"), np.uint8)
            edge = np.zeros(len(raw) + 1, np.int64)
            np.add.at(edge, start[at].astype(np.int64), 1)
            np.add.at(edge, end[at].astype(np.int64), -1)
            gone = np.cumsum(edge[:-1]) > 0
            runs = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
            out.append((d, x, int(gone.sum()), runs, hashlib.sha256(raw[~gone].tobytes()).hexdigest()))
    return pd.DataFrame(out, columns=["doc_id", "node", "n_removed", "n_spans", "kept_sha256"])


def suffix_dedup(docs: DataFrame) -> DataFrame:
    """Per document: n_bytes, n_removed, n_spans (runs removed) and kept_sha256 of what is left."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "suffix-dedup")
    text = F.coalesce(F.col("text"), F.lit(""))
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("node"), text.alias("text"))
    ids = scratch.save(keyed.select("doc_id", "node", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2(F.col("text"), 256).alias("whole")), "ids")
    total, n_docs = ids.agg(F.coalesce(F.sum("n_bytes"), F.lit(0)), F.count(F.lit(1))).first()
    buckets, groups = max(1, total // BUCKET_BYTES), max(1, total // GROUP_BYTES)
    picked = keyed.mapInArrow(_picked(buckets, groups), ROWS)
    matched = scratch.save(picked.groupBy("kind", "place").applyInPandas(_matched(groups), ROWS), "matched")
    asked, covered = matched.where("kind = 2"), matched.where("kind = 0")
    contexts = int(asked.agg(F.sum("items")).first()[0] or 0)
    if contexts:
        shards = max(1, contexts * (SPAN + LENGTH) // SHARD_BYTES)
        cut = _cogrouped(spark, keyed, n_docs, asked, groups, _cut(shards), ROWS)
        from_shards = cut.groupBy("place").applyInPandas(_sorted(groups, scratch.path("queues")), ROWS)
        covered = covered.unionByName(scratch.save(from_shards, "sorted").where("kind = 0"))
    changed = scratch.save(_cogrouped(spark, keyed, n_docs, covered, groups, _removed, CUT_ROWS), "changed")
    long = ids.where(F.col("n_bytes") >= LENGTH)
    # Stored, so that both sides of the join are plain exchanges: Spark can then split a text of very many copies.
    least = scratch.save(long.groupBy(F.col("node").alias("n2")).agg(F.min("doc_id").alias("least")), "least")
    edits = changed.select(F.col("doc_id").alias("d3"), F.col("node").alias("n3"), "n_removed", "n_spans", "kept_sha256")
    joined = long.join(least, F.col("node") == F.col("n2")).join(edits, (F.col("doc_id") == F.col("d3")) & (F.col("node") == F.col("n3")), "left")
    copy = F.col("doc_id") > F.col("least")
    none, empty = F.lit(0).cast("long"), F.lit(hashlib.sha256(b"").hexdigest())
    pick = lambda whole, edit, rest: F.when(copy, whole).otherwise(F.coalesce(edit, rest))
    out = joined.select(
        "doc_id", "n_bytes", pick(F.col("n_bytes"), F.col("n_removed"), none).alias("n_removed"),
        pick(F.lit(1).cast("long"), F.col("n_spans"), none).alias("n_spans"), pick(empty, F.col("kept_sha256"), F.col("whole")).alias("kept_sha256"),
    )
    short = ids.where(F.col("n_bytes") < LENGTH)  # too short to hold a string; empty texts, of which there may be very many, join nothing
    return out.unionByName(short.select("doc_id", "n_bytes", none.alias("n_removed"), none.alias("n_spans"), F.col("whole").alias("kept_sha256")))


def _cogrouped(spark, keyed: DataFrame, n_docs: int, rows: DataFrame, groups: int, step, schema: str) -> DataFrame:
    """``step`` over groups of documents: texts of the rows that ``rows`` speak of, and those rows."""
    bits = spark.sparkContext.broadcast(bitfilter.build(rows.select("payload").mapInPandas(_keys, "key long"), "key", n_docs))
    texts = keyed.mapInArrow(_texts(bits, groups), "place int, doc_id long, node long, text string")
    return texts.groupBy("place").cogroup(rows.select("place", "payload").groupBy("place")).applyInPandas(step, schema)
