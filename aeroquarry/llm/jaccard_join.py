"""Operator 9: exact n-gram Jaccard join, size-aware.

Two texts link when the Jaccard similarity of their word-shingle sets reaches a
threshold. Shingles are counted over all documents first: a shingle of one text
can't be part of a link, so only shared ones go on. Every set is ordered from
rare to common, and linked sets must share part of a short prefix of that order;
most sets have enough shingles of their own to fill it, and leave at once.
Of the others, small sets enumerate fixed-size subsets (pairs) of their prefix,
large sets put single shingles into inverted lists; a cost model over the
measured subsets and list lengths places the boundary, and sets near it do both.

Lists are never expanded into pairs. All members of a list are tied to one of
them, and connected components of these ties are the candidate clusters: links
can only lie inside. Clusters are checked exactly, set against set; a large one
is split into blocks and checked block by block, so no task grows with it.
Checked links give each document's component.

Texts are identified by a 64-bit hash (copies of a text are one node, sent once
by each task), shingles by 48 bits and their bucket.

Defined results: null and blank texts have no shingles and link with nothing,
not even each other; texts of fewer words than a shingle are one shingle; texts
that are equal, or differ only in case and spacing, are in one component;
repeated rows are equal texts; rows with null ids link like others, but a
component's id is its least id that is not null; very long texts are read
whole, a task holding the shingles of one at a time; an empty table gives an
empty result; further columns are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import bitfilter, shingles
from ._util import BLANKS, Scratch
from .graph import components
from .packed import pack, split_by, unpack

#: Shingles that a task combines at once, that a bucket stands for, and that a group of texts gets back.
FLUSH_GRAMS, BUCKET_GRAMS, GROUP_GRAMS = 1_000_000, 3_000_000, 3_000_000
#: Sets of at most this size may enumerate subsets.
MOST_LIGHT = 64
#: Nodes that one block holds; a check sees two blocks at most.
BLOCK_NODES = 512
CHUNK = 4096
PARTS = "place int, payload binary"
CANDIDATES = "node long, n int, single int, pair int, scan long, rare array<long>, grams binary"


def least_overlap(n, pct: int):
    """Shingles that a set of n must share with any linked set."""
    return -(-pct * n // 100)


def prefix(n, pct: int, share: int = 1):
    """Rare-first shingles among which linked sets share at least ``share``."""
    return n - least_overlap(n, pct) + share


def _sizes(k: int):
    def run(batches):
        powers = shingles.Powers()
        for batch in batches:
            n = [len(s) for s in shingles.sets(batch.column(2), k, powers)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, pa.int64())], ["doc_id", "node", "n_shingles"])

    return run


def _dealt(k: int, buckets: int, groups: int):
    """Shingles of each task's texts by bucket, and set sizes by group (negative places); a text that the task has sent already is left out."""

    def flush(nodes: list[int], found: list[np.ndarray]):
        sizes = np.array([len(s) for s in found], np.int64)
        grams, owner = np.concatenate(found), np.repeat(np.arange(len(found), dtype=np.int32), sizes)
        own = np.array(nodes, np.int64)
        rows: list[tuple[int, bytes]] = []
        for g, (x, n) in split_by(_group(own, groups), own, sizes.astype(np.uint32)):
            rows.append((-1 - g, pack(x, n)))
        place = ((grams >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
        for b, (g, o) in split_by(place, grams, owner):
            docs, counts = np.unique(o, return_counts=True)  # order is kept, so owners rise
            rows.append((b, pack(own[docs], counts.astype(np.uint32), g.astype(np.uint32), (g >> np.uint64(32)).astype(np.uint16))))
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], ["place", "payload"])

    def run(batches):
        powers, seen, nodes, found, held = shingles.Powers(), set(), [], [], 0
        for batch in batches:
            fresh = []
            for i, node in enumerate(batch.column(0).to_pylist()):
                if node not in seen:
                    seen.add(node)
                    fresh.append(i)
            part = batch.take(pa.array(fresh, pa.int64()))
            for node, s in zip(part.column(0).to_pylist(), shingles.sets(part.column(1), k, powers), strict=True):
                if len(s):
                    nodes.append(node)
                    found.append(s)
                    held += len(s)
                if held >= FLUSH_GRAMS:
                    yield from flush(nodes, found)
                    nodes, found, held = [], [], 0
        if found:
            yield from flush(nodes, found)

    return run


def _group(node: np.ndarray, groups: int) -> np.ndarray:
    return (node.view(np.uint64) % np.uint64(groups)).astype(np.int64)


def _shared(groups: int):
    """Of a bucket's shingles those of two texts or more, with their counts, by group of texts; sizes go on to their group."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        bucket = int(pdf["place"].iloc[0])
        if bucket < 0:
            return pd.DataFrame({"place": -1 - bucket, "payload": pdf["payload"]})
        parts = [unpack(bytes(x)) for x in pdf["payload"]]
        nodes, index = np.unique(np.concatenate([x[0] for x in parts]), return_inverse=True)
        owner = np.repeat(index.astype(np.int32), np.concatenate([x[1] for x in parts]))
        gram = np.concatenate([x[2].astype(np.uint64) | (x[3].astype(np.uint64) << np.uint64(32)) for x in parts])
        del parts
        order = np.argsort(gram, kind="stable")
        gram, owner = gram[order], owner[order]
        del order
        # Drop what is alone at once; copies of a text from several tasks are told apart only among the rest.
        near = np.zeros(len(gram), bool)
        near[1:] = gram[1:] == gram[:-1]
        near[:-1] |= near[1:]
        gram, owner = gram[near], owner[near]
        order = np.lexsort((owner, gram))
        gram, owner = gram[order], owner[order]
        keep = np.ones(len(gram), bool)
        keep[1:] = (gram[1:] != gram[:-1]) | (owner[1:] != owner[:-1])
        gram, owner = gram[keep], owner[keep]
        heads = np.flatnonzero(np.append(True, gram[1:] != gram[:-1])) if len(gram) else np.zeros(0, np.int64)
        runs = np.diff(np.append(heads, len(gram)))
        count = np.repeat(runs, runs)
        more = count > 1
        node, gram, count = nodes[owner[more]], gram[more] | (np.uint64(bucket) << np.uint64(48)), count[more]
        out = []
        for g, (x, t, c) in split_by(_group(node, groups), node, gram, count):
            by = np.argsort(x, kind="stable")
            x, t, c = x[by], t[by], c[by]
            first = np.flatnonzero(np.append(True, x[1:] != x[:-1]))
            out.append((g, pack(x[first], np.diff(np.append(first, len(x))).astype(np.uint32), t, np.minimum(c, 2**32 - 1).astype(np.uint32))))
        return pd.DataFrame(out, columns=["place", "payload"])

    return run


def _candidates(pct: int):
    """Texts whose own shingles do not fill their prefix: its shared part, rare first, and all shared shingles."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        parts = [unpack(bytes(x)) for x in pdf["payload"]]
        sizes = {n: s for x in parts if len(x) == 2 for n, s in zip(x[0].tolist(), x[1].tolist(), strict=True)}
        parts = [x for x in parts if len(x) == 4]
        out = []
        if parts:
            node = np.concatenate([np.repeat(x[0], x[1]) for x in parts])
            gram, count = np.concatenate([x[2] for x in parts]), np.concatenate([x[3] for x in parts])
            order = np.lexsort((gram, count, node))
            node, gram, count = node[order], gram[order], count[order]
            heads = np.append(np.flatnonzero(np.append(True, node[1:] != node[:-1])), len(node))
            for a, b in zip(heads[:-1].tolist(), heads[1:].tolist(), strict=True):
                n = sizes[int(node[a])]
                own = n - (b - a)
                two = min(2, least_overlap(n, pct))
                single, pair = max(0, prefix(n, pct) - own), max(0, prefix(n, pct, two) - own)
                if max(single, pair) > 0:
                    rare = gram[a : a + max(single, pair)]
                    scan = int(count[a : a + single].sum())
                    out.append((int(node[a]), n, single, pair, scan, rare.view(np.int64), np.sort(gram[a:b]).tobytes()))
        return pd.DataFrame(out, columns=["node", "n", "single", "pair", "scan", "rare", "grams"])

    return run


def boundary(rows: list[tuple[int, int, int]], pct: int) -> int:
    """Largest size that enumerates subsets, from (size, subsets, list entries met) of small sets: the cheapest of all."""
    n = np.array([r[0] for r in rows])
    light, heavy = (np.array([float(r[i]) for r in rows]) for i in (1, 2))

    def cost(x: int) -> float:
        return float(light[n <= x].sum() + heavy[n >= least_overlap(x + 1, pct)].sum()) if len(rows) else 0.0

    return min(range(MOST_LIGHT + 1), key=cost)


def _keys(pct: int, edge: int):
    """List keys: pairs of a small set's prefix, single shingles of a large one's, both near the boundary."""

    def run(frames):
        for pdf in frames:
            nodes, keys = [], []
            for node, n, single, pair, rare in pdf[["node", "n", "single", "pair", "rare"]].itertuples(index=False):
                rare = np.asarray(rare, np.int64).view(np.uint64)
                if n <= edge:
                    first = rare[:pair]
                    if least_overlap(n, pct) >= 2:
                        i, j = np.triu_indices(len(first), 1)
                        a, b = np.minimum(first[i], first[j]), np.maximum(first[i], first[j])
                    else:
                        a = b = first
                    if least_overlap(n, pct) >= 2 > least_overlap(least_overlap(n, pct), pct):  # its least partner has singles only
                        a, b = np.append(a, rare[:single]), np.append(b, rare[:single])
                    keys.append(shingles.mix(a * shingles.PLACE_CODES[40] + b * shingles.PLACE_CODES[41]))
                    nodes.append(np.full(len(a), node, np.int64))
                if n >= least_overlap(edge + 1, pct):
                    keys.append(shingles.mix(rare[:single] + np.uint64(5)))
                    nodes.append(np.full(single, node, np.int64))
            if keys:
                yield pd.DataFrame({"node": np.concatenate(nodes), "key": np.concatenate(keys).view(np.int64)})

    return run


def overlaps(grams: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections, by products of 0/1 matrices in column chunks."""
    m = len(grams)
    if m == 2:
        both = len(np.intersect1d(grams[0], grams[1], assume_unique=True))
        return np.array([[len(grams[0]), both], [both, len(grams[1])]])
    rows = np.repeat(np.arange(m), [len(g) for g in grams])
    _, cols, counts = np.unique(np.concatenate(grams), return_inverse=True, return_counts=True)
    shared = counts > 1
    rename = np.cumsum(shared) - 1
    keep = shared[cols]
    rows, cols = rows[keep], rename[cols[keep]]
    order = np.argsort(cols, kind="stable")
    rows, cols = rows[order], cols[order]
    out = np.zeros((m, m), np.float64)
    for lo in range(0, int(shared.sum()), CHUNK):
        a, b = np.searchsorted(cols, (lo, lo + CHUNK))
        part = np.zeros((m, CHUNK), np.float32)
        part[rows[a:b], cols[a:b] - lo] = 1
        out += part @ part.T
    return np.rint(out).astype(np.int64)


def _linked(pct: int):
    def one(pdf: pd.DataFrame) -> list[tuple[int, int, int]]:
        grams = [np.frombuffer(g, np.uint64) for g in pdf["grams"]]
        nodes, side = pdf["node"].to_numpy(), pdf["side"].to_numpy()
        n = pdf["n"].to_numpy(np.int64)
        both = overlaps(grams)
        link = 100 * both >= pct * (n[:, None] + n[None, :] - both)
        np.fill_diagonal(link, False)
        if pdf["cross"].iloc[0]:
            link &= side[:, None] != side[None, :]
        root = list(range(len(nodes)))

        def find(x: int) -> int:
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        for x in np.flatnonzero(link.any(1)).tolist():
            for y in np.flatnonzero(link[x, :x]).tolist():
                a, b = find(x), find(y)
                if a != b:
                    root[max(a, b)] = min(a, b)
        degree = link.sum(1)
        return [(int(nodes[x]), int(nodes[find(x)]), int(degree[x])) for x in np.flatnonzero(degree).tolist()]

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        rows: list[tuple[int, int, int]] = []
        pdf = pdf.drop_duplicates(["label", "node"])
        for _, part in pdf.groupby("label", sort=False):
            if len(part) > 1:
                rows += one(part)
        return pd.DataFrame(rows, columns=["a", "b", "links"]).astype("int64")

    return run


def text_node(text: Column) -> Column:
    """The hash under which a text is a node."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def classes(docs: DataFrame, k: int = 4, pct: int = 85) -> DataFrame:
    """Per row: doc_id, node of its text, n_shingles, class (one for all nodes of a component) and links to other texts."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "jaccard")
    text = F.coalesce(F.col("text"), F.lit(""))
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_node(F.col("text")).alias("node"), text.alias("text"))
    ids = scratch.save(keyed.mapInArrow(_sizes(k), "doc_id long, node long, n_shingles long"), "ids")
    total = int(ids.agg(F.sum("n_shingles")).first()[0] or 0)
    buckets, groups = max(1, total // BUCKET_GRAMS), max(1, total // GROUP_GRAMS)
    dealt = keyed.select("node", "text").mapInArrow(_dealt(k, buckets, groups), PARTS)
    shared = dealt.groupBy("place").applyInPandas(_shared(groups), PARTS)
    rows = scratch.save(shared.groupBy("place").applyInPandas(_candidates(pct), CANDIDATES), "candidates")
    pairs = F.when(F.col("pair") > 1, F.col("pair") * (F.col("pair") - 1) / 2).otherwise(F.col("pair"))
    costs = rows.where(F.col("n") <= MOST_LIGHT).groupBy("n").agg(F.sum(pairs), F.sum("scan")).collect()  # a row for each small size
    edge = boundary([tuple(r) for r in costs], pct)
    entries = scratch.save(rows.select("node", "n", "single", "pair", "rare").mapInPandas(_keys(pct, edge), "node long, key long"), "entries")
    heads = entries.groupBy("key").agg(F.min("node").alias("hub"), F.max("node").alias("top")).where("hub < top").select(F.col("key").alias("k2"), "hub")
    ties = entries.join(heads, F.col("key") == F.col("k2")).where("node <> hub").select(F.col("node").alias("a"), F.col("hub").alias("b")).distinct()
    clusters = scratch.save(components(scratch.save(ties, "ties"), scratch, "clusters"), "clusters")
    # Clusters of at most a block are checked many at a time; larger ones block against block.
    counts = clusters.groupBy("label").agg(F.count(F.lit(1)).alias("size"))
    small = counts.where(F.col("size") <= BLOCK_NODES).agg(F.sum("size")).first()[0] or 0
    parts = max(1, int(small) // BLOCK_NODES)
    sized = clusters.join(counts.withColumnRenamed("label", "l2"), F.col("label") == F.col("l2")).drop("l2")
    blocks = F.ceil(F.col("size") / (BLOCK_NODES // 2)).cast("int")
    big = F.col("size") > BLOCK_NODES
    own = F.when(big, F.pmod(F.xxhash64("node"), blocks).cast("int")).otherwise(F.lit(0))
    other = F.explode(F.when(big, F.sequence(F.lit(0), blocks - 1)).otherwise(F.array(F.lit(0)))).alias("other")
    placed = sized.select("node", "label", "size", own.alias("own"), other).select(
        F.col("node").alias("n2"), "label", F.col("own").alias("side"), (F.col("own") != F.col("other")).alias("differ"),
        F.when(big, F.col("label")).otherwise(F.pmod(F.xxhash64("label"), F.lit(parts))).alias("g0"),
        F.when(big, F.least("own", "other")).otherwise(F.lit(-1)).alias("g1"), F.when(big, F.greatest("own", "other")).otherwise(F.lit(-1)).alias("g2"),
    )
    # Neither side has a size bound, so neither is ever broadcast.
    checked = rows.select("node", "n", "grams").join(placed.hint("merge"), F.col("node") == F.col("n2")).select("node", "n", "grams", "label", "side", F.col("differ").alias("cross"), "g0", "g1", "g2")
    links = scratch.save(checked.groupBy("g0", "g1", "g2").applyInPandas(_linked(pct), "a long, b long, links long"), "links")
    found = components(links.where("a <> b"), scratch, "found")
    degree = links.groupBy(F.col("a").alias("n3")).agg(F.sum("links").alias("n_links"))
    of_node = scratch.save(found.join(degree, F.col("node") == F.col("n3"), "left").select(F.col("node").alias("n4"), "label", "n_links"), "of_node")
    classed = ids.join(of_node, F.col("node") == F.col("n4"), "left").select("doc_id", "node", "n_shingles", F.coalesce("label", "node").alias("class"), F.coalesce("n_links", F.lit(0)).alias("n_links"))
    return scratch.save(classed, "classed")


def jaccard_join(docs: DataFrame, k: int = 4, pct: int = 85) -> DataFrame:
    """Per document: n_shingles, component_id (least doc_id of its component) and links to other texts."""
    scratch = Scratch(docs.sparkSession, "jaccard-ids")
    classed = classes(docs, k, pct).drop("node")
    some = classed.where("n_shingles > 0")
    # Stored, so that both sides of the join are plain exchanges: Spark can then split the class of a hot text.
    least = scratch.save(some.groupBy(F.col("class").alias("c2")).agg(F.min("doc_id").alias("least")), "least")
    joined = some.join(least, F.col("class") == F.col("c2"), "left").select("doc_id", "n_shingles", F.coalesce("least", "doc_id").alias("component_id"), "n_links")
    return joined.unionByName(classed.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"), "n_links"))


def one_of_each_class(docs: DataFrame, k: int = 5, pct: int = 80) -> DataFrame:
    """Rows of ``docs``, one of each class of near duplicates: the least by doc_id (nulls last), then by hash of the text.

    Rows are told apart by id and text together, so ids may be null or shared by different texts. Of rows that are
    equal in both one stays; texts without shingles (null, blank) are in no class and all stay. Columns pass through.

    Texts hardly move. A first bit filter holds the rows to be judged (removed, or repeated): what misses it stays.
    Every row's key is known, so the others that hit it by chance are known too: a second filter holds these and the
    repeated rows, and what hits only the first filter goes. The few rows that hit both are shuffled to be told
    apart exactly. The plan is the same at every size; past the filters' bounds more rows are shuffled.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "one-of-each")
    counted = classes(docs, k, pct).where("n_shingles > 0").groupBy("class", "doc_id", "node").agg(F.count(F.lit(1)).alias("copies"))
    counted = scratch.save(counted, "counted")
    least = counted.groupBy(F.col("class").alias("c2")).agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "node")).alias("least"))
    least = scratch.save(least, "least")
    stays = F.col("doc_id").eqNullSafe(F.col("least.doc_id")) & (F.col("node") == F.col("least.node"))
    decided = counted.join(least, F.col("class") == F.col("c2")).select("doc_id", "node", F.xxhash64("doc_id", "node").alias("key"), stays.alias("stays"), (F.col("copies") > 1).alias("again"))
    decided = scratch.save(decided, "decided")

    def filter_of(keys: DataFrame):
        bits = spark.sparkContext.broadcast(bitfilter.build(keys, "key", keys.count()))  # of bounded size

        @F.pandas_udf("boolean")
        def hit(keys: pd.Series) -> pd.Series:
            return pd.Series(bitfilter.hits(bits.value, keys.to_numpy(np.int64)))

        return hit(F.col("key"))

    judged = filter_of(decided.where("NOT stays OR again").select("key"))
    unsure = decided.where("stays AND again").select("key").unionByName(decided.where("stays AND NOT again").where(judged).select("key"))
    unsure = filter_of(scratch.save(unsure, "unsure"))
    text = F.col("text")
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("doc_id"), text_node(text).alias("node"), (F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS)) != "").alias("worded"))
    rows = rows.withColumn("key", F.xxhash64("doc_id", "node"))
    met = rows.where("worded").where(judged).where(unsure).dropDuplicates(["doc_id", "node"])
    gone = decided.where("NOT stays").select(F.col("doc_id").alias("gone_id"), F.col("node").alias("gone_node")).hint("merge")
    kept = met.join(gone, F.col("doc_id").eqNullSafe(F.col("gone_id")) & (F.col("node") == F.col("gone_node")), "left_anti")
    return rows.where(~F.col("worded") | ~judged).select("row.*").unionByName(kept.select("row.*"))
