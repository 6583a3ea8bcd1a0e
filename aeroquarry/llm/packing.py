"""Operator 5: best-fit packing with several permitted sequence lengths.

Documents (longer ones cut into pieces of the longest length) are packed into
sequences. Pieces go by falling size into the open bin that they fill best;
where none has room, a new bin is opened in the size of least cost, which is
the bin's own cost less what its free room is expected to be worth. That worth
is what joins the sizes: every shard is packed under several values of it and
keeps the plan that is cheapest after each bin is cut down to the least length
that holds its contents.

Pieces are dealt to shards of about ``shard_items`` by a hash of id, piece and
copy, so one task packs a bounded number of pieces whatever the input, and a
text of many copies is spread over all shards.

Defined results: a null or blank text has no words and one row without a bin;
repeated rows are packed one by one; a null id is an id like any other; items of
equal size go by id, piece and copy; of bins that are equally tight the one that
was filled last is taken; very long texts are cut into pieces whose number
follows their words; the plan depends only on ids and sizes; an empty table
gives an empty result; further columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._util import Scratch, numbered, word_count

LENGTHS = (512, 1024, 2048, 4096)
#: Fixed cost of a sequence, in words: what its padding, mask and bookkeeping take.
OVERHEAD = 16
WORTHS = (0.0, 0.5, 0.8, 0.9, 0.95, 1.0)
PLACED = "doc_id long, piece int, copy int, start_word long, n_words long, bin_id long, bin_capacity int, bin_used int"


def best_fit(sizes: Sequence[int], lengths: Sequence[int], worth: float, overhead: int = OVERHEAD) -> tuple[list[int], list[int]]:
    """Bins of items given in falling size: each item's bin, and each bin's contents."""
    room: list[list[int]] = [[] for _ in range(max(lengths) + 1)]  # open bins by free words
    some = 0  # bit r is set while room[r] is not empty
    place, used = [], []
    for size in sizes:
        fits = some >> size
        if fits:
            free = size + (fits & -fits).bit_length() - 1
            b = room[free].pop()
            if not room[free]:
                some ^= 1 << free
        else:
            free = min((c + overhead - worth * (c - size), c) for c in lengths if c >= size)[1]
            b = len(used)
            used.append(0)
        used[b] += size
        place.append(b)
        left = free - size
        if left:
            room[left].append(b)
            some |= 1 << left
    return place, used


def cheapest(sizes: Sequence[int], lengths: Sequence[int] = LENGTHS, overhead: int = OVERHEAD) -> tuple[list[int], list[int], list[int]]:
    """The plan of least cost over all worths: bins of items, contents and final lengths of bins."""
    ordered = np.array(sorted(lengths))
    best = None
    for worth in WORTHS:
        place, used = best_fit(sizes, lengths, worth, overhead)
        final = ordered[np.searchsorted(ordered, used)] if used else np.array([], int)
        cost = int(final.sum()) + overhead * len(used)
        if best is None or cost < best[0]:
            best = (cost, place, used, final.tolist())
    return best[1:]


def _packer(lengths: Sequence[int]):
    def pack(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["n_words", "doc_id", "piece", "copy"], ascending=[False, True, True, True], kind="stable")
        place, used, final = cheapest(pdf["n_words"].tolist(), lengths)
        at = np.array(place, np.int64)
        pdf["bin_id"] = key[0] * (1 << 32) + at
        pdf["bin_capacity"] = np.array(final, np.int32)[at]
        pdf["bin_used"] = np.array(used, np.int32)[at]
        return pdf[["doc_id", "piece", "copy", "start_word", "n_words", "bin_id", "bin_capacity", "bin_used"]]

    return pack


def pack(docs: DataFrame, lengths: Sequence[int] = LENGTHS, shard_items: int = 20_000) -> DataFrame:
    """A row for each piece of each document: where it starts, its words, its bin, the bin's length and contents."""
    longest = max(lengths)
    scratch = Scratch(docs.sparkSession, "packing")
    sized = docs.select(F.col("doc_id").cast("long").alias("doc_id"), word_count(F.col("text")).alias("size"))
    # Equal rows are counted before they are dealt out, then numbered: copies of one document spread over all shards.
    counted = scratch.save(sized.groupBy("doc_id", "size").agg(F.count(F.lit(1)).alias("copies")), "sized")
    pieces = F.when(F.col("size") > 0, F.sequence(F.lit(0), F.floor((F.col("size") - 1) / longest).cast("int"))).otherwise(F.array(F.lit(0)))
    each = numbered(counted, F.col("copies")).withColumn("copy", (F.col("nth") + 1).cast("int")).drop("nth").withColumn("piece", F.explode(pieces))
    each = each.withColumn("start_word", F.col("piece").cast("long") * longest).withColumn("n_words", F.least(F.col("size") - F.col("start_word"), F.lit(longest)).cast("long"))
    total = counted.agg(F.sum(F.col("copies") * F.ceil(F.col("size") / longest))).first()[0] or 0
    shards = max(1, -(-int(total) // shard_items))
    items = each.where("n_words > 0").select(
        F.pmod(F.xxhash64("doc_id", "piece", "copy"), F.lit(shards)).alias("shard"), "doc_id", "piece", "copy", "start_word", "n_words"
    )
    placed = items.groupBy("shard").applyInPandas(_packer(tuple(lengths)), PLACED)
    blank = each.where("n_words <= 0").select("doc_id", "piece", "copy", "start_word", F.lit(0).cast("long").alias("n_words"), F.lit(None).cast("long").alias("bin_id"), F.lit(None).cast("int").alias("bin_capacity"), F.lit(None).cast("int").alias("bin_used"))
    return placed.unionByName(blank)
