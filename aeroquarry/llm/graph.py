"""Connected components over tables that never leave the executors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._util import Scratch


def components(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(node, label): the least node reachable over edges (a, b); nodes without edges do not appear.

    Each round passes the least label over every edge and then follows labels one
    step, so that distances halve; every round is a stored table.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both = scratch.save(both, f"{name}-edges")
    labels = scratch.save(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("a"), F.min("b")).alias("label")), f"{name}-0")
    turn = 0
    while True:
        turn += 1
        heard = both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("label").alias("heard"))
        told = labels.join(heard, F.col("node") == F.col("a")).select("node", F.col("label").alias("old"), F.least("label", "heard").alias("label"))
        ahead = labels.select(F.col("node").alias("n2"), F.col("label").alias("l2"))
        moved = told.join(ahead, F.col("label") == F.col("n2"), "left").select("node", "old", F.least("label", F.coalesce("l2", "label")).alias("label"))
        moved = scratch.save(moved, f"{name}-{turn}")
        same = not moved.where("old <> label").limit(1).count()
        labels = moved.select("node", "label")
        scratch.drop(f"{name}-{turn - 1}")
        if same:
            return labels
