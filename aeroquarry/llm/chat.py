"""Operator 4: reply trees formatted as conversations.

Messages point to their parent. Iterative self-joins by doubling reach (each
join lets a node jump twice as far, so depth d takes log2 d of them) give every
leaf its path to the root; branches of a tree are ranked by the sum of their
scores, and each chosen path becomes one conversation. Only DataFrame functions
run.

Template: ``<turn>role\\ntext</turn>\\n`` for each turn. Inside roles and texts
``\\`` becomes ``\\b`` and ``<`` becomes ``\\l``, so no control string can occur
there; role line breaks become ``\\n`` likewise. ``loss`` lists the spans
(start, length; code points of the formatted string) of assistant texts.

Defined results: null roles and texts are empty; turns with equal numbers are
ordered by role, then by the SHA-256 of the text; repeated rows stay; a null tree id is a tree of
its own; a parent that is not in its tree makes its child a root; messages on a
cycle have no root and belong to no path; branches of equal score are ranked
longer first, then by the least leaf; very long texts stay whole (a
tree's messages meet in one task, which sorts them on disk if need be, as a
conversation is one string); all rows with a null conversation are one tree;
further columns are ignored, whatever their names; an empty table gives an
empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._util import Scratch

OPEN, CLOSE = "<turn>", "</turn>\n"
LEARNT = "assistant"


def escape(text: Column) -> Column:
    return F.replace(F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\b")), F.lit("<"), F.lit("\\l"))


def unescape(text: Column) -> Column:
    """Each backslash of an escaped text starts a pair, so the order of the two steps is safe."""
    return F.replace(F.replace(text, F.lit("\\l"), F.lit("<")), F.lit("\\b"), F.lit("\\"))


def _escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def _unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("\\n"), F.lit("\n")))


def chain(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Linear conversations (conv_id, turn, role, text) as reply trees: each turn replies to the one before.

    Returns the links (tree_id, node_id, parent_id, score) and what is said (tree_id, node_id, role, text). A node's
    id is a hash of its turn, role and text, so that texts needn't move to get it; equal rows are one node, said
    as often as there are rows.
    """
    rows = conversations.select(
        F.col("conv_id").alias("tree_id"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    ).withColumn("node_id", F.xxhash64("turn", "role", "text"))
    nodes = rows.select("tree_id", "turn", "role", F.sha2("text", 256).alias("digest"), "node_id").distinct()
    before = F.lag("node_id").over(Window.partitionBy("tree_id").orderBy("turn", "role", "digest"))
    return nodes.select("tree_id", "node_id", before.alias("parent_id"), F.lit(0.0).alias("score")), rows.select("tree_id", "node_id", "role", "text")


def best_paths(messages: DataFrame, top: int = 1) -> DataFrame:
    """(tree_id, leaf, rank, depth, node_id): the nodes of the ``top`` branches of each tree, from links (tree_id, node_id, parent_id, score)."""
    scratch = Scratch(messages.sparkSession, "reply-trees")
    links = scratch.save(messages.select("tree_id", "node_id", "parent_id", F.coalesce("score", F.lit(0.0)).alias("score")), "links")
    known = links.select(F.col("tree_id").alias("t"), F.col("node_id").alias("n"))
    same = lambda a, b: F.col(a).eqNullSafe(F.col(b))
    # A jump leads some power of two steps up; it is null past the root. `gain` and `depth` sum what lies on the way.
    # Only nodes that have not passed their root yet are joined again; the others are done.
    jump = links.join(known, same("tree_id", "t") & (F.col("parent_id") == F.col("n")), "left").select(
        "tree_id", "node_id", F.col("n").alias("up"), F.col("score").alias("gain"), F.lit(1).cast("long").alias("depth")
    )
    table = scratch.save(jump, "jump0")
    jumps, done, nodes = [], table.where("up IS NULL"), None
    active = table.where("up IS NOT NULL")
    while active.limit(1).count():
        jumps.append(active)
        nodes = links.count() if nodes is None else nodes
        if 2 ** (len(jumps) - 1) > nodes:  # only cycles climb further than there are nodes
            break
        above = active.unionByName(done).select(F.col("tree_id").alias("t"), F.col("node_id").alias("n"), F.col("up").alias("far"), F.col("gain").alias("g"), F.col("depth").alias("d"))
        step = active.join(above, same("tree_id", "t") & (F.col("up") == F.col("n")), "left").select(
            "tree_id", "node_id", F.col("far").alias("up"), (F.col("gain") + F.col("g")).alias("gain"), (F.col("depth") + F.col("d")).alias("depth")
        )
        table = scratch.save(step, f"jump{len(jumps)}")
        done = done.unionByName(table.where("up IS NULL"))
        active = table.where("up IS NOT NULL")
    parents = links.where("parent_id IS NOT NULL").select(F.col("tree_id").alias("t"), F.col("parent_id").alias("n")).distinct()
    leaves = done.join(parents, same("tree_id", "t") & (F.col("node_id") == F.col("n")), "left_anti")
    if top == 1:
        best = F.max_by(F.struct("node_id", "depth"), F.struct("gain", "depth", F.bitwise_not("node_id")))
        picked = leaves.groupBy("tree_id").agg(best.alias("b")).select("tree_id", F.col("b.node_id").alias("leaf"), F.lit(1).alias("rank"), F.col("b.depth").alias("depth"))
    else:
        order = Window.partitionBy("tree_id").orderBy(F.desc("gain"), F.desc("depth"), "node_id")
        picked = leaves.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).select("tree_id", F.col("node_id").alias("leaf"), "rank", "depth")
    parts = [scratch.save(picked.withColumn("node_id", F.col("leaf")), "path")]
    for k in range(len(jumps) - 1, -1, -1):  # all sums of distinct powers of two: every distance once
        hop = jumps[k].select(F.col("tree_id").alias("t"), F.col("node_id").alias("n"), "up")
        more = reduce(DataFrame.unionByName, parts).join(hop, same("tree_id", "t") & (F.col("node_id") == F.col("n"))).select(
            "tree_id", "leaf", "rank", (F.col("depth") - 2**k).alias("depth"), F.col("up").alias("node_id")
        )
        parts.append(scratch.save(more, f"path{k}"))
    return reduce(DataFrame.unionByName, parts)


def format_paths(messages: DataFrame, path: DataFrame) -> DataFrame:
    """(tree_id, leaf, rank, formatted, loss): each path in one string, with the mask of what is learnt."""
    # Messages and path nodes meet in one exchange by tree, which also serves the conversations made from them.
    said = messages.select("tree_id", "node_id", "role", "text", F.lit(None).cast("struct<leaf:bigint,rank:int,depth:bigint>").alias("on"))
    on = F.struct(F.col("leaf").cast("long").alias("leaf"), F.col("rank").cast("int").alias("rank"), F.col("depth").cast("long").alias("depth"))
    nodes = path.select("tree_id", "node_id", F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"), on.alias("on"))
    met = said.unionByName(nodes).repartition("tree_id").withColumn("ons", F.collect_list("on").over(Window.partitionBy("tree_id", "node_id")))
    rows = met.where("on IS NULL").select("tree_id", "role", "text", F.explode("ons").alias("on")).select("tree_id", "role", "text", "on.leaf", "on.rank", "on.depth")
    turn = F.struct(
        "depth",
        F.concat(F.lit(OPEN), _escape_role(F.col("role")), F.lit("\n")).alias("head"),
        escape(F.col("text")).alias("body"),
        F.coalesce(F.col("role") == LEARNT, F.lit(False)).alias("learnt"),
    )
    grouped = rows.groupBy("tree_id", "leaf", "rank").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    size = lambda t: F.length(t["head"]) + F.length(t["body"]) + len(CLOSE)
    # Spans by a fold that carries the offset; a span is appended only for learnt turns.
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans"))
    step = lambda a, t: F.struct(
        (a["at"] + size(t)).alias("at"),
        F.when(t["learnt"], F.concat(a["spans"], F.array(F.struct((a["at"] + F.length(t["head"])).alias("start"), F.length(t["body"]).alias("length"))))).otherwise(a["spans"]).alias("spans"),
    )
    return grouped.select(
        "tree_id", "leaf", "rank",
        F.array_join(F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit(CLOSE))), "").alias("formatted"),
        F.aggregate("turns", start, step)["spans"].alias("loss"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """Adds ``turns`` (array of role, text) and ``loss_text``, parsed from ``formatted`` and ``loss`` alone."""
    pieces = F.split("formatted", CLOSE)
    parsed = F.transform(
        F.slice(pieces, F.lit(1), F.size(pieces) - 1),  # the last piece is what follows the last turn: nothing
        lambda p: F.struct(
            _unescape_role(F.substring_index(F.substr(p, F.lit(len(OPEN) + 1)), "\n", 1)).alias("role"),
            unescape(F.substr(p, F.instr(p, "\n") + 1)).alias("text"),
        ),
    )
    learnt = F.array_join(F.transform("loss", lambda s: unescape(F.substr(F.col("formatted"), s["start"] + 1, s["length"]))), "")
    return formatted.withColumns({"turns": parsed, "loss_text": learnt})
