"""Operator 3: mixing sources to target weights by Pareto order sampling.

Sources (by code point, null last) carry repeating weights and share a budget
of words; a target stops at ``max_repeat`` times its source, and the excess is
shared anew by weight. Within a source the expected copies ``e`` of a document
are proportional to its measure, stopped at ``max_repeat``; what the stopped
ones can't take is shared anew among the others, so that the expected words
still add up to the target. A document first gets ``floor(e)`` certain copies.
For the rest, documents are ranked by the Pareto order statistic: the odds
``u / (1 - u)`` of a hashed uniform number divided by the inclusion odds
``f / (1 - f)``, ``f = e - floor(e)``; the lowest ranks are taken until their
words meet the source's remaining target, so the sample's size in words is fixed.

The measure is ``ln(e + size)`` unless a column is named: long documents, which
teach long contexts, have up to a few times the odds of short ones. It is used
in steps of about one percent, so its sums come from a table of a bounded
number of steps for each source. Only DataFrame functions run; ranks are cut by
two levels of histograms, so a source of any size is never sorted in one task.
The table of sources itself (one narrow row each) is sorted in one task.

Defined results: a null or blank text has size 0 and adds no words; null is a
source of its own; a measure that is null, NaN or not above zero counts as the
least one (``LEAST``); equal ranks are ordered by doc_id; rows equal in all
columns share a rank, and where the cut falls among them as many are taken as
come nearest to the target; very long texts are counted whole; an empty table
gives an empty result; further columns pass through, whatever their names. The
draw depends on nothing but the row's values and the seed.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._util import Scratch, numbered, unit_hash, word_count

#: Histogram cells for each level: the ranks left to sort shrink by this factor twice.
CELLS = 4096
#: Measures lie between these, in steps of a 64th of a power of two.
LEAST, MOST, STEPS = 2.0**-20, 2.0**20, 64


def targets(sources: DataFrame, weights: Sequence[int], share_pct: int, max_repeat: int) -> DataFrame:
    """(source, source_size) with ``target``: water-filling in closed form over the few rows of a sources table."""
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    pick = F.element_at(F.array(*(F.lit(w) for w in weights)), (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int"))
    rows = sources.withColumn("w", pick).withColumn("cap", F.col("source_size") * max_repeat)
    by_cap = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").isNull(), "source")
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy(F.lit(1))
    rows = rows.withColumns({
        "left": F.sum("source_size").over(every) * share_pct / 100 - F.coalesce(F.sum("cap").over(before), F.lit(0)),
        "w_left": F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), F.lit(0)),
    })
    # The level at which those not yet full share what is left; the first that it does not fill fixes it for all after.
    rows = rows.withColumn("level", F.col("left") / F.col("w_left"))
    open_level = F.min(F.when(F.col("cap") >= F.col("level") * F.col("w"), F.struct(F.col("cap") / F.col("w"), "level"))).over(every)["level"]
    share = F.col("w") * open_level
    return rows.select("source", "source_size", F.when(open_level.isNull() | (share > F.col("cap")), F.col("cap").cast("double")).otherwise(share).alias("target"))


def _cell(rank: Column, level: int) -> Column:
    """Cell of a rank in [0, 1) at a level."""
    at = F.floor(rank * float(CELLS**level))
    return at.cast("long") if level == 1 else F.pmod(at, F.lit(CELLS)).cast("long")


def _first_open(cells: DataFrame, keys: list[str], cell: str, budget: Column) -> DataFrame:
    """For each key the cell in which its budget runs out, with the words before it."""
    order = Window.partitionBy(*keys).orderBy(cell)
    run = cells.withColumn("__cum", F.sum("__words").over(order))
    over = F.min(F.when(F.col("__cum") > budget, F.struct(F.col(cell).alias("c"), (F.col("__cum") - F.col("__words")).alias("b"))))
    return run.groupBy(*keys, *([] if "__rest" in keys else ["__rest"])).agg(over.alias("__at"))


class Mix:
    """The decisions of a mix: targets of the sources, the copies that each step of the measure expects, and the cut of each source's ranks."""

    def __init__(self, docs: DataFrame, weights: Sequence[int] = (3, 1, 2), share_pct: int = 150, max_repeat: int = 2, seed: int = 17, measure: str | None = None) -> None:
        self.seed, self.max_repeat, self.measure = seed, max_repeat, measure
        scratch = Scratch(docs.sparkSession, "mixing")
        self.sized = scratch.save(self._sized(docs).drop("row"), "sized")
        self.steps = scratch.save(self.sized.groupBy("source", "step").agg(F.sum("size").alias("words")), "steps")
        sources = scratch.save(self.steps.groupBy("source").agg(F.sum("words").alias("source_size")), "sources")
        aims = scratch.save(targets(sources, weights, share_pct, max_repeat), "targets")
        factors = self._factors(aims)
        aims = aims.join(factors, F.col("source").eqNullSafe(F.col("__f")), "left").drop("__f")
        self.aims = scratch.save(aims.withColumnRenamed("source", "__s"), "aims")  # stored, so the planner knows how small it is
        self.ranked = scratch.save(self._ranked(self.sized), "ranked")
        self.bounds = self._bounds(scratch)
        self.split = self.bounds.where("part.u IS NOT NULL").limit(1).count() > 0

    def _sized(self, docs: DataFrame) -> DataFrame:
        """Whole rows as ``row``, with what decides about them. Rows equal in all columns have equal ``u``."""
        packed = docs.select(F.struct("*").alias("row"))
        others = [F.col(f"row.`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
        beside = F.xxhash64(F.to_json(F.struct(*others))) if others else F.lit(0)
        rows = packed.select(
            "row", F.col("row.doc_id").alias("doc_id"), F.col("row.source").cast("string").alias("source"), word_count(F.col("row.text")).alias("size"),
            unit_hash(F.lit(self.seed), F.col("row.doc_id"), F.xxhash64(F.coalesce(F.col("row.text"), F.lit(""))), beside).alias("u"),
        )
        m = F.col(f"row.`{self.measure}`").cast("double") if self.measure else F.log(F.col("size") + F.lit(math.e))
        m = F.least(F.greatest(F.coalesce(F.nanvl(m, F.lit(0.0)), F.lit(0.0)), F.lit(LEAST)), F.lit(MOST))
        return rows.withColumn("step", F.floor(F.log2(m) * STEPS).cast("int"))

    def _factors(self, aims: DataFrame) -> DataFrame:
        """For each source the factor that turns measures into expected copies; null where every document is stopped.

        Steps are stopped from the largest measure down; the factor is that of the first step which it doesn't stop.
        """
        order = Window.partitionBy("source").orderBy(F.desc("step"))
        above = order.rowsBetween(Window.unboundedPreceding, -1)
        onward = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
        aim = aims.select(F.col("source").alias("__t"), "target")
        rows = self.steps.join(aim, F.col("source").eqNullSafe(F.col("__t"))).withColumn("m", _measure(F.col("step")))
        left = F.col("target") - self.max_repeat * F.coalesce(F.sum("words").over(above), F.lit(0))
        rows = rows.withColumn("factor", F.try_divide(left, F.sum(F.col("words") * F.col("m")).over(onward)))
        return rows.where(F.col("factor") * F.col("m") <= self.max_repeat).groupBy(F.col("source").alias("__f")).agg(F.max_by("factor", "step").alias("factor"))

    def _ranked(self, sized: DataFrame) -> DataFrame:
        """Adds the source's figures, whole copies and the Pareto rank with its cells."""
        rows = sized.join(self.aims, F.col("source").eqNullSafe(F.col("__s")), "left").drop("__s")
        most = F.lit(float(self.max_repeat))
        expected = F.when(F.col("source_size") > 0, F.coalesce(F.least(F.col("factor") * _measure(F.col("step")), most), most)).otherwise(F.lit(0.0))
        rows = rows.withColumn("e", expected).withColumn("whole", F.floor("e")).withColumn("f", F.col("e") - F.col("whole"))
        # q = [u / (1 - u)] / [f / (1 - f)] is kept as q / (1 + q), which has the same order and lies in (0, 1).
        u, f = F.col("u"), F.col("f")
        rows = rows.withColumn("rank", F.when(f > 0, u * (1 - f) / (u * (1 - f) + f * (1 - u))))
        return rows.withColumns({"c1": _cell(F.col("rank"), 1), "c2": _cell(F.col("rank"), 2)})

    def _bounds(self, scratch: Scratch) -> DataFrame:
        """A row for each source: the cells in which its budget runs out, the last rank taken whole, and equal rows of which a part is taken."""
        on = F.col("source").eqNullSafe(F.col("__s"))
        # What is left of each target after the certain copies.
        rest = self.ranked.groupBy("source").agg((F.first("target") - F.sum(F.col("whole") * F.col("size"))).alias("__rest"))
        rest = scratch.save(rest.withColumnRenamed("source", "__s"), "rest")
        live = self.ranked.where(F.col("rank").isNotNull())
        level1 = live.groupBy("source", "c1").agg(F.sum("size").alias("__words")).join(rest, on).drop("__s")
        open1 = scratch.save(
            _first_open(level1, ["source"], "c1", F.col("__rest")).select(F.col("source").alias("__s"), "__rest", F.col("__at.c").alias("o1"), F.col("__at.b").alias("b1")), "open1"
        )
        inside = live.join(open1, on & (F.col("c1") == F.col("o1"))).drop("__s")
        level2 = inside.groupBy("source", "c2", "__rest", "b1").agg(F.sum("size").alias("__words"))
        open2 = scratch.save(
            _first_open(level2.withColumn("__rest", F.col("__rest") - F.col("b1")), ["source"], "c2", F.col("__rest")).select(
                F.col("source").alias("__s2"), F.col("__rest").alias("rest2"), F.col("__at.c").alias("o2"), F.col("__at.b").alias("b2")
            ),
            "open2",
        )
        # Only the ranks of one cell of the second level are ordered, equal rows as one: the last few documents of each source.
        edge = inside.join(open2, F.col("source").eqNullSafe(F.col("__s2")) & (F.col("c2") == F.col("o2"))).drop("__s2")
        item = ["rank", "doc_id", "u"]
        equal = edge.groupBy("source", *item, "size", "whole", "source_size", "target", "rest2", "b2").agg(F.count(F.lit(1)).alias("n"))
        order = Window.partitionBy("source").orderBy(*item).rowsBetween(Window.unboundedPreceding, -1)
        equal = equal.withColumn("before", F.coalesce(F.sum(F.col("n") * F.col("size")).over(order), F.lit(0)) + F.col("b2"))
        room = F.col("rest2") - F.col("before")
        nearest = F.ceil(F.try_divide(room, F.col("size")) - 0.5)
        take = F.when(F.col("n") * F.col("size") <= room, F.col("n")).when(room > 0, F.greatest(F.least(nearest, F.col("n")), F.lit(0))).otherwise(F.lit(0)).cast("long")
        equal = equal.withColumn("take", take)
        whole = F.max(F.when(F.col("take") == F.col("n"), F.struct(*item))).alias("last")
        part = F.max(F.when((F.col("take") > 0) & (F.col("take") < F.col("n")), F.struct(*item, "n", "take", "size", "whole", "source_size", "target"))).alias("part")
        cut = equal.groupBy(F.col("source").alias("__s3")).agg(whole, part)
        bounds = open1.join(open2.select("__s2", "o2"), F.col("__s").eqNullSafe(F.col("__s2")), "left").drop("__s2")
        return scratch.save(bounds.join(cut, F.col("__s").eqNullSafe(F.col("__s3")), "left").select("__s", "o1", "o2", "last", "part"), "bounds")

    def decide(self, ranked: DataFrame) -> DataFrame:
        """Ranked rows with their ``copies``; null for equal rows of which only a part is taken."""
        own = F.struct("rank", "doc_id", "u")
        chosen = (
            F.when(F.col("rank").isNull(), False)
            .when(F.col("o1").isNull() | (F.col("c1") < F.col("o1")), True)
            .when(F.col("c1") > F.col("o1"), False)
            .when(F.col("c2") != F.col("o2"), F.col("c2") < F.col("o2"))
            .otherwise(F.coalesce(own <= F.col("last"), F.lit(False)))
        )
        out = ranked.join(self.bounds, F.col("source").eqNullSafe(F.col("__s")), "left").drop("__s")
        partly = (F.col("rank") == F.col("part.rank")) & F.col("doc_id").eqNullSafe(F.col("part.doc_id")) & (F.col("u") == F.col("part.u"))
        return out.withColumn("copies", F.when(~F.coalesce(partly, F.lit(False)), F.col("whole") + chosen.cast("long")).cast("long"))


def _measure(step: Column) -> Column:
    return F.pow(F.lit(2.0), step / STEPS)


def mix(docs: DataFrame, **options) -> DataFrame:
    """Per document: doc_id, size, source_size, target, copies and taken words. Options as in ``Mix``."""
    plan = Mix(docs, **options)
    columns = ["doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken")]
    out = plan.decide(plan.ranked).where("copies IS NOT NULL").select(*columns)
    if not plan.split:
        return out
    parts = numbered(plan.bounds.where("part.u IS NOT NULL").select(F.col("__s").alias("source"), "part.*"), F.col("n"))
    parts = parts.withColumn("copies", F.col("whole") + (F.col("nth") < F.col("take")).cast("long"))
    return out.unionByName(parts.select(*columns))


def repeat_by_mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed documents themselves: a row for each copy taken, columns as in ``docs``. Texts meet only the small tables of sources."""
    plan = Mix(docs, **options)
    rows = plan.decide(plan._ranked(plan._sized(docs)))
    out = rows.where("copies > 0").select("row", F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int")))).select("row.*")
    if not plan.split:
        return out
    same = rows.where("copies IS NULL").dropDuplicates(["source", "doc_id", "u"])  # equal rows: one stands for all
    return out.unionByName(numbered(same, F.col("part.n") * F.col("whole") + F.col("part.take")).select("row.*"))
