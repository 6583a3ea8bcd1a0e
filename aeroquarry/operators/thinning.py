"""Thinning: one row of each cell or distance cluster."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.frame import LATITUDE, LONGITUDE, POS, facts, located
from ..functions.grid import reduced_cell, resolution, unit_xyz
from ..functions.scratch import stored
from ..plans.registry import AndFilter, register_filter
from .clustering import with_cluster

STRATEGIES = ("center", "first", "random")
#: Row numbers are counted within blocks of positions, so no task orders all rows.
BLOCK = 1_000_000


def with_ordinal(df: DataFrame, name: str) -> DataFrame:
    """Adds the dense rank of ``_pos`` from 0: blocks of positions are counted first, then ranked one by one."""
    block = F.floor(F.col(POS) / BLOCK)
    counts = df.groupBy(block.alias("_b")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(F.col("_b").alias("_c"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = F.row_number().over(Window.partitionBy("_b").orderBy(POS)) - 1
    ranked = df.withColumn("_b", block).withColumn("_i", inside)
    return ranked.join(starts, F.col("_b") == F.col("_c")).withColumn(name, F.col("_start") + F.col("_i")).drop("_b", "_c", "_i", "_start")


def uniform_of(seed: int):
    """Draw number k of numpy's default generator for each ordinal k; the generator jumps, so batches are independent."""

    @F.pandas_udf("double")
    def draw(ordinal: pd.Series) -> pd.Series:
        k = ordinal.to_numpy(np.int64)
        if not len(k):
            return pd.Series([], dtype=float)
        low, high = int(k.min()), int(k.max())
        if high - low > 4 * len(k) + 1000:  # scattered: one jump each
            def single(i: int) -> float:
                bits = np.random.PCG64(seed)
                bits.advance(i)
                return np.random.Generator(bits).random()

            return pd.Series([single(int(i)) for i in k])
        bits = np.random.PCG64(seed)
        bits.advance(low)
        return pd.Series(np.random.Generator(bits).random(high - low + 1)[k - low])

    return draw


@register_filter("thinning")
class Thinning(AndFilter):
    """Keeps the row nearest the middle (center), the first, or a random one; output keeps row order.

    The choice is a row number of 1 in its cell, which Spark already cuts
    before the shuffle, so crowded cells cost no more than others.
    """

    def checked(self, arg):
        arg = dict(arg)
        kind, size = resolution(arg)
        strategy = arg.get("strategy", "center")
        if strategy not in STRATEGIES:
            raise ValueError(f"strategy must be one of {STRATEGIES}")
        seed = arg.get("seed", 42)
        if isinstance(seed, bool) or not isinstance(seed, int):
            raise ValueError("seed must be a whole number")
        return kind, size, strategy, seed

    def apply(self, df: DataFrame) -> DataFrame:
        kind, size, strategy, seed = self.arg
        known, columns = facts(df), df.columns
        rows = located(df)
        if kind == "grid":
            cell = reduced_cell(F.col(LATITUDE), F.col(LONGITUDE), *size)
            rows = rows.withColumns({"_k1": cell.lat_bin, "_k2": cell.lon_bin})
            key: list[Column | str] = [POS]
            if strategy == "center":
                off_lat = F.col(LATITUDE) - cell.lat_center
                off_lon = F.pmod(F.col(LONGITUDE).cast("double"), F.lit(360.0)) - cell.lon_center
                key = [off_lat * off_lat + off_lon * off_lon, POS]
            elif strategy == "random":
                rows = with_ordinal(rows, "_o").withColumn("_u", uniform_of(seed)(F.col("_o")))
                key = ["_u", POS]
            won = rows.withColumn("_rn", F.row_number().over(Window.partitionBy("_k1", "_k2").orderBy(*key))).where("_rn = 1")
        else:
            rows = with_cluster(rows, size)
            if strategy != "first":
                rows = stored(rows, "clustered")  # read twice
            if strategy == "center":
                x, y, z = unit_xyz(F.col(LATITUDE), F.col(LONGITUDE))
                rows = rows.withColumns({"_x": x, "_y": y, "_z": z})
                middle = rows.groupBy(F.col("_leader").alias("_l")).agg(*(F.avg(f"_{n}").alias(f"_m{n}") for n in ("x", "y", "z")))
                rows = rows.join(middle, F.col("_leader") == F.col("_l"))
                key = [sum((F.col(f"_{n}") - F.col(f"_m{n}")) ** 2 for n in ("x", "y", "z")), POS]
            elif strategy == "random":
                rows = self._drawn(rows, seed)
                key = [F.abs(F.col("_nth") - F.col("_pick")), POS]
            else:
                key = [POS]
            won = rows.withColumn("_rn", F.row_number().over(Window.partitionBy("_leader").orderBy(*key))).where("_rn = 1")
        kept = won.select(*columns)
        return kept.withColumn(POS, F.col(POS).alias(POS, metadata=known))

    @staticmethod
    def _drawn(rows: DataFrame, seed: int) -> DataFrame:
        """Each cluster's pick: bounded draws, one for each cluster in leader order. Clusters are bounded by the sphere, not by rows."""
        sizes = rows.groupBy("_leader").count().withColumn("_all", F.lit(0)).groupBy("_all").applyInPandas(
            lambda pdf: pdf.sort_values("_leader").assign(_pick=lambda p: np.random.default_rng(seed).integers(0, p["count"].to_numpy()))[["_leader", "_pick"]],
            "_leader long, _pick long",
        )
        nth = F.row_number().over(Window.partitionBy("_leader").orderBy(POS)) - 1
        return rows.withColumn("_nth", nth).join(sizes.withColumnRenamed("_leader", "_l"), F.col("_leader") == F.col("_l"))
