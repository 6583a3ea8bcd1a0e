"""Greedy distance clustering.

Rows fall into voxels so small that any two members are within the radius; the
first row of each voxel is a seed. In row order a seed becomes a leader unless
an earlier leader is within the radius; every row then goes to its nearest
leader (ties: the earlier one).

Seeds are what a sphere can hold at the radius, whatever the number of rows:
at most about 40 / chord**2. The scan over them is sequential by definition and
runs in one task while there are ``MAX_SCAN`` or fewer; beyond, the same leaders
come from rounds of joins in which a seed is settled once all earlier
neighbours are. Rows meet leaders by an equi-join on voxels.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.frame import LATITUDE, LONGITUDE, POS
from ..functions.grid import EARTH_RADIUS_KM, chord, unit_xyz
from ..functions.scratch import stored

MAX_SCAN = 50_000
SEEDS = "_pos long, x double, y double, z double"


def _voxel(width: float, *names: str):
    return [F.floor(F.col(n) / width).alias(f"v{n}") for n in names]


def _spread(steps, name: str):
    return F.explode(F.transform(steps, lambda i: F.col(name) + i))


def greedy_leaders(pdf: pd.DataFrame, c: float) -> pd.DataFrame:
    """Leaders among seeds, by a hash of voxels as wide as the radius."""
    pdf = pdf.sort_values(POS, kind="stable")
    xyz = pdf[["x", "y", "z"]].to_numpy()
    cells = np.floor(xyz / c).astype(np.int64)
    taken: dict[tuple[int, int, int], list[int]] = {}
    around = [(a, b, d) for a in (-1, 0, 1) for b in (-1, 0, 1) for d in (-1, 0, 1)]
    keep, limit = [], c * c
    for i, (a, b, d) in enumerate(map(tuple, cells.tolist())):
        near = [j for u, v, w in around for j in taken.get((a + u, b + v, d + w), ())]
        if near and ((xyz[near] - xyz[i]) ** 2).sum(1).min() <= limit:
            continue
        taken.setdefault((a, b, d), []).append(i)
        keep.append(i)
    return pdf.iloc[keep]


def _leaders_by_rounds(seeds: DataFrame, c: float) -> DataFrame:
    """The same leaders as the scan: the first maximal independent set in row order."""
    cells = seeds.select(POS, "x", "y", "z", *_voxel(c, "x", "y", "z"))
    step = F.array(*(F.lit(i) for i in (-1, 0, 1)))
    spread = cells
    for v in ("vx", "vy", "vz"):
        spread = spread.withColumn(v, _spread(step, v))
    b = cells.select(F.col(POS).alias("q"), *(F.col(n).alias(f"{n}2") for n in ("x", "y", "z")), "vx", "vy", "vz")
    apart = sum(F.pow(F.col(n) - F.col(f"{n}2"), 2) for n in ("x", "y", "z"))
    earlier = spread.join(b, ["vx", "vy", "vz"]).where((F.col("q") < F.col(POS)) & (apart <= c * c)).select(POS, "q")
    earlier = stored(earlier, "earlier")
    state = stored(seeds.select(POS, F.lit(None).cast("boolean").alias("leads")), "leads")
    while state.where("leads IS NULL").limit(1).count():
        seen = earlier.join(state.select(F.col(POS).alias("q"), F.col("leads").alias("ql")), "q").groupBy(POS).agg(
            F.max(F.coalesce("ql", F.lit(False))).alias("blocked"), F.max(F.col("ql").isNull()).alias("waiting")
        )
        now = F.when(F.coalesce("blocked", F.lit(False)), False).when(F.coalesce("waiting", F.lit(False)), F.lit(None)).otherwise(True)
        state = stored(state.join(seen, POS, "left").select(POS, F.coalesce("leads", now).alias("leads")), "leads")
    return seeds.join(state.where("leads").select(POS), POS)


def with_cluster(df: DataFrame, distance_km: float) -> DataFrame:
    """Adds ``_leader``, the ``_pos`` of each row's leader. Rows must be located."""
    x, y, z = unit_xyz(F.col(LATITUDE), F.col(LONGITUDE))
    if distance_km >= math.pi * EARTH_RADIUS_KM:
        return df.withColumn("_leader", df.agg(F.min(POS)).scalar())
    c = chord(distance_km)
    rows = df.withColumns({"_x": x, "_y": y, "_z": z})
    points = rows.select(F.col(POS).cast("long").alias(POS), F.col("_x").alias("x"), F.col("_y").alias("y"), F.col("_z").alias("z"))
    first = points.groupBy(*_voxel(c / math.sqrt(3.0), "x", "y", "z")).agg(F.min_by(F.struct(POS, "x", "y", "z"), POS).alias("s"))
    seeds = first.select("s.*")
    few = 40.0 / (c * c) <= MAX_SCAN
    if not few:
        seeds = stored(seeds, "seeds")
        few = seeds.count() <= MAX_SCAN
    if few:
        leaders = seeds.withColumn("_all", F.lit(0)).groupBy("_all").applyInPandas(lambda pdf: greedy_leaders(pdf, c)[[POS, "x", "y", "z"]], SEEDS)
    else:
        leaders = _leaders_by_rounds(seeds, c)
    # A row lies within the radius of its seed, and that of a leader: two voxels either way hold the nearest leader.
    reach = F.array(*(F.lit(i) for i in (-2, -1, 0, 1, 2)))
    near = leaders.select(F.struct(POS, "x", "y", "z").alias("l"), *_voxel(c, "x", "y", "z"))
    for v in ("vx", "vy", "vz"):
        near = near.withColumn(v, _spread(reach, v))
    near = near.groupBy("vx", "vy", "vz").agg(F.collect_list("l").alias("_near"))
    at = rows.withColumns({f"v{n}": F.floor(F.col(f"_{n}") / c) for n in ("x", "y", "z")})
    met = at.join(near, ["vx", "vy", "vz"])
    ranked = F.transform("_near", lambda l: F.struct(-(F.col("_x") * l["x"] + F.col("_y") * l["y"] + F.col("_z") * l["z"]), l[POS].alias("p")))
    return met.withColumn("_leader", F.array_min(ranked)["p"]).drop("vx", "vy", "vz", "_near", "_x", "_y", "_z")
