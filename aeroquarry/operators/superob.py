"""Superobbing: one averaged row for each cell or distance cluster.

Floats and times are averaged (mean or median), longitudes around the circle;
whole numbers, booleans and strings take the first member's value. All steps
are hash aggregates, whose map-side part absorbs crowded cells; the circular
reference of each cell joins back by cell. Clustered rows and the reduced cells
are stored once where they are read again, so a table is scanned twice at most.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.frame import LATITUDE, LONGITUDE, POS, Leaf, facts, finite, leaves, located, nest
from ..functions.grid import reduced_cell, resolution
from ..functions.scratch import stored
from ..plans.registry import AndFilter, register_filter
from .clustering import with_cluster
from .temporal import time_lit

METHODS = ("mean", "median", "first")
FLOATS = (T.FloatType, T.DoubleType)
TIMES = (T.TimestampNTZType, T.TimestampType)
EPOCH = dt.datetime(2020, 1, 1)


def _reduced(value: Column, method: str) -> Column:
    if method == "mean":
        return F.avg(F.when(finite(value), value.cast("double")))
    return F.median(F.when(~F.isnan(value), value.cast("double")))


def _time_reduced(col: Column, method: str, kind: T.DataType) -> Column:
    since = F.timestamp_diff("MICROSECOND", time_lit(EPOCH), col)
    exact = F.try_divide(F.sum(since.cast("decimal(18,0)")).cast("double"), F.count(since))  # offsets add up past what a double holds
    mid = F.bround(exact if method == "mean" else F.median(since)).cast("bigint")
    return F.timestamp_add("MICROSECOND", mid, time_lit(EPOCH)).cast(kind)


@register_filter("superobbing")
class Superobbing(AndFilter):
    def checked(self, arg):
        arg = dict(arg)
        kind, size = resolution(arg)
        method, least = arg.get("aggregation", "mean"), arg.get("min_obs", 1)
        if method not in METHODS:
            raise ValueError(f"aggregation must be one of {METHODS}")
        if isinstance(least, bool) or not isinstance(least, int) or least < 1:
            raise ValueError("min_obs must be a whole number from 1")
        return kind, size, method, least

    def apply(self, df: DataFrame) -> DataFrame:
        kind, size, method, least = self.arg
        known, variables = facts(df), leaves(df)
        rows = located(df)
        if kind == "grid":
            cell = reduced_cell(F.col(LATITUDE), F.col(LONGITUDE), *size)
            rows = rows.withColumns({"_k1": cell.lat_bin, "_k2": cell.lon_bin})
        else:
            rows = with_cluster(rows, size).withColumns({"_k1": F.col("_leader"), "_k2": F.lit(0)})
        flat = rows.select(POS, "_k1", "_k2", *(F.col(v.path).alias(v.flat) for v in variables))
        if kind != "grid":
            flat = stored(flat, "clustered")
        lons = [v for v in variables if v.name == "longitude" and isinstance(v.field.dataType, FLOATS)] if method != "first" else []
        if lons:
            flat = self._unwrapped(flat, lons)
        arrays = [v for v in variables if isinstance(v.field.dataType, T.ArrayType) and isinstance(v.field.dataType.elementType, FLOATS)] if method != "first" else []
        aggs = [F.count(F.lit(1)).alias("_n"), F.min(POS).alias("_first")]
        aggs += [self._agg(v, method, v in lons).alias(v.flat) for v in variables if v not in arrays]
        aggs += [F.min(f"`{v.flat}`").alias(f"_low_{v.flat}") for v in lons]
        out = flat.groupBy("_k1", "_k2").agg(*aggs).where(F.col("_n") >= least)
        time = next((v for v in variables if v.path == "MetaData.dateTime"), None) if known.get("sorted") else None
        if lons or time:
            out = stored(out, "superobs")  # a row for each cell
            flags = [F.min(f"`_low_{v.flat}`") for v in lons] + ([F.max(F.col(f"`{time.flat}`").isNull())] if time else [])
            said = list(out.agg(*flags).first())
            for v, low in zip(lons, said, strict=False):
                out = self._rewrapped(out, v, low is None or low >= 0)
        for v in arrays:
            out = out.join(self._by_channel(flat, v, method), ["_k1", "_k2"], "left")
        # Earliest member first; tables in time order are put back into it, unless a time is missing.
        first = F.col("_first")
        if time:
            at = F.col(f"`{time.flat}`")
            first = F.struct((F.lit(None).cast(time.field.dataType) if said[-1] else at).alias("time"), first.alias("first"))
        return nest(out.withColumn(POS, first), variables, known)

    @staticmethod
    def _agg(v: Leaf, method: str, is_lon: bool) -> Column:
        col, kind = F.col(f"`{v.flat}`"), v.field.dataType
        if method == "first":
            return F.min_by(F.struct(col.alias("v")), POS)["v"]
        if is_lon:
            return _reduced(F.col(f"`_u_{v.flat}`"), method)
        if isinstance(kind, FLOATS):
            return F.coalesce(_reduced(col, method), F.lit(float("nan"))).cast(kind)
        if isinstance(kind, TIMES):
            return _time_reduced(col, method, kind)
        if v.name == "dateTime" and isinstance(kind, (T.IntegerType, T.LongType)):
            return F.bround(F.avg(col) if method == "mean" else F.median(col)).cast(kind)
        return F.min_by(F.struct(col.alias("v")), POS)["v"]

    @staticmethod
    def _unwrapped(flat: DataFrame, lons: list[Leaf]) -> DataFrame:
        """Adds each longitude unrolled around its cell's mean direction."""
        sums = []
        for v in lons:
            rad = F.radians(F.col(f"`{v.flat}`").cast("double"))
            ok = finite(F.col(f"`{v.flat}`"))
            sums.append(F.degrees(F.atan2(F.sum(F.when(ok, F.sin(rad)).otherwise(0.0)), F.sum(F.when(ok, F.cos(rad)).otherwise(0.0)))).alias(f"_r_{v.flat}"))
        refs = flat.groupBy(F.col("_k1").alias("_r1"), F.col("_k2").alias("_r2")).agg(*sums)
        joined = flat.join(refs, (F.col("_k1") == F.col("_r1")) & (F.col("_k2") == F.col("_r2")))
        for v in lons:
            ref, lon = F.col(f"`_r_{v.flat}`"), F.col(f"`{v.flat}`").cast("double")
            joined = joined.withColumn(f"_u_{v.flat}", ref + F.pmod(lon - ref + 180.0, F.lit(360.0)) - 180.0)
        return joined

    @staticmethod
    def _rewrapped(out: DataFrame, v: Leaf, positive: bool) -> DataFrame:
        """Back to [0, 360) if no longitude of the kept rows is negative, else to [-180, 180)."""
        lon, kind = F.col(f"`{v.flat}`"), v.field.dataType
        if positive:
            turned = F.pmod(lon, F.lit(360.0)).cast(kind)
            turned = F.when(turned >= 360.0, F.lit(0.0).cast(kind)).otherwise(turned)  # rounding in the narrower type
        else:
            turned = (F.pmod(lon + 180.0, F.lit(360.0)) - 180.0).cast(kind)
            turned = F.when(turned >= 180.0, F.lit(-180.0).cast(kind)).otherwise(turned)
        return out.withColumn(v.flat, F.coalesce(turned, F.lit(float("nan")).cast(kind)))

    @staticmethod
    def _by_channel(flat: DataFrame, v: Leaf, method: str) -> DataFrame:
        """Per-channel reduction in long form: the plan does not grow with the number of channels."""
        inner = v.field.dataType.elementType
        long = flat.select("_k1", "_k2", F.posexplode(F.col(f"`{v.flat}`")).alias("_c", "_v"))
        each = long.groupBy("_k1", "_k2", "_c").agg(F.coalesce(_reduced(F.col("_v"), method), F.lit(float("nan"))).cast(inner).alias("_v"))
        gathered = F.sort_array(F.collect_list(F.struct("_c", "_v")))
        return each.groupBy("_k1", "_k2").agg(F.transform(gathered, lambda s: s["_v"]).alias(v.flat))
