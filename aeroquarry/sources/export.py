"""Export of a retrieved window in the exchange layout: numbered locations, epoch seconds, ordered groups."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.frame import POS, facts, leaves
from ..operators.thinning import with_ordinal
from .netcdf import write_window

GROUP_ORDER = ("MetaData", "ObsValue", "ObsError", "QualityMarker", "PreQC")
TIME_FILL = 2**63 - 1


def formatted(df: DataFrame) -> DataFrame:
    """Rows numbered from 0 in row order, times as whole seconds since 1970 (missing: the largest long)."""
    have, known = leaves(df), facts(df)
    groups: dict[str | None, list] = {}
    for v in have:
        groups.setdefault(v.group, []).append(v)
    ordered = [g for g in GROUP_ORDER if g in groups] + sorted(g for g in groups if g and g not in GROUP_ORDER)

    def value(v):
        col = F.col(v.path)
        if isinstance(v.field.dataType, (T.TimestampNTZType, T.TimestampType)):
            col = F.coalesce(F.floor(F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast(v.field.dataType), col) / 1_000_000), F.lit(TIME_FILL)).cast("long")
        return col.alias(v.name, metadata=v.field.metadata or {})

    # Numbered within blocks of positions, so no task orders all rows; a re-sorted table's few rows are ordered at once.
    plain = isinstance(df.schema[POS].dataType, T.LongType)
    df = with_ordinal(df, "_number") if plain else df.withColumn("_number", F.row_number().over(Window.orderBy(POS)) - 1)
    out = [F.col("_number").cast("int").alias("Location")] + [F.struct(*(value(v) for v in groups[g])).alias(g) for g in ordered]
    arrays = [v for v in have if isinstance(v.field.dataType, T.ArrayType)]
    if arrays:
        channels = known.get("channels")
        width = F.size(F.col(arrays[0].path))
        channel = F.array(*(F.lit(int(c)) for c in channels)) if channels else F.when(width > 0, F.sequence(F.lit(1), width)).otherwise(F.array().cast("array<int>"))
        out.append(channel.cast("array<int>").alias("Channel"))
    return df.select(*out)


def export_window(df: DataFrame, path: str, clobber: bool = False, form: str = "parquet") -> bool:
    """Write the window as zstd Parquet or as one NetCDF file; False when it is empty. An existing target raises unless ``clobber``."""
    if form not in ("parquet", "netcdf"):
        raise ValueError("form must be 'parquet' or 'netcdf'")
    jvm = df.sparkSession._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    if target.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).exists(target) and not clobber:
        raise FileExistsError(path)
    if not df.limit(1).count():
        return False
    rows = formatted(df)
    if form == "netcdf":
        write_window(rows.drop("Channel"), path, {"channels": facts(df)["channels"]} if facts(df).get("channels") else {})
    else:
        rows.orderBy("Location").write.mode("overwrite").option("compression", "zstd").parquet(path)
    return True
