"""Decoders of observation files, by id, and what they produce.

Decoding binary bulletins needs an outside library; a decoder is any function
from a session and file paths to a frame, registered under an id. Schemas of
the surface and upper-air bulletins are given here; a catalogue of further
message types can be read from a file.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .lake import Lake

Decoder = Callable[[SparkSession, Sequence[str]], DataFrame]


class Source:
    """A registered decoder with its data type and storage options."""

    def __init__(self, ident: str, decode: Decoder, data_type: str, is_sorted: bool = True) -> None:
        self.ident, self.decode, self.data_type, self.is_sorted = ident, decode, data_type, is_sorted


_sources: dict[str, Source] = {}


def register_decoder(ident: str, data_type: str, is_sorted: bool = True) -> Callable[[Decoder], Decoder]:
    def add(decode: Decoder) -> Decoder:
        _sources[ident] = Source(ident, decode, data_type, is_sorted)
        return decode

    return add


def directory() -> list[str]:
    return sorted({*_sources, *EXPECTED})


def source(ident: str) -> Source:
    """An unknown id, or a known one without a decoder, is an error: nothing is skipped in silence."""
    if ident not in _sources:
        raise LookupError(f"no decoder is installed for '{ident}'" if ident in EXPECTED else f"unknown id '{ident}'")
    return _sources[ident]


#: Ids with a known layout whose decoders come with outside libraries.
EXPECTED = {
    "ncep_dump/atms": "atms", "ncep_dump/mhs": "mhs", "ncep_dump/iasi": "iasi", "ncep_dump/cris": "cris", "ncep_dump/radiosonde": "radiosonde", "ncep_dump/amsua": "amsua",
    "wis2/surface-based-observations/synop": "synop", "wis2/surface-based-observations/temp": "temp",
}


def _grouped(meta: Sequence[str], obs: Sequence[str]) -> T.StructType:
    first = [T.StructField("dateTime", T.TimestampNTZType())]
    return T.StructType([
        T.StructField("MetaData", T.StructType(first + [T.StructField(n, T.FloatType()) for n in meta])),
        T.StructField("ObsValue", T.StructType([T.StructField(n, T.FloatType()) for n in obs])),
    ])


SYNOP = _grouped(("latitude", "longitude"), ("pressure", "temperature", "wetBulbTemperature", "dewPointTemperature", "relativeHumidity", "windSpeed", "windDirection"))
TEMP = _grouped(("latitude", "longitude", "height"), ("cloudAmount", "waterTemperature"))


def normalised(df: DataFrame) -> DataFrame:
    """The time under its one name, ``dateTime``."""
    names = df.schema["MetaData"].dataType.names if "MetaData" in df.columns else []
    if "dateTime" in names or "datetime" not in names:
        return df
    inner = [F.col(f"MetaData.{n}").alias("dateTime" if n == "datetime" else n) for n in names]
    return df.withColumn("MetaData", F.struct(*inner))


def store(lake: Lake, df: DataFrame, data_type: str, is_sorted: bool = True, channels: list[int] | None = None, once: tuple[str, int] | None = None) -> list[str]:
    """Put decoded rows; a ``category`` column splits them into types of their own. Empty parts are skipped.

    Decoding may be costly, so decoded rows with categories are written once and each part is read from there.
    """
    df = normalised(df)
    if "category" not in df.columns:
        if not df.limit(1).count():
            return []
        lake.put(df, data_type, None, is_sorted=is_sorted, channels=channels, once=once)
        return [lake.key(data_type)]
    staged = f"{lake.base}/_staged/{uuid.uuid4().hex}"
    df.write.parquet(staged)
    rows = lake.spark.read.schema(df.schema).parquet(staged)
    done = []
    for kind in sorted((r[0] for r in rows.select("category").distinct().collect()), key=str):  # satellites of a file: a handful
        lake.put(rows.where(F.col("category").eqNullSafe(kind)).drop("category"), data_type, kind, is_sorted=is_sorted, channels=channels, once=once)
        done.append(lake.key(data_type, kind))
    lake.delete(staged)
    return done


def ingest(lake: Lake, ident: str, paths: Sequence[str], once: tuple[str, int] | None = None) -> list[str]:
    """Decode files as one distributed job and store them."""
    found = source(ident)
    return store(lake, found.decode(lake.spark, paths), found.data_type, found.is_sorted, once=once)


def rows_decoder(schema: T.StructType, names: dict[str, str] | None = None) -> Decoder:
    """A decoder of rows that some other program has decoded (JSON lines, CSV or Parquet, by suffix), mapped onto a schema of groups.

    ``names`` gives the source's name of a variable where it differs. Variables that a file lacks are null; further
    ones are left out; times are read as ISO 8601.
    """
    names = names or {}

    def decode(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
        parts = []
        for kind in ("json", "csv", "parquet"):
            if own := [p for p in paths if p.rsplit(".", 1)[-1].lower() in (kind, {"json": "jsonl"}.get(kind))]:
                parts.append(spark.read.options(header=True).format(kind).load(own))
        if unknown := [p for p in paths if p.rsplit(".", 1)[-1].lower() not in ("json", "jsonl", "csv", "parquet")]:
            raise ValueError(f"not a file of decoded rows: {unknown}")
        mapped = [_mapped(part, schema, names) for part in parts]
        return reduce(DataFrame.unionByName, mapped)

    return decode


def _mapped(df: DataFrame, schema: T.StructType, names: dict[str, str]) -> DataFrame:
    def value(field: T.StructField):
        given = names.get(field.name, field.name)
        if field.name == "dateTime" and given not in df.columns:
            given = next((n for n in ("datetime", "time") if n in df.columns), given)
        return (F.col(given) if given in df.columns else F.lit(None)).cast(field.dataType).alias(field.name)

    groups = [F.struct(*(value(f) for f in group.dataType.fields)).alias(group.name) for group in schema.fields]
    return df.select(*groups, *(["category"] if "category" in df.columns else []))


register_decoder("rows/synop", "synop", is_sorted=False)(rows_decoder(SYNOP))
register_decoder("rows/temp", "temp", is_sorted=False)(rows_decoder(TEMP))


def message_types(path: str) -> list[dict]:
    """Rows (category, name, subtype, dataset, format, restricted) of a message catalogue kept in a YAML file.

    The file is keyed by category; each has a name and its ``local subtypes``, keyed by number. A plain list of rows
    is taken as it is.
    """
    import yaml

    with open(path) as f:
        loaded = yaml.safe_load(f)
    if isinstance(loaded, list):
        return [dict(r) for r in loaded]
    rows = []
    for category, entry in sorted((loaded or {}).items()):
        for subtype, row in sorted((entry.get("local subtypes") or {}).items()):
            rows.append({"category": int(category), "name": entry.get("category"), "subtype": int(subtype), "dataset": row.get("dataset"), "format": row.get("format"), "restricted": bool(row.get("restricted", False))})
    return rows
