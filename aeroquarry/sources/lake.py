"""Append-only observation lake on Parquet with numbered manifests.

A batch is written to a folder of its own and becomes visible when its
manifest is published; a manifest file is created only if it does not exist yet,
so two writers can't take the same number and readers always see a whole
snapshot. An interrupted write leaves an unlisted folder and nothing else.
Batches are partitioned by period and sorted by time, so a time window prunes
folders and row groups. Each batch's layout is part of the manifest: a reader
needs nothing but the path. All batches lie under one root as partitions, so a
plan does not grow with the number of appends.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.frame import POS, TIME, with_facts

DATE, BATCH = "_date", "_batch"
LAYOUTS = ("none", "year", "month", "day")


class AppendSchemaError(ValueError):
    """The variables of an append differ from those stored."""


def variables(schema: T.StructType) -> dict[str, dict[str, str]]:
    """Variable types by group; top-level columns belong to the root group."""
    found: dict[str, dict[str, str]] = {}
    for f in schema.fields:
        if f.name in (POS, DATE, BATCH):
            continue
        if isinstance(f.dataType, T.StructType):
            found[f.name] = {x.name: x.dataType.simpleString() for x in f.dataType.fields}
        else:
            found.setdefault("/", {})[f.name] = f.dataType.simpleString()
    return found


def check_append(stored: T.StructType, new: T.StructType) -> None:
    old, fresh = variables(stored), variables(new)
    said = []
    for group in sorted({*old, *fresh}):
        a, b = old.get(group, {}), fresh.get(group, {})
        if missing := sorted(set(a) - set(b)):
            said.append(f"{group}: missing {missing}")
        if extra := sorted(set(b) - set(a)):
            said.append(f"{group}: extra {extra}")
        if other := sorted(k for k in set(a) & set(b) if a[k] != b[k]):
            said.append(f"{group}: other types {[(k, a[k], b[k]) for k in other]}")
    if said:
        raise AppendSchemaError("; ".join(said))


class Lake:
    def __init__(self, spark: SparkSession, base: str, split_by: str = "day") -> None:
        if split_by not in LAYOUTS:
            raise ValueError(f"split_by must be one of {LAYOUTS}")
        self.spark, self.base, self.split_by = spark, base.rstrip("/"), split_by
        self._jvm = spark._jvm
        self._fs = self._path(self.base).getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, p: str):
        return self._jvm.org.apache.hadoop.fs.Path(p)

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)

    @staticmethod
    def key(data_type: str, sub_type: str | None = None) -> str:
        return f"{data_type}_{sub_type}" if sub_type else data_type

    def path(self, data_type: str, sub_type: str | None = None) -> str:
        return f"{self.base}/{self.key(data_type, sub_type)}"

    def list_data_types(self) -> list[str]:
        if not self._fs.exists(self._path(self.base)):
            return []
        found = [s.getPath().getName() for s in self._fs.listStatus(self._path(self.base)) if s.isDirectory()]
        return sorted(t for t in found if self._numbers(t))

    def _numbers(self, data_type: str) -> list[int]:
        folder = self._path(f"{self.base}/{data_type}/manifests")
        if not self._fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(folder)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def manifest(self, data_type: str) -> dict | None:
        """The latest snapshot: batches, schema, next position and table facts."""
        numbers = self._numbers(data_type)
        if not numbers:
            return None
        stream = self._fs.open(self._path(f"{self.base}/{data_type}/manifests/{numbers[-1]:012d}.json"))
        try:
            text = self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return json.loads(text)

    def _publish(self, data_type: str, number: int, manifest: dict) -> None:
        stream = self._fs.create(self._path(f"{self.base}/{data_type}/manifests/{number:012d}.json"), False)
        try:
            stream.write(bytearray(json.dumps(manifest).encode()))
        finally:
            stream.close()

    def put(self, df: DataFrame, data_type: str, sub_type: str | None = None, order: tuple[str, ...] | None = None, channels: list[int] | None = None, is_sorted: bool = False, attributes: dict | None = None, once: tuple[str, int] | None = None) -> int:
        """Create or append; returns the manifest's number. ``order``: columns that fix the row order (default: time).

        ``once``: a writer's name and a number that rises with its batches; a number that is published already is
        skipped, so a batch that is replayed after a crash appends nothing twice.
        """
        name = self.key(data_type, sub_type)
        old = self.manifest(name)
        if once and old and old["writers"].get(once[0], -1) >= once[1]:
            return old["number"]
        body = df.drop(POS)
        if old:
            check_append(T.StructType.fromJson(old["schema"]), body.schema)
            body = body.select(*[f["name"] for f in old["schema"]["fields"]])
            if channels is not None and channels != old["channels"]:
                raise AppendSchemaError(f"channels differ: {old['channels']} and {channels}")
        base = old["next_pos"] if old else 0
        keys = list(order) if order else ([POS] if POS in df.columns else [TIME])
        # After a global sort the id rises from partition to partition; it is drawn once, here, and stored.
        placed = df.orderBy(*keys).withColumn("__id", F.monotonically_increasing_id())
        has_time = "MetaData" in body.columns and "dateTime" in body.schema["MetaData"].dataType.names
        date = F.date_trunc(self.split_by, F.col(TIME)).cast("date") if has_time and self.split_by != "none" else F.lit(None).cast("date")
        seen = Observation()
        placed = placed.select((F.col("__id") + base).alias(POS), *body.columns, date.alias(DATE)).observe(seen, F.max(POS).alias("top"))
        batch = f"b{uuid.uuid4().hex}"
        placed.write.partitionBy(DATE).parquet(f"{self._root(name)}/{BATCH}={batch}")
        top = seen.get["top"]
        number = (old["number"] + 1) if old else 0
        writers = dict(old["writers"]) if old else {}
        self._publish(
            name, number,
            {
                "number": number, "batches": {**(old["batches"] if old else {}), batch: self.split_by}, "schema": json.loads(body.schema.json()), "next_pos": base if top is None else top + 1,
                "channels": old["channels"] if old else channels, "sorted": bool(is_sorted and (old is None or old["sorted"])), "attributes": {**(old["attributes"] if old else {}), **(attributes or {})},
                "writers": writers | ({once[0]: once[1]} if once else {}), "published": dt.datetime.now(dt.UTC).isoformat(),
            },
        )
        return number

    def _root(self, name: str) -> str:
        return f"{self.base}/{name}/batches"

    def read(self, data_type: str, start: dt.datetime | None = None, end: dt.datetime | None = None) -> DataFrame:
        """The latest snapshot of a type; a window only prunes period folders here, by the layout of each batch."""
        known = self.manifest(data_type)
        if known is None:
            raise ValueError(f"no data of type '{data_type}'; known: {self.list_data_types()}")
        body = T.StructType.fromJson(known["schema"])
        schema = T.StructType([T.StructField(POS, T.LongType()), *body.fields, T.StructField(BATCH, T.StringType()), T.StructField(DATE, T.DateType())])
        df = self.spark.read.schema(schema).parquet(self._root(data_type))
        wanted = F.lit(False)
        for layout in LAYOUTS:
            if batches := [b for b, own in known["batches"].items() if own == layout]:
                inside = F.lit(True)
                if layout != "none" and start is not None and end is not None:
                    inside = F.col(DATE).isNull() | F.col(DATE).between(F.lit(period(start, layout)), F.lit(period(end, layout)))
                wanted |= F.col(BATCH).isin(batches) & inside
        facts = {"sorted": known["sorted"]} | ({"channels": known["channels"]} if known["channels"] else {})
        return with_facts(df.where(wanted).drop(BATCH, DATE), **facts)


def period(moment: dt.datetime, layout: str) -> dt.date:
    """First day of the year, month or day that holds a moment."""
    return dt.date(moment.year, moment.month if layout != "year" else 1, moment.day if layout == "day" else 1)


def open_store(spark: SparkSession, base: str, kind: str = "parquet", split_by: str = "day"):
    """The store of a kind: ``parquet`` (the lake), ``zarr`` or ``netcdf``."""
    if kind == "parquet":
        return Lake(spark, base, split_by)
    if kind == "zarr":
        from .zarr import ZarrStore

        return ZarrStore(spark, base, split_by)
    if kind == "netcdf":
        from .netcdf import NetcdfStore

        return NetcdfStore(spark, base, split_by)
    raise ValueError(f"unknown kind of store '{kind}'")
