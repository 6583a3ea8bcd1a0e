"""A second store: Zarr (version 2) arrays in groups, one store for each type or for each of its periods.

Rows are numbered along ``Location`` and dealt to tasks by chunk, so every chunk file
has one writer; the metadata, which hold the shapes, are written last and publish what
the chunks hold. An append fills the last chunk up and goes on behind it. Chunks are
compressed with zlib, so any reader of the format can open them.
"""

from __future__ import annotations

import datetime as dt
import json
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.frame import POS, TIME, Leaf, facts, leaves, nest, with_facts
from .lake import LAYOUTS, AppendSchemaError, Lake, check_append

CHUNK = 5000
#: Positions whose rows are numbered by one task.
BLOCK = 1_000_000
FORMATS = {"none": None, "year": "yyyy", "month": "yyyy_MM", "day": "yyyy_MM_dd"}
#: Kinds of numbers by Spark's type: the array's type and its fill value.
KINDS = {"double": ("<f8", "NaN"), "float": ("<f4", "NaN"), "bigint": ("<i8", 2**63 - 1), "int": ("<i4", 2**31 - 1), "smallint": ("<i2", 2**15 - 1), "tinyint": ("|i1", 127), "boolean": ("|b1", False), "timestamp_ntz": ("<i8", -(2**63))}


def _files(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def _kind(v: Leaf) -> tuple[str, object]:
    inner = v.field.dataType.elementType if isinstance(v.field.dataType, T.ArrayType) else v.field.dataType
    if (name := inner.simpleString()) not in KINDS:
        raise ValueError(f"{v.path}: {name} can't be stored as numbers")
    return KINDS[name]


def _missing(fill: object) -> object:
    return float("nan") if fill == "NaN" else fill


def _values(column: pa.ChunkedArray, dtype: str, fill: object, width: int | None) -> np.ndarray:
    """A column as numbers, nulls as the fill value; of arrays a row each, padded to the width."""
    if width is not None:
        out = np.full((len(column), width), _missing(fill), dtype)
        for i, row in enumerate(column.to_pylist()):
            got = [_missing(fill) if x is None else x for x in row or ()]
            out[i, : len(got)] = got
        return out
    if pa.types.is_timestamp(column.type):
        column = column.cast(pa.timestamp("us")).cast(pa.int64())
    return column.fill_null(pa.scalar(_missing(fill), column.type)).to_numpy().astype(dtype)


class ZarrStore:
    """The same calls as ``Lake``: ``put``, ``read``, ``path``, ``list_data_types``."""

    def __init__(self, spark: SparkSession, base: str, split_by: str = "none", chunk: int = CHUNK) -> None:
        if split_by not in LAYOUTS:
            raise ValueError(f"split_by must be one of {LAYOUTS}")
        self.spark, self.base, self.split_by, self.chunk = spark, base.rstrip("/"), split_by, chunk
        self.files, self._root = _files(self.base)

    key = staticmethod(Lake.key)

    def path(self, data_type: str, sub_type: str | None = None, moment: dt.datetime | None = None) -> str:
        name = self.key(data_type, sub_type)
        if self.split_by == "none":
            return f"{self.base}/{name}.zarr"
        if moment is None:
            raise ValueError("a time is needed where a type is split by period")
        return f"{self.base}/{name}/{moment.strftime({'year': '%Y', 'month': '%Y_%m', 'day': '%Y_%m_%d'}[self.split_by])}.zarr"

    def delete(self, path: str) -> None:
        self.files.delete_dir(_files(path)[1])

    def _folders(self, under: str) -> list[str]:
        from pyarrow import fs

        found = self.files.get_file_info(fs.FileSelector(under, allow_not_found=True))
        return sorted(f.base_name for f in found if f.type == fs.FileType.Directory)

    def list_data_types(self) -> list[str]:
        if self.split_by == "none":
            return [n.removesuffix(".zarr") for n in self._folders(self._root) if n.endswith(".zarr")]
        return [n for n in self._folders(self._root) if any(p.endswith(".zarr") for p in self._folders(f"{self._root}/{n}"))]

    def _stores(self, name: str) -> dict[str, str]:
        """Paths of a type's stores by period ("" where it is not split)."""
        if self.split_by == "none":
            return {"": f"{self._root}/{name}.zarr"} if f"{name}.zarr" in self._folders(self._root) else {}
        return {p.removesuffix(".zarr"): f"{self._root}/{name}/{p}" for p in self._folders(f"{self._root}/{name}") if p.endswith(".zarr")}

    def _attributes(self, store: str) -> dict | None:
        try:
            with self.files.open_input_file(f"{store}/.zattrs") as f:
                return json.loads(f.read())
        except FileNotFoundError:
            return None

    def put(self, df: DataFrame, data_type: str, sub_type: str | None = None, channels: list[int] | None = None, is_sorted: bool = False, once: tuple[str, int] | None = None) -> list[str]:
        """Create or append; the periods written. Rows keep the order of ``_pos``; rows without a time go to no period.

        ``once``: a writer's name and the rising number of its batch; periods that have it already are left alone.
        """
        name, variables = self.key(data_type, sub_type), leaves(df)
        body = df.drop(POS).schema
        old = {p: a for p, s in self._stores(name).items() if (a := self._attributes(s))}
        for have in old.values():
            check_append(T.StructType.fromJson(have["schema"]), body)
            if channels is not None and channels != have["channels"]:
                raise AppendSchemaError(f"channels differ: {have['channels']} and {channels}")
        size = next((a["chunk"] for a in old.values()), self.chunk)
        wide = {v.flat: v for v in variables if isinstance(v.field.dataType, T.ArrayType)}
        widths = dict(zip(wide, df.agg(*(F.max(F.size(F.col(v.path))) for v in wide.values())).first(), strict=True)) if wide else {}
        for have in old.values():
            widths = {k: have["widths"].get(k, w) for k, w in widths.items()}
        arrays = {v.flat: (v.group, v.name, *_kind(v), widths.get(v.flat)) for v in variables}
        form = FORMATS[self.split_by]
        period = F.date_format(F.col(TIME), form) if form else F.lit("")
        rows = df.select(POS, period.alias("_period"), *(F.col(v.path).alias(v.flat) for v in variables)).where("_period IS NOT NULL")
        if once and (there := [p for p, a in old.items() if a["writers"].get(once[0], -1) >= once[1]]):
            rows = rows.where(~F.col("_period").isin(there))
        # Numbered within blocks of positions, so no task orders all rows of a period.
        block = F.floor(F.col(POS) / BLOCK)
        counts = rows.groupBy(F.col("_period").alias("_p"), block.alias("_c")).agg(F.count(F.lit(1)).alias("_n"))
        ahead = Window.partitionBy("_p").orderBy("_c").rowsBetween(Window.unboundedPreceding, -1)
        starts = counts.select("_p", "_c", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_start"))
        inside = F.row_number().over(Window.partitionBy("_period", block).orderBy(POS)) - 1
        rows = rows.withColumn("_at", inside).join(starts, (F.col("_period") == F.col("_p")) & (block == F.col("_c"))).drop("_p", "_c")
        first = F.coalesce(F.element_at(F.create_map(*(F.lit(x) for p, a in old.items() for x in (p, a["rows"]))), F.col("_period")), F.lit(0)) if old else F.lit(0)
        rows = rows.withColumn("_row", (first + F.col("_start") + F.col("_at")).cast("long")).withColumn("_chunk", F.floor(F.col("_row") / size))
        target = self.path(data_type, sub_type) if not form else f"{self.base}/{name}"
        done = rows.groupBy("_period", "_chunk").applyInArrow(_writer(target, arrays, size), "period string, rows long").groupBy("period").agg(F.max("rows").alias("rows")).collect()  # periods
        for row in done:
            self._publish(f"{self._root}/{name}.zarr" if not form else f"{self._root}/{name}/{row['period']}.zarr", row["rows"], arrays, size, {
                "schema": json.loads(body.json()), "rows": row["rows"], "widths": widths, "chunk": size, "channels": next((a["channels"] for a in old.values()), channels),
                "sorted": bool(is_sorted and old.get(row["period"], {"sorted": True})["sorted"]),
                "writers": old.get(row["period"], {"writers": {}})["writers"] | ({once[0]: once[1]} if once else {}),
            })
        return sorted(r["period"] for r in done)

    def _publish(self, store: str, rows: int, arrays: dict, size: int, attributes: dict) -> None:
        """Metadata of the arrays, their groups and the whole; the whole's come last."""
        meta: dict[str, dict] = {".zgroup": {"zarr_format": 2}}
        for group, name, dtype, fill, width in arrays.values():
            at = f"{group}/{name}" if group else name
            if group:
                meta[f"{group}/.zgroup"] = {"zarr_format": 2}
            more = [] if width is None else [width]
            meta[f"{at}/.zarray"] = {"zarr_format": 2, "shape": [rows, *more], "chunks": [size, *more], "dtype": dtype, "compressor": {"id": "zlib", "level": 4}, "fill_value": fill, "order": "C", "filters": None}
            meta[f"{at}/.zattrs"] = {"_ARRAY_DIMENSIONS": ["Location", "Channel"][: 1 + len(more)]} | ({"units": "microseconds since 1970-01-01"} if fill == -(2**63) else {})
        meta[".zattrs"] = attributes
        for at, what in [*meta.items(), (".zmetadata", {"zarr_consolidated_format": 1, "metadata": meta})]:
            self.files.create_dir(f"{store}/{at}".rsplit("/", 1)[0], recursive=True)
            with self.files.open_output_stream(f"{store}/{at}") as f:
                f.write(json.dumps(what).encode())

    def read(self, data_type: str, start: dt.datetime | None = None, end: dt.datetime | None = None) -> DataFrame:
        """All rows of the periods that a window meets, in order of period and number; each chunk is read by one task."""
        stores = self._stores(data_type)
        if not stores:
            raise ValueError(f"no data of type '{data_type}'; known: {self.list_data_types()}")
        if self.split_by != "none" and start is not None and end is not None:
            form = {"year": "%Y", "month": "%Y_%m", "day": "%Y_%m_%d"}[self.split_by]
            known = next(a for s in stores.values() if (a := self._attributes(s)))
            stores = {p: s for p, s in stores.items() if start.strftime(form) <= p <= end.strftime(form)}
        had = {p: a for p, s in sorted(stores.items()) if (a := self._attributes(s))}
        known = next(iter(had.values()), None) or known
        body = T.StructType.fromJson(known["schema"])
        schema = T.StructType([T.StructField(POS, T.LongType()), *body.fields])
        variables = leaves(self.spark.createDataFrame([], schema))
        arrays = {v.flat: (v.group, v.name, *_kind(v), known["widths"].get(v.flat)) for v in variables}
        spans, at, base = [], 0, 0
        for p, a in had.items():
            spans.append((at, base, a["rows"], f"{self.base}/{data_type}.zarr" if not p else f"{self.base}/{data_type}/{p}.zarr"))
            at, base = at - (-a["rows"] // known["chunk"]), base + a["rows"]
        flat = T.StructType([T.StructField(POS, T.LongType()), *(T.StructField(v.flat, v.field.dataType) for v in variables)])
        chunks = self.spark.range(at, numPartitions=max(1, min(at, 4096)))
        facts_ = {"sorted": known["sorted"]} | ({"channels": known["channels"]} if known["channels"] else {})
        return with_facts(nest(chunks.mapInArrow(_reader(spans, arrays, flat, known["chunk"]), flat), variables, facts(with_facts(self.spark.createDataFrame([], schema)))), **facts_)


def _chunk_name(store: str, group: str | None, name: str, chunk: int, width: int | None) -> str:
    return f"{store}/{group + '/' if group else ''}{name}/{chunk}{'' if width is None else '.0'}"


def _load(files, path: str, dtype: str, width: int | None, size: int) -> np.ndarray:
    with files.open_input_file(path) as f:
        return np.frombuffer(zlib.decompress(f.read()), dtype).reshape((size,) if width is None else (size, width))


def _writer(target: str, arrays: dict, size: int):
    def write(table: pa.Table) -> pa.Table:
        files, root = _files(target)
        table = table.sort_by("_row")
        period, chunk = table["_period"][0].as_py(), table["_chunk"][0].as_py()
        store = f"{root}/{period}.zarr" if period else root
        lo, hi = table["_row"][0].as_py() - chunk * size, table["_row"][-1].as_py() - chunk * size + 1
        for flat, (group, name, dtype, fill, width) in arrays.items():
            path = _chunk_name(store, group, name, chunk, width)
            whole = _load(files, path, dtype, width, size).copy() if lo else np.full((size,) if width is None else (size, width), _missing(fill), dtype)
            whole[lo:hi] = _values(table[flat], dtype, fill, width)
            files.create_dir(path.rsplit("/", 1)[0], recursive=True)
            with files.open_output_stream(path) as f:
                f.write(zlib.compress(np.ascontiguousarray(whole).tobytes(), 4))
        return pa.table({"period": pa.array([period], pa.string()), "rows": pa.array([chunk * size + hi], pa.int64())})

    return write


def _reader(spans: list, arrays: dict, flat: T.StructType, size: int):
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = to_arrow_schema(flat)

    def read(batches):
        for batch in batches:
            for chunk in batch.column(0).to_pylist():
                at, base, rows, uri = next(s for s in reversed(spans) if s[0] <= chunk)
                files, store = _files(uri)
                n = min(size, rows - (chunk - at) * size)
                out = [pa.array(base + (chunk - at) * size + np.arange(n), pa.int64())]
                for field, (group, name, dtype, fill, width) in zip(list(schema)[1:], arrays.values(), strict=True):
                    got = _load(files, _chunk_name(store, group, name, chunk - at, width), dtype, width, size)[:n]
                    if width is not None:
                        out.append(pa.array(list(got), field.type))
                    elif pa.types.is_timestamp(field.type):
                        out.append(pa.array(got, mask=got == fill).cast(field.type))
                    else:
                        out.append(pa.array(got, field.type))
                yield pa.RecordBatch.from_arrays(out, schema=schema)

    return read
