"""A third store and export format: NetCDF files of the classic model with 64-bit sizes (CDF-5).

The classic model has no groups, so a variable of a group is named ``name@group``. A file is
what one task writes: one for each period of a type, or one for an exported window.
"""

from __future__ import annotations

import datetime as dt
import json
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.frame import POS, TIME, facts, leaves, nest, with_facts
from .lake import AppendSchemaError, Lake, check_append
from .zarr import FORMATS, _files, _kind, _missing, _values

MAGIC = b"CDF\x05"
DIMENSIONS, VARIABLES, ATTRIBUTES = 10, 11, 12
# Codes of the format's types, and the types' big-endian arrays.
CODES = {">i1": 1, "S1": 2, ">i2": 3, ">i4": 4, ">f4": 5, ">f8": 6, ">i8": 10}
TYPES = {code: kind for kind, code in CODES.items()}


def _code(array: np.ndarray) -> int:
    kind = "S1" if array.dtype.kind == "S" else ">i1" if array.dtype.itemsize == 1 else f">{array.dtype.kind}{array.dtype.itemsize}"
    return CODES[kind]


def _long(n: int) -> bytes:
    return n.to_bytes(8, "big", signed=True)


def _padded(data: bytes) -> bytes:
    return data + bytes(-len(data) % 4)


def _name(text: str) -> bytes:
    raw = text.encode()
    return _long(len(raw)) + _padded(raw)


def _listed(tag: int, items: list[bytes]) -> bytes:
    return (tag if items else 0).to_bytes(4, "big") + _long(len(items)) + b"".join(items)


def _attributes(values: dict) -> bytes:
    items = []
    for name, value in values.items():
        array = np.array(value.encode(), "S") if isinstance(value, str) else np.asarray(value)
        raw = array.tobytes() if array.dtype.kind == "S" else array.astype(TYPES[_code(array)]).tobytes()
        items.append(_name(name) + _code(array).to_bytes(4, "big") + _long(len(value.encode()) if isinstance(value, str) else array.size) + _padded(raw))
    return _listed(ATTRIBUTES, items)


def encode(dimensions: dict[str, int], variables: dict[str, tuple[tuple[str, ...], np.ndarray, dict]], attributes: dict) -> bytes:
    """A whole file: header, then each variable's values."""
    ids = list(dimensions)
    head = MAGIC + _long(0) + _listed(DIMENSIONS, [_name(n) + _long(size) for n, size in dimensions.items()]) + _attributes(attributes)
    data = [_padded(a.astype(TYPES[_code(a)]).tobytes()) for _, a, _ in variables.values()]

    def listed(at: int) -> bytes:
        items = []
        for (name, (dims, array, own)), raw in zip(variables.items(), data, strict=True):
            shape = _long(len(dims)) + b"".join(_long(ids.index(d)) for d in dims)
            items.append(_name(name) + shape + _attributes(own) + _code(array).to_bytes(4, "big") + _long(len(raw)) + _long(at))
            at += len(raw)
        return _listed(VARIABLES, items)

    return head + listed(len(head) + len(listed(0))) + b"".join(data)


class _Header:
    """Reads a file's header piece by piece."""

    def __init__(self, raw: bytes) -> None:
        if raw[:4] != MAGIC:
            raise ValueError("not a file of this format")
        self.raw, self.at = raw, 12

    def number(self, size: int = 8) -> int:
        self.at += size
        return int.from_bytes(self.raw[self.at - size : self.at], "big", signed=True)

    def name(self) -> str:
        n = self.number()
        self.at += n + -n % 4
        return self.raw[self.at - n - -n % 4 :][:n].decode()

    def count(self) -> int:
        self.number(4)
        return self.number()

    def attributes(self) -> dict:
        out = {}
        for _ in range(self.count()):
            name, code, n = self.name(), self.number(4), self.number()
            kind = np.dtype(TYPES[code])
            got = np.frombuffer(self.raw, kind, n, self.at)
            self.at += n * kind.itemsize + -n * kind.itemsize % 4
            out[name] = got.tobytes().decode() if code == 2 else got.astype(kind.newbyteorder("=")).tolist()
        return out


def decode(raw: bytes) -> tuple[dict[str, int], dict[str, tuple[tuple[str, ...], np.ndarray, dict]], dict]:
    """Dimensions, variables and attributes of a file."""
    head = _Header(raw)
    dimensions = {head.name(): head.number() for _ in range(head.count())}
    attributes, variables = head.attributes(), {}
    names = list(dimensions)
    for _ in range(head.count()):
        name, dims = head.name(), tuple(names[head.number()] for _ in range(head.number()))
        own, code = head.attributes(), head.number(4)
        _, at = head.number(), head.number()
        shape = [dimensions[d] for d in dims]
        kind = np.dtype(TYPES[code])
        variables[name] = (dims, np.frombuffer(raw, kind, math.prod(shape), at).reshape(shape).astype(kind.newbyteorder("=")), own)
    return dimensions, variables, attributes


def _columns(df: DataFrame) -> tuple[dict, list]:
    """What a task needs to know of each variable, and flat columns."""
    variables = leaves(df)
    wide = [v for v in variables if isinstance(v.field.dataType, T.ArrayType)]
    widths = dict(zip([v.flat for v in wide], df.agg(*(F.max(F.size(F.col(v.path))) for v in wide)).first(), strict=True)) if wide else {}
    return {v.flat: (f"{v.name}@{v.group}" if v.group else v.name, *_kind(v), widths.get(v.flat)) for v in variables}, [F.col(v.path).alias(v.flat) for v in variables]


def _encoded(table: pa.Table, arrays: dict, attributes: dict, before: dict | None = None) -> bytes:
    out, channels = {}, 0
    for flat, (name, dtype, fill, width) in arrays.items():
        values = _values(table[flat], dtype, fill, width)
        if values.dtype == bool:
            values = values.astype(np.int8)
        if before:
            values = np.concatenate([before[name][1], values])
        channels = max(channels, width or 0)
        own = {} if dtype == "|b1" else {"_FillValue": np.array([_missing(fill)], dtype)}
        out[name] = (("Location",) if width is None else ("Location", "Channel"), values, own)
    rows = next(iter(out.values()))[1].shape[0] if out else 0
    return encode({"Location": rows} | ({"Channel": channels} if channels else {}), out, attributes)


def _replace(files, path: str, data: bytes) -> None:
    files.create_dir(path.rsplit("/", 1)[0], recursive=True)
    with files.open_output_stream(f"{path}.part") as f:
        f.write(data)
    files.move(f"{path}.part", path)


def write_window(df: DataFrame, path: str, attributes: dict | None = None) -> int:
    """A formatted window (with ``Location`` numbers) as one file; returns its rows. The file is one task's work."""
    arrays, flat = _columns(df)
    rows = df.select(*flat).withColumn("_all", F.lit(0))

    def write(table: pa.Table) -> pa.Table:
        files, target = _files(path)
        _replace(files, target, _encoded(table.sort_by("Location"), arrays, attributes or {}))
        return pa.table({"rows": pa.array([table.num_rows], pa.int64())})

    return rows.groupBy("_all").applyInArrow(write, "rows long").agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]


class NetcdfStore:
    """The same calls as ``Lake``. A type is split by year, month or day; a period's file is written anew by an append."""

    def __init__(self, spark: SparkSession, base: str, split_by: str = "day") -> None:
        if split_by not in ("year", "month", "day"):
            raise ValueError("split_by must be 'year', 'month' or 'day'")
        self.spark, self.base, self.split_by = spark, base.rstrip("/"), split_by
        self.files, self._root = _files(self.base)

    key = staticmethod(Lake.key)

    def path(self, data_type: str, sub_type: str | None = None, moment: dt.datetime | None = None) -> str:
        if moment is None:
            raise ValueError("a time is needed where a type is split by period")
        return f"{self.base}/{self.key(data_type, sub_type)}/{moment.strftime({'year': '%Y', 'month': '%Y_%m', 'day': '%Y_%m_%d'}[self.split_by])}.nc"

    def delete(self, path: str) -> None:
        self.files.delete_dir(_files(path)[1])

    def _listed(self, under: str, folders: bool) -> list[str]:
        from pyarrow import fs

        found = self.files.get_file_info(fs.FileSelector(under, allow_not_found=True))
        return sorted(f.base_name for f in found if (f.type == fs.FileType.Directory) == folders)

    def _periods(self, name: str) -> list[str]:
        return [f.removesuffix(".nc") for f in self._listed(f"{self._root}/{name}", False) if f.endswith(".nc")]

    def list_data_types(self) -> list[str]:
        return [n for n in self._listed(self._root, True) if self._periods(n)]

    def _about(self, name: str, period: str) -> dict:
        with self.files.open_input_file(f"{self._root}/{name}/{period}.nc") as f:
            return json.loads(decode(f.read())[2]["about"])

    def put(self, df: DataFrame, data_type: str, sub_type: str | None = None, channels: list[int] | None = None, is_sorted: bool = False, once: tuple[str, int] | None = None) -> list[str]:
        """Create or append; the periods written. Rows go by ``_pos``; rows without a time go to no period; ``once`` as in ``Lake``."""
        name, body = self.key(data_type, sub_type), df.drop(POS).schema
        if periods := self._periods(name):
            have = self._about(name, periods[-1])
            check_append(T.StructType.fromJson(have["schema"]), body)
            if channels is not None and channels != have["channels"]:
                raise AppendSchemaError(f"channels differ: {have['channels']} and {channels}")
            channels = have["channels"]
        arrays, flat = _columns(df)
        rows = df.select(POS, F.date_format(F.col(TIME), FORMATS[self.split_by]).alias("_period"), *flat).where("_period IS NOT NULL")
        base, about = f"{self.base}/{name}", {"schema": json.loads(body.json()), "channels": channels}

        def write(table: pa.Table) -> pa.Table:
            files, root = _files(base)
            period, before, own = table["_period"][0].as_py(), None, about | {"sorted": is_sorted, "writers": {}}
            try:
                with files.open_input_file(f"{root}/{period}.nc") as f:
                    _, before, had = decode(f.read())
                had = json.loads(had["about"])
                own |= {"sorted": is_sorted and had["sorted"], "writers": had["writers"]}
            except FileNotFoundError:
                pass
            if not once or own["writers"].get(once[0], -1) < once[1]:
                own["writers"] |= {once[0]: once[1]} if once else {}
                _replace(files, f"{root}/{period}.nc", _encoded(table.sort_by(POS), arrays, {"about": json.dumps(own)}, before))
            return pa.table({"period": pa.array([period], pa.string())})

        return sorted(r[0] for r in rows.groupBy("_period").applyInArrow(write, "period string").collect())  # periods

    def read(self, data_type: str, start: dt.datetime | None = None, end: dt.datetime | None = None) -> DataFrame:
        """All rows of the periods that a window meets; a file is read by one task."""
        if not (periods := self._periods(data_type)):
            raise ValueError(f"no data of type '{data_type}'; known: {self.list_data_types()}")
        known = self._about(data_type, periods[0])
        if start is not None and end is not None:
            form = {"year": "%Y", "month": "%Y_%m", "day": "%Y_%m_%d"}[self.split_by]
            periods = [p for p in periods if start.strftime(form) <= p <= end.strftime(form)]
        schema = T.StructType([T.StructField(POS, T.LongType()), *T.StructType.fromJson(known["schema"]).fields])
        empty = self.spark.createDataFrame([], schema)
        variables = leaves(empty)
        flat = T.StructType([T.StructField(POS, T.LongType()), *(T.StructField(v.flat, v.field.dataType) for v in variables)])
        names = {v.flat: (f"{v.name}@{v.group}" if v.group else v.name, _kind(v)[1]) for v in variables}
        files = self.spark.range(len(periods), numPartitions=max(1, len(periods)))
        more = {"sorted": known["sorted"]} | ({"channels": known["channels"]} if known["channels"] else {})
        return with_facts(nest(files.mapInArrow(_reader(f"{self.base}/{data_type}", periods, names, flat), flat), variables, facts(empty)), **more)


def _reader(base: str, periods: list[str], names: dict, flat: T.StructType):
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = to_arrow_schema(flat)

    def read(batches):
        files, root = _files(base)
        for batch in batches:
            for i in batch.column(0).to_pylist():
                with files.open_input_file(f"{root}/{periods[i]}.nc") as f:
                    dims, variables, _ = decode(f.read())
                # Positions rise with the period's number; a file holds less than 2 ** 40 rows.
                out = [pa.array((i << 40) + np.arange(dims["Location"]), pa.int64())]
                for field, (name, fill) in zip(list(schema)[1:], names.values(), strict=True):
                    got = variables[name][1]
                    if pa.types.is_timestamp(field.type):
                        out.append(pa.array(got, mask=got == fill).cast(field.type))
                    elif got.ndim > 1:
                        out.append(pa.array(list(got), field.type))
                    else:
                        out.append(pa.array(got).cast(field.type))
                yield pa.RecordBatch.from_arrays(out, schema=schema)

    return read
