"""Registered queries about the library's own behaviour: what it accepts, rejects, names and stores, with their SQL."""

from __future__ import annotations

import argparse
import datetime as dt
import json
import os
import tempfile
import uuid
from collections.abc import Callable, Iterable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import cli, config
from .functions.frame import POS, with_facts
from .functions.grid import unit_xyz
from .functions.scratch import shared_folder
from .operators import temporal
from .plans import planner, registry
from .plans.client import decode_time, get
from .queries import OBS, START, END, observations
from .sources import decoders, dumps, export, netcdf, zarr
from .sources.lake import Lake, open_store


def _base(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/lake-{uuid.uuid4().hex}"


def _said(step: Callable[[], object]) -> str:
    """The kind of error that a step raises, or ``ok``."""
    try:
        step()
    except (Exception, SystemExit) as error:
        return type(error).__name__
    return "ok"


def _table(spark: SparkSession, rows: Iterable[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(list(rows), schema)


def _values(rows: Iterable[tuple], names: str) -> str:
    def one(v) -> str:
        if v is None:
            return "NULL"
        return str(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else "'" + str(v).replace("'", "''") + "'"

    return f"SELECT * FROM (VALUES {', '.join('(' + ', '.join(map(one, r)) + ')' for r in rows)}) t({names})"


# --- times, durations, arguments ------------------------------------------------

TIMES = {"naive": "2024-01-03T00:00:00", "aware": "2024-01-03T02:30:00+02:30", "zulu": "2024-01-03T00:00:00Z", "date": "2024-01-03"}


def _decoded_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events from each spelling of one start time on: all alike."""
    kinds = {**TIMES, "numpy": np.datetime64("2024-01-03"), "datetime": dt.datetime(2024, 1, 3, tzinfo=dt.UTC)}
    parts = [planner.apply(observations(spark, sf_dir), decode_time(v), END, []).agg(F.count(F.lit(1)).alias("n"), F.min("MetaData.dateTime").alias("first")).select(F.lit(k).alias("kind"), "n", "first") for k, v in kinds.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


DURATIONS = [("hours", 6, 21600), ("float", 1.5, 5400), ("text h", "2", 7200), ("text hm", "1:30", 5400), ("text hms", "0:00:45", 45)]
BAD_DURATIONS = [("bool", True), ("none", None), ("letters", "x"), ("four parts", "1:2:3:4"), ("list", [1])]
PERIODICS = [({"period": 6, "window": 1}, "ok"), ({"period": 0, "window": 1}, "FilterError"), ({"period": 1, "window": 0}, "FilterError"), ({"period": 1, "window": 2}, "FilterError"), ({"period": -6, "window": 1}, "FilterError"), ({"period": 6}, "FilterError")]
GRIDS = [
    ({"grid": 1}, "ok"), ({"grid": [1, 1.25]}, "ok"), ({"distance": 100}, "ok"), ({"distance": 1, "units": "deg"}, "ok"), ({}, "FilterError"), ({"grid": 1, "distance": 2}, "FilterError"),
    ({"grid": 0}, "FilterError"), ({"grid": -1}, "FilterError"), ({"grid": "1"}, "FilterError"), ({"grid": True}, "FilterError"), ({"grid": [1]}, "FilterError"), ({"grid": [1, 2, 3]}, "FilterError"),
    ({"grid": [1, 0]}, "FilterError"), ({"grid": float("nan")}, "FilterError"), ({"grid": float("inf")}, "FilterError"), ({"distance": 0}, "FilterError"), ({"distance": -5}, "FilterError"), ({"distance": 5, "units": "miles"}, "FilterError"), ({"distance": "far"}, "FilterError"),
]
FILTERS = [
    ("unknown name", {"no_such_filter": 1}, "ValueError"), ("two names", {"region": "conus", "channels": [1]}, "ValueError"), ("unknown region", {"region": "atlantis"}, "FilterError"),
    ("bad strategy", {"thinning": {"grid": 1, "strategy": "best"}}, "FilterError"), ("bad method", {"superobbing": {"grid": 1, "aggregation": "mode"}}, "FilterError"), ("bad min_obs", {"superobbing": {"grid": 1, "min_obs": 0}}, "FilterError"),
    ("good and", {"thinning": {"grid": 1}}, "ok"), ("good or", {"region": "conus"}, "ok"),
]


def _durations(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = [(k, float(temporal.seconds(v)), "ok") for k, v, _ in DURATIONS]
    return _table(spark, good + [(k, None, _said(lambda v=v: temporal.seconds(v))) for k, v in BAD_DURATIONS], "kind string, seconds double, said string")


def _arguments(name: str, cases: list) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: _table(spark, [(i, _said(lambda a=a: registry.make_filter(name, a))) for i, (a, _) in enumerate(cases)], "n int, said string")


def _filter_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = observations(spark, sf_dir)
    return _table(spark, [(k, _said(lambda f=f: planner.apply(df, START, END, [f]))) for k, f, _ in FILTERS], "kind string, said string")


def _kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registered filters: whether their conditions are joined by AND or by OR."""
    return _table(spark, [(n, "or" if issubclass(c, registry.OrFilter) else "and") for n, c in sorted(registry._known.items())], "name string, kind string")


# --- the lake ----------------------------------------------------------------------


def _by_path(layout: str, start, end) -> Callable[[SparkSession, str], DataFrame]:
    """A table of some layout, written in two appends and read by its path alone."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        base, obs = _base(spark), observations(spark, sf_dir)
        for rest in (0, 1):
            Lake(spark, base, layout).put(obs.where(F.col(POS) % 2 == rest), "events")
        df = get(spark, base, "events", start, end, [{"bounding_box": {"min_lat": -60, "max_lat": 60, "min_lon": -170, "max_lon": 170}}])
        return df.select("Location", F.col("MetaData.dateTime").alias("ts"), F.col("ObsValue.value").alias("value"))

    return run


def _store_get(kind: str, layout: str) -> Callable[[SparkSession, str], DataFrame]:
    """Events in two appends to a store of another kind, read through the same call as the lake's."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        store, obs = open_store(spark, _base(spark), kind, layout), observations(spark, sf_dir)
        for rest in (0, 1):
            store.put(obs.where(F.col(POS) % 2 == rest), "events")
        df = get(spark, store, "events", "2024-01-05", "2024-01-09", [{"bounding_box": {"min_lat": -60, "max_lat": 60, "min_lon": -170, "max_lon": 170}}])
        return df.select("Location", F.col("MetaData.dateTime").alias("ts"), F.col("ObsValue.value").alias("value"))

    return run


def _netcdf_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An exported file, read back variable by variable."""
    target = f"{_base(spark)}.nc"
    export.export_window(planner.apply(observations(spark, sf_dir), START, END, [{"region": "conus"}]), target, form="netcdf")
    files, path = zarr._files(target)
    with files.open_input_file(path) as f:
        _, variables, _ = netcdf.decode(f.read())
    names = {"n": "Location", "epoch_s": "dateTime@MetaData", "value": "value@ObsValue", "station": "stationID@ObsValue"}
    return spark.createDataFrame(pd.DataFrame({k: variables[v][1] for k, v in names.items()}), "n int, epoch_s long, value double, station long").withColumn("n", F.col("n").cast("long"))


def _zarr_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Types of a Zarr store, with and without periods, and where they lie."""
    obs, rows = observations(spark, sf_dir).where(F.col(POS) < 100), []
    for layout in ("none", "year"):
        store = open_store(spark, _base(spark), "zarr", layout)
        store.put(obs, "events")
        store.put(obs, "events", "sub")
        rows += [(layout, n, store.path(n, None, START).removeprefix(store.base), store.read(n).count()) for n in store.list_data_types()]
    return _table(spark, rows, "layout string, name string, path string, n long")


def _append_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What an append with other variables, groups, types or channels says, and that none of them leaves rows."""
    lake, obs = Lake(spark, _base(spark)), observations(spark, sf_dir).where(F.col(POS) < 50)
    lake.put(obs, "events", channels=[1, 2])
    cases = {
        "same": lambda: lake.put(obs, "events"), "less": lambda: lake.put(obs.withColumn("ObsValue", F.struct("ObsValue.value")), "events"),
        "more": lambda: lake.put(obs.withColumn("ObsValue", F.struct("ObsValue.*", F.lit(1).alias("more"))), "events"), "no group": lambda: lake.put(obs.drop("ObsValue"), "events"),
        "new group": lambda: lake.put(obs.withColumn("Other", F.struct(F.lit(1).alias("x"))), "events"),
        "other type": lambda: lake.put(obs.withColumn("ObsValue", F.struct(F.col("ObsValue.value").cast("float").alias("value"), "ObsValue.stationID")), "events"),
        "other channels": lambda: lake.put(obs, "events", channels=[1, 3]),
    }
    return _table(spark, [(k, _said(step), lake.read("events").count()) for k, step in cases.items()], "kind string, said string, rows_after long")


def _empty_is_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An abandoned write leaves no type behind; the next put creates it; a replay appends nothing."""
    lake, obs = Lake(spark, _base(spark)), observations(spark, sf_dir).where(F.col(POS) < 20)
    obs.withColumn("_date", F.lit(dt.date(2024, 1, 1))).write.partitionBy("_date").parquet(f"{lake.base}/events/batches/_batch=abandoned")
    rows = [("types before", len(lake.list_data_types())), ("first number", lake.put(obs, "events", once=("w", 0))), ("replayed", lake.put(obs, "events", once=("w", 0)))]
    rows += [("second number", lake.put(obs, "events", once=("w", 1))), ("rows", lake.read("events").count()), ("types after", len(lake.list_data_types()))]
    return _table(spark, rows, "what string, n long")


def _paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = Lake(spark, "file:///lake")
    return _table(spark, [(k, s, lake.path(k, s)) for k, s in (("atms", None), ("atms", "n20"), ("synop", ""))], "data_type string, sub_type string, path string")


def _integer_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fill value of whole numbers stays a number, and the column keeps its type."""
    ident = F.when(F.col("ObsValue.stationID") % 3 == 0, F.lit(2147483647)).otherwise(F.col("ObsValue.stationID")).cast("int")
    lake = Lake(spark, _base(spark), "none")
    lake.put(observations(spark, sf_dir).withColumn("ObsValue", F.struct(ident.alias("stationID"))), "events")
    df = get(spark, lake, "events", START, END)
    return df.select("Location", F.col("ObsValue.stationID").cast("long").alias("station"), F.lit(df.schema["ObsValue"].dataType["stationID"].dataType.simpleString()).alias("kind"))


# --- sources -------------------------------------------------------------------------


def _as_rows(spark: SparkSession, sf_dir: str, ident: str, columns: dict[str, str]) -> DataFrame:
    """Events as a file of decoded rows, ingested through its registered source and read back."""
    base = _base(spark)
    lake, raw = Lake(spark, base), f"{base}/raw.jsonl"
    spark.read.parquet(f"{sf_dir}/events.parquet").selectExpr("date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\") AS time", "(event_id % 1800) / 10.0 - 90 AS latitude", "(event_id % 3600) / 10.0 - 180 AS longitude", *[f"{e} AS {n}" for n, e in columns.items()]).write.json(raw)
    (name,) = decoders.ingest(lake, ident, [raw])
    return lake.read(name)


def _synop(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _as_rows(spark, sf_dir, "rows/synop", {"pressure": "1000 + user_id % 50", "windSpeed": "event_id % 40", "ignored": "1"})
    return df.select(F.col("MetaData.dateTime").alias("ts"), F.col("MetaData.latitude").cast("double").alias("lat"), F.col("ObsValue.pressure").cast("double").alias("p"), F.col("ObsValue.windSpeed").cast("double").alias("wind"), F.col("ObsValue.temperature").cast("double").alias("t"))


def _temp(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _as_rows(spark, sf_dir, "rows/temp", {"height": "event_id % 9000", "waterTemperature": "270 + event_id % 20"})
    return df.select(F.col("MetaData.dateTime").alias("ts"), F.col("MetaData.height").cast("double").alias("height"), F.col("ObsValue.waterTemperature").cast("double").alias("water"), F.col("ObsValue.cloudAmount").cast("double").alias("cloud"))


def _categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decoded rows with a category become types of their own."""
    lake = Lake(spark, _base(spark))
    kinds = spark.read.parquet(f"{sf_dir}/events.parquet").select(F.col("event_id").alias("_i"), F.col("event_type").alias("category"))
    obs = observations(spark, sf_dir).join(kinds, F.col(POS) == F.col("_i")).drop("_i", POS)
    names = decoders.store(lake, obs, "events")
    parts = [lake.read(n).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("ObsValue.value"), 4).alias("total")).select(F.lit(n).alias("name"), "n", "total") for n in names]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


CATALOGUE = """
0:
  category: surface land
  standard subtypes: {}
  local subtypes:
    1: {dataset: land, format: one, restricted: false}
    100: {dataset: land_restricted, format: two, restricted: true}
21:
  category: radiances
  local subtypes:
    3: {dataset: sounder, format: three, restricted: false}
"""


def _message_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    with tempfile.NamedTemporaryFile("w", suffix=".yaml") as f:
        f.write(CATALOGUE)
        f.flush()
        rows = decoders.message_types(f.name)
    return _table(spark, [(r["category"], r["name"], r["subtype"], r["dataset"], r["format"], int(r["restricted"])) for r in rows], "category int, name string, subtype int, dataset string, format string, restricted int")


def _directory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known sources, and what asking for one says."""
    return _table(spark, [(i, _said(lambda i=i: decoders.source(i))) for i in [*sorted([*decoders.EXPECTED, "rows/synop", "rows/temp"]), "none/such"]], "ident string, said string")


def _dump_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = (dt.date(2024, 2, 28), dt.date(2024, 3, 1))
    return _table(spark, [(k, p) for k in ("atms", "avhrr") for p in dumps.file_paths("/r", k, *days)], "dump string, path string")


# --- reduction -----------------------------------------------------------------------


def _unit_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    xyz = unit_xyz(F.col("MetaData.latitude"), F.col("MetaData.longitude"))
    return observations(spark, sf_dir).select("Location", *((F.round(c, 9) + 0.0).alias(n) for c, n in zip(xyz, "xyz", strict=True)))


def _superob_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole-number times are averaged; other whole numbers and strings are the first member's."""
    seconds = F.timestamp_diff("SECOND", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"), F.col("MetaData.dateTime"))
    obs = observations(spark, sf_dir).withColumn("MetaData", F.struct(seconds.alias("dateTime"), "MetaData.latitude", "MetaData.longitude"))
    obs = obs.withColumn("ObsValue", F.struct("ObsValue.stationID", F.concat(F.lit("s"), F.col("ObsValue.stationID").cast("string")).alias("name")))
    df = registry.make_filter("superobbing", {"grid": 15}).apply(with_facts(obs, sorted=False))
    return df.select("Location", F.col("MetaData.dateTime").alias("seconds"), F.col("ObsValue.stationID").alias("station"), F.col("ObsValue.name").alias("name"))


def _superob_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table in time order is put back into it: its numbers follow the averaged times."""
    df = export.formatted(planner.apply(observations(spark, sf_dir), START, END, [{"superobbing": {"grid": 15}}]))
    return df.select(F.col("Location").cast("long").alias("n"), F.col("MetaData.dateTime").alias("epoch_s"), F.round("ObsValue.value", 9).alias("value"))


def _export_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written, read back, refused a second time, written anew on demand; nothing for an empty window."""
    target = f"{_base(spark)}/out"
    window = planner.apply(observations(spark, sf_dir), START, END, [{"region": "conus"}])
    said = [("empty", str(export.export_window(window.where(F.lit(False)), target))), ("written", str(export.export_window(window, target)))]
    said += [("again", _said(lambda: export.export_window(window, target))), ("clobber", str(export.export_window(window, target, clobber=True))), ("rows", str(spark.read.parquet(target).count()))]
    return _table(spark, said, "what string, said string")


# --- command line and settings ---------------------------------------------------------

DATES = [("2026-08-01", "ok"), ("2024-02-29", "ok"), ("2026-8-01", "ArgumentTypeError"), ("2026-02-30", "ArgumentTypeError"), ("20260801", "ArgumentTypeError"), ("", "ArgumentTypeError")]
COMMANDS = [("ingest ncep_dump_reader atms 2026-08-01 2026-08-02", "ncep_dump_reader"), ("ingest wis2_listener", "wis2_listener"), ("admin --list-ingestors", "admin"), ("ingest", "SystemExit"), ("ingest ncep_dump_reader atms", "SystemExit"), ("", "SystemExit"), ("other", "SystemExit")]
SETTINGS = [
    ("least", {"root_dir": "/r", "data_lake": {"base_dir": "lake"}}, "ok"), ("unknown field", {"root_dir": "/r", "data_lake": {"base_dir": "lake"}, "more": 1}, "ConfigError"), ("missing field", {"root_dir": "/r"}, "ConfigError"),
    ("wrong type", {"root_dir": 1, "data_lake": {"base_dir": "lake"}}, "ConfigError"), ("wrong choice", {"root_dir": "/r", "data_lake": {"base_dir": "lake", "split_by": "week"}}, "ConfigError"),
    ("unknown inner field", {"root_dir": "/r", "data_lake": {"base_dir": "lake", "x": 1}}, "ConfigError"), ("optional number", {"root_dir": "/r", "data_lake": {"base_dir": "lake"}, "run_for_num_sec": 3}, "ok"),
    ("optional section", {"root_dir": "/r", "data_lake": {"base_dir": "lake"}, "bufr": {"catalogue": "/c.yaml"}}, "ok"), ("no section", {"root_dir": "/r", "data_lake": {"base_dir": "lake"}, "bufr": None}, "ok"),
    ("bad section", {"root_dir": "/r", "data_lake": {"base_dir": "lake"}, "bufr": {"x": 1}}, "ConfigError"), ("time", {"root_dir": "/r", "data_lake": {"base_dir": "lake"}, "not_before": "2024-01-01T00:00:00Z"}, "ok"),
    ("no time", {"root_dir": "/r", "data_lake": {"base_dir": "lake"}, "not_before": "soon"}, "ConfigError"), ("no mapping", {"root_dir": "/r", "data_lake": 5}, "ConfigError"), ("number as text", {"root_dir": "/r", "data_lake": {"base_dir": "lake"}, "run_for_num_sec": "3"}, "ConfigError"),
]


def _dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    def said(v: str) -> str:
        try:
            cli.utc_date(v)
        except argparse.ArgumentTypeError:
            return "ArgumentTypeError"
        return "ok"

    return _table(spark, [(v, said(v)) for v, _ in DATES], "value string, said string")


def _commands(spark: SparkSession, sf_dir: str) -> DataFrame:
    import contextlib
    import io

    def parsed(line: str) -> str:
        try:
            with contextlib.redirect_stderr(io.StringIO()):
                args = cli.parser().parse_args(line.split())
        except SystemExit:
            return "SystemExit"
        return getattr(args, "consumer", None) or args.command

    return _table(spark, [(line, parsed(line)) for line, _ in COMMANDS], "line string, said string")


def _settings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, [(k, _said(lambda v=v: config.load(config.Settings, v))) for k, v, _ in SETTINGS], "kind string, said string")


def _described(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Settings from a file as plain values, one row for each."""
    with tempfile.NamedTemporaryFile("w", suffix=".json") as f:
        json.dump(SETTINGS[0][1], f)
        f.flush()
        got = config.from_file(config.config_path(f.name))
    flat = {f"{k}.{n}": v for k, part in config.to_dict(got).items() if isinstance(part, dict) for n, v in part.items()} | {"lake_dir": got.lake_dir}
    return _table(spark, [(k, str(flat[k])) for k in ("data_lake.base_dir", "data_lake.split_by", "data_lake.type", "ncep_dump.root_path", "lake_dir")] + [("described", str(sum("base_dir: str" in line for line in config.describe().splitlines())))], "field string, value string")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "time_decode": _decoded_times, "periodic_durations": _durations, "periodic_arguments": _arguments("periodic", PERIODICS), "resolution_arguments": _arguments("thinning", GRIDS),
        "filter_errors": _filter_errors, "filter_registry": _kinds, "lake_by_path_none": _by_path("none", "2024-01-05", "2024-01-09"), "lake_by_path_year": _by_path("year", "2024-01-05", "2024-01-09T12:00:00Z"),
        "lake_by_path_month": _by_path("month", np.datetime64("2024-01-05"), "2024-01-09T14:00:00+02:00"), "lake_by_path_day": _by_path("day", dt.datetime(2024, 1, 5), "2024-01-09T12:00:00"),
        "zarr_get": _store_get("zarr", "month"), "netcdf_get": _store_get("netcdf", "day"), "netcdf_export": _netcdf_export, "zarr_types": _zarr_types, "append_errors": _append_errors, "empty_is_new": _empty_is_new, "lake_paths": _paths, "integer_fill": _integer_fill, "synop_rows": _synop, "temp_rows": _temp, "category_store": _categories,
        "message_types": _message_types, "source_directory": _directory, "dump_paths": _dump_paths, "unit_vectors": _unit_vectors, "superob_kinds": _superob_kinds, "superob_order": _superob_order,
        "export_window": _export_window, "cli_dates": _dates, "cli_commands": _commands, "config_errors": _settings, "config_values": _described,
    }


def oracle_sql() -> dict[str, str]:
    from .queries import _cells, _region, _superob

    kinds = [*TIMES, "numpy", "datetime"]
    after = f"ts >= TIMESTAMP '{START}' AND ts < TIMESTAMP '{END}'"
    half = "TIMESTAMP '2024-01-09 12:00:00'"
    by_path = lambda end: f"WITH {OBS} SELECT \"Location\", ts, value FROM obs WHERE ts >= TIMESTAMP '2024-01-05' AND ts < {end} AND latitude BETWEEN -60 AND 60 AND longitude BETWEEN -170 AND 170"
    days = "(VALUES ('20240228'), ('20240229'), ('20240301')) d(day), (VALUES ('00'), ('06'), ('12'), ('18')) h(hour)"
    superob = _superob("mean", 1, 15).replace("round(value, 7)", "round(value, 9)").replace("FROM events)", f"FROM events WHERE {after})")
    return {
        "time_decode": f"WITH {OBS} SELECT kind, count(*) AS n, min(ts) AS first FROM obs, (VALUES {', '.join(f"('{k}')" for k in kinds)}) k(kind) WHERE {after} GROUP BY kind",
        "periodic_durations": _values([(k, float(s), "ok") for k, _, s in DURATIONS] + [(k, None, "ValueError") for k, _ in BAD_DURATIONS], "kind, seconds, said").replace("SELECT *", "SELECT kind, seconds::DOUBLE AS seconds, said"),
        "periodic_arguments": _values([(i, s) for i, (_, s) in enumerate(PERIODICS)], "n, said"),
        "resolution_arguments": _values([(i, s) for i, (_, s) in enumerate(GRIDS)], "n, said"),
        "filter_errors": _values([(k, s) for k, _, s in FILTERS], "kind, said"),
        "filter_registry": _values([("bounding_box", "or"), ("channels", "and"), ("geojson", "or"), ("periodic", "and"), ("region", "or"), ("superobbing", "and"), ("thinning", "and"), ("time_window", "and"), ("variables", "and")], "name, kind"),
        "lake_by_path_none": by_path("TIMESTAMP '2024-01-09'"), "lake_by_path_year": by_path(half), "lake_by_path_month": by_path(half), "lake_by_path_day": by_path(half),
        "zarr_get": by_path("TIMESTAMP '2024-01-09'"), "netcdf_get": by_path("TIMESTAMP '2024-01-09'"),
        "netcdf_export": f"WITH {OBS} SELECT row_number() OVER (ORDER BY \"Location\") - 1 AS n, CAST(floor(date_diff('microsecond', TIMESTAMP '1970-01-01', ts) / 1000000) AS BIGINT) AS epoch_s, value, user_id AS station FROM obs WHERE {after} AND {_region('conus')}",
        "zarr_types": _values([(k, n, f"/{n}{p}.zarr", 100) for k, p in (("none", ""), ("year", "/2024")) for n in ("events", "events_sub")], "layout, name, path, n").replace("SELECT *", "SELECT layout, name, path, n::BIGINT AS n"),
        "append_errors": _values([("same", "ok", 100), *((k, "AppendSchemaError", 100) for k in ("less", "more", "no group", "new group", "other type", "other channels"))], "kind, said, rows_after").replace("SELECT *", "SELECT kind, said, rows_after::BIGINT AS rows_after"),
        "empty_is_new": _values([("types before", 0), ("first number", 0), ("replayed", 0), ("second number", 1), ("rows", 40), ("types after", 1)], "what, n").replace("SELECT *", "SELECT what, n::BIGINT AS n"),
        "lake_paths": _values([("atms", None, "file:///lake/atms"), ("atms", "n20", "file:///lake/atms_n20"), ("synop", "", "file:///lake/synop")], "data_type, sub_type, path"),
        "integer_fill": f"WITH {OBS} SELECT \"Location\", CASE WHEN user_id % 3 = 0 THEN 2147483647 ELSE user_id END::BIGINT AS station, 'int' AS kind FROM obs WHERE {after}",
        "synop_rows": "SELECT CAST(ts AS TIMESTAMP) AS ts, ((event_id % 1800) / 10.0 - 90)::FLOAT::DOUBLE AS lat, (1000 + user_id % 50)::DOUBLE AS p, (event_id % 40)::DOUBLE AS wind, NULL::DOUBLE AS t FROM events",
        "temp_rows": "SELECT CAST(ts AS TIMESTAMP) AS ts, (event_id % 9000)::DOUBLE AS height, (270 + event_id % 20)::DOUBLE AS water, NULL::DOUBLE AS cloud FROM events",
        "category_store": "SELECT 'events_' || event_type AS name, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY event_type",
        "message_types": _values([(0, "surface land", 1, "land", "one", 0), (0, "surface land", 100, "land_restricted", "two", 1), (21, "radiances", 3, "sounder", "three", 0)], "category, name, subtype, dataset, format, restricted"),
        "source_directory": _values([(i, "ok" if i.startswith("rows/") else "LookupError") for i in [*sorted([*decoders.EXPECTED, "rows/synop", "rows/temp"]), "none/such"]], "ident, said"),
        "dump_paths": f"SELECT 'atms' AS dump, '/r/gdas.' || day || '/' || hour || '/atmos/gdas.t' || hour || 'z.atms.tm00.bufr_d' AS path FROM {days} UNION ALL SELECT 'avhrr', '/r/gdas.' || day || '/' || hour || '/atmos/gdas.t' || hour || 'z.avcs' || half || '.tm00.bufr_d' FROM {days}, (VALUES ('am'), ('pm')) x(half)",
        "unit_vectors": f'WITH {OBS} SELECT "Location", round(cos(radians(latitude)) * cos(radians(longitude)), 9) + 0.0 AS x, round(cos(radians(latitude)) * sin(radians(longitude)), 9) + 0.0 AS y, round(sin(radians(latitude)), 9) + 0.0 AS z FROM obs',
        "superob_kinds": f"""WITH {_cells(15, 15)} SELECT min("Location") AS "Location", CAST(round_even(avg(date_diff('microsecond', TIMESTAMP '2024-01-01', ts) // 1000000), 0) AS BIGINT) AS seconds,
  arg_min(user_id, "Location") AS station, 's' || arg_min(user_id, "Location") AS name FROM cells GROUP BY lat_bin, lon_bin""",
        "superob_order": f"SELECT row_number() OVER (ORDER BY ts, \"Location\") - 1 AS n, CAST(floor(date_diff('microsecond', TIMESTAMP '1970-01-01', ts) / 1000000) AS BIGINT) AS epoch_s, value FROM ({superob})",
        "export_window": f"WITH {OBS} SELECT * FROM (VALUES ('empty', 'False'), ('written', 'True'), ('again', 'FileExistsError'), ('clobber', 'True')) t(what, said) UNION ALL SELECT 'rows', count(*)::VARCHAR FROM obs WHERE {after} AND {_region('conus')}",
        "cli_dates": _values(DATES, "value, said"), "cli_commands": _values(COMMANDS, "line, said"), "config_errors": _values([(k, s) for k, _, s in SETTINGS], "kind, said"),
        "config_values": _values([("data_lake.base_dir", "lake"), ("data_lake.split_by", "day"), ("data_lake.type", "parquet"), ("ncep_dump.root_path", ""), ("lake_dir", "/r/lake"), ("described", "1")], "field, value"),
    }
