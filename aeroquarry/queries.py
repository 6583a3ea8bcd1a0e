"""Registered queries over the driver's tables, with their SQL.

Events stand in for observations: coordinates are derived from the id, exactly
alike in both engines. Embeddings stand in for per-channel radiances.
"""

from __future__ import annotations

import datetime as dt
import math
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import regions
from .functions.frame import POS, located, with_facts
from .functions.grid import KM_PER_DEGREE, chord
from .functions.polygons import polygons
from .functions.scratch import shared_folder
from .operators.clustering import with_cluster
from .plans import planner
from .plans.client import get
from .sources import export
from .sources.lake import Lake
from .streaming.notify import parsed

START, END = dt.datetime(2024, 1, 3), dt.datetime(2024, 1, 24)
ALWAYS = (dt.datetime(2000, 1, 1), dt.datetime(2100, 1, 1))
CHANNELS = 64
TRIANGLE = {"type": "Polygon", "coordinates": [[[-30.0, -20.0], [60.0, -35.5], [12.25, 48.75], [-30.0, -20.0]]]}


def _coordinates(ident: str) -> dict:
    number = F.col(ident)
    return {
        "latitude": F.pmod(number * 7919, F.lit(18001)) / F.lit(100.0) - F.lit(90.0),
        "longitude": F.pmod(number * 104729, F.lit(36000)) / F.lit(100.0) - F.lit(180.0),
    }


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as observations, in id order."""
    at = _coordinates("event_id")
    df = spark.read.parquet(f"{sf_dir}/events.parquet").select(
        F.col("event_id").alias(POS), F.col("event_id").alias("Location"),
        F.struct(F.col("ts").cast("timestamp_ntz").alias("dateTime"), at["latitude"].alias("latitude"), at["longitude"].alias("longitude")).alias("MetaData"),
        F.struct("value", F.col("user_id").alias("stationID")).alias("ObsValue"),
    )
    return with_facts(df, sorted=True)


def radiances(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = _coordinates("vec_id")
    df = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(
        F.col("vec_id").alias(POS), F.col("vec_id").alias("Location"),
        F.struct(F.timestamp_add("SECOND", F.col("vec_id"), F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")).alias("dateTime"), at["latitude"].alias("latitude"), at["longitude"].alias("longitude")).alias("MetaData"),
        F.struct(F.col("embedding").alias("radiance")).alias("ObsValue"),
    )
    return with_facts(df, channels=list(range(1, CHANNELS + 1)))


def _rows(df: DataFrame, digits: int | None = None) -> DataFrame:
    num = lambda c: F.round(F.col(c), digits) if digits else F.col(c)
    return df.select(
        "Location", F.col("MetaData.dateTime").alias("ts"), num("MetaData.latitude").alias("latitude"), num("MetaData.longitude").alias("longitude"), num("ObsValue.value").alias("value")
    )


def _filtered(*filters: dict, digits: int | None = None, window=ALWAYS) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: _rows(planner.apply(observations(spark, sf_dir), *window, list(filters)), digits)


def _variables(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = planner.apply(observations(spark, sf_dir), START, END, [{"variables": ["ObsValue/stationID"]}])
    return df.select("Location", F.col("MetaData.dateTime").alias("ts"), F.col("MetaData.latitude").alias("latitude"), F.col("ObsValue.stationID").alias("station"))


def _channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = planner.apply(radiances(spark, sf_dir), *ALWAYS, [{"channels": [9, 3, 64]}])
    return df.select("Location", *(F.round(F.get("ObsValue.radiance", F.lit(i)).cast("double"), 5).alias(f"r{c}") for i, c in enumerate((3, 9, 64))))


def _distance_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_cluster(located(observations(spark, sf_dir)), 1500.0).select("Location", F.col("_leader").alias("leader"))


def _superob_channels(method: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = planner.apply(radiances(spark, sf_dir), *ALWAYS, [{"superobbing": {"grid": 20, "aggregation": method}}])
        return df.select("Location", *(F.round(F.get("ObsValue.radiance", F.lit(i)).cast("double"), 4).alias(f"r{i + 1}") for i in (0, 31, 63)))

    return run


def _base(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/lake-{uuid.uuid4().hex}"


def _filled(spark: SparkSession, sf_dir: str) -> Lake:
    """A lake with events in two appends and radiances under a sub type."""
    lake, obs = Lake(spark, _base(spark), "year"), observations(spark, sf_dir)
    lake.put(obs.where(F.col(POS) % 2 == 0), "events")
    lake.put(obs.where(F.col(POS) % 2 == 1), "events")
    lake.put(radiances(spark, sf_dir), "sounder", "n20", channels=list(range(1, CHANNELS + 1)))
    return lake


def _lake_get(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rows(get(spark, _filled(spark, sf_dir), "events", START, END, [{"region": "tropics"}, {"bounding_box": {"min_lat": 40, "max_lat": 60, "min_lon": -20, "max_lon": 30}}]))


def _list_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.createDataFrame([(t,) for t in _filled(spark, sf_dir).list_data_types()], "data_type string")


def _export(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = export.formatted(planner.apply(observations(spark, sf_dir), START, END, [{"region": "hawaii"}]))
    return df.select(F.col("Location").cast("long").alias("n"), F.col("MetaData.dateTime").alias("epoch_s"), F.col("ObsValue.value").alias("value"))


def _notify(spark: SparkSession, sf_dir: str) -> DataFrame:
    href = F.concat(F.lit("https://data.example/a/"), F.col("event_id").cast("string"), F.lit(".bufr?k=1"))
    old = F.concat(F.lit('{"url":"https://old.example/'), F.col("event_id").cast("string"), F.lit('","filename":"old.bufr"}'))
    new = F.concat(F.lit('{"links":[{"rel":"via","type":"text/html","href":"x"},{"rel":"canonical","type":"application/bufr","href":"'), href, F.lit('"}]}'))
    messages = spark.read.parquet(f"{sf_dir}/events.parquet").select(
        F.concat_ws("/", F.lit("origin/a/wis2"), "event_type", F.col("user_id").cast("string")).alias("topic"),
        F.when(F.col("event_id") % 3 == 0, old).when(F.col("event_id") % 7 == 0, F.lit("not json")).otherwise(new).alias("payload"),
    )
    return parsed(messages, "origin/a/wis2/#").select("ident", "file_url", "file_name")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    box = {"bounding_box": {"min_lat": -10, "max_lat": 35.5, "min_lon": -75, "max_lon": 20}}
    superob = lambda **more: _filtered({"superobbing": {"grid": 10, **more}}, digits=7)
    return {
        "time_window": _filtered(window=(START, END)),
        "periodic": _filtered({"periodic": {"period": "6:00", "window": "1:30"}}),
        "periodic_full": _filtered({"periodic": {"period": 5, "window": 5}}, window=(START, END)),
        "bounding_box": _filtered(box, window=(START, END)),
        "spatial_or": _filtered(box, {"region": "nino4"}, {"region": "south_polar"}),
        "region_rect": _filtered({"region": "nh_extratropics"}),
        "region_poly": _filtered({"region": "conus"}, {"region": "alaska"}),
        "region_border": _filtered({"region": {"name": "guam", "border_width": 4.0}}, {"region": {"name": "nino4", "border_width": 2}}),
        "geojson": _filtered({"geojson": TRIANGLE}),
        "variables": _variables,
        "channels": _channels,
        "thin_grid_center": _filtered({"thinning": {"grid": 10}}),
        "thin_grid_first": _filtered({"thinning": {"grid": [5, 12.5], "strategy": "first"}}),
        "thin_grid_random": _filtered({"thinning": {"grid": 10, "strategy": "random"}}),
        "thin_distance_center": _filtered({"thinning": {"distance": 1500}}),
        "thin_distance_first": _filtered({"thinning": {"distance": 10, "units": "deg", "strategy": "first"}}),
        "thin_distance_random": _filtered({"thinning": {"distance": 1500, "strategy": "random"}}),
        "superob_mean": superob(),
        "superob_median": superob(aggregation="median"),
        "superob_first": superob(aggregation="first"),
        "superob_min_obs": superob(min_obs=8),
        "distance_clusters": _distance_clusters,
        "superob_distance": _filtered({"superobbing": {"distance": 2000}}, digits=7),
        "superob_channels": _superob_channels("mean"),
        "superob_channels_median": _superob_channels("median"),
        "thin_then_region": _filtered({"region": "tropics"}, {"thinning": {"grid": 15}}),
        "superob_then_region": _filtered({"region": "northern_hemisphere"}, {"superobbing": {"grid": 12}}, digits=7),
        "lake_get": _lake_get,
        "list_types": _list_types,
        "export": _export,
        "notify_parse": _notify,
    }


# --- the same in SQL ---------------------------------------------------------

OBS = """obs AS (
  SELECT event_id AS "Location", CAST(ts AS TIMESTAMP) AS ts, value, user_id,
         ((event_id * 7919) % 18001) / 100.0::DOUBLE - 90.0::DOUBLE AS latitude,
         ((event_id * 104729) % 36000) / 100.0::DOUBLE - 180.0::DOUBLE AS longitude
  FROM events)"""
ROW = '"Location", ts, latitude, longitude, value'


def _where(condition: str, window: bool = False) -> str:
    time = f" AND ts >= TIMESTAMP '{START}' AND ts < TIMESTAMP '{END}'" if window else ""
    return f"WITH {OBS} SELECT {ROW} FROM obs WHERE ({condition}){time}"


def _box(x1, y1, x2, y2) -> str:
    return f"(longitude BETWEEN {float(x1)}::DOUBLE AND {float(x2)}::DOUBLE AND latitude BETWEEN {float(y1)}::DOUBLE AND {float(y2)}::DOUBLE)"


def _region(name: str) -> str:
    if name in regions.BOXES:
        return "(" + " OR ".join(_box(*b) for b in regions.BOXES[name]) + ")"
    return _shape(regions.geometry(name))


def _shape(geometry: dict) -> str:
    """Crossing count over a list of edges, or on an edge."""
    tests = []
    for rings in polygons(geometry):
        edges = [(*a, *b) for ring in rings for a, b in zip(ring, ring[1:], strict=False)]
        listed = ", ".join(f"({x1}::DOUBLE, {y1}::DOUBLE, {x2}::DOUBLE, {y2}::DOUBLE)" for x1, y1, x2, y2 in edges)
        on = "(longitude - x1) * (y2 - y1) - (latitude - y1) * (x2 - x1) = 0 AND longitude BETWEEN least(x1, x2) AND greatest(x1, x2) AND latitude BETWEEN least(y1, y2) AND greatest(y1, y2)"
        cross = "(y1 > latitude) <> (y2 > latitude) AND longitude < (latitude - y1) * ((x2 - x1) / (y2 - y1)) + x1"
        tests.append(f"(SELECT bool_or({on}) OR count(*) FILTER (WHERE {cross}) % 2 = 1 FROM (VALUES {listed}) e(x1, y1, x2, y2))")
    return "(" + " OR ".join(tests) + ")"


def _wide_box(x1, y1, x2, y2, w) -> str:
    """Within w degrees of a box, also across the antimeridian."""
    near = lambda s: f"pow(greatest({x1} - (longitude + {s}), 0, longitude + {s} - {x2}), 2) + pow(greatest({y1} - latitude, 0, latitude - {y2}), 2) <= {w * w}"
    return "(" + " OR ".join(near(f"{s}::DOUBLE") for s in (0, -360, 360)) + ")"


def _cells(dlat: float, dlon: float) -> str:
    """cells: obs with their reduced-grid cell and its centre."""
    return f"""{OBS}, r AS (
  SELECT *, CASE WHEN longitude < 0 THEN longitude + 360 ELSE longitude END AS m, floor((latitude + 90) / {dlat}::DOUBLE) AS lat_bin FROM obs
), c AS (
  SELECT *, greatest(least((lat_bin + 0.5::DOUBLE) * {dlat}::DOUBLE - 90, 90::DOUBLE), -90::DOUBLE) AS lat_c FROM r
), n AS (
  SELECT *, greatest(1::DOUBLE, round_even(360 * cos(radians(lat_c)) / {dlon}::DOUBLE, 0)) AS n FROM c
), cells AS (
  SELECT *, least(floor(m / 360 * n), n - 1) AS lon_bin, (least(floor(m / 360 * n), n - 1) + 0.5::DOUBLE) * (360 / n) AS lon_c FROM n
)"""


def _thin(dlat: float, dlon: float, key: str, condition: str = "true") -> str:
    return f"WITH {_cells(dlat, dlon)}, kept AS (SELECT * FROM cells QUALIFY row_number() OVER (PARTITION BY lat_bin, lon_bin ORDER BY {key}) = 1) SELECT {ROW} FROM kept WHERE {condition}"


CENTER = 'pow(latitude - lat_c, 2) + pow(m - lon_c, 2), "Location"'


def _superob(agg: str, least: int = 1, size: float = 10, condition: str = "true") -> str:
    reduce = {"mean": "avg({})", "median": "median({})"}[agg]
    since = {"mean": "sum({})::DOUBLE / count(*)", "median": "median({})"}[agg].format("date_diff('microsecond', TIMESTAMP '2020-01-01', ts)")
    return f"""WITH {_cells(size, size)}, ref AS (
  SELECT *, degrees(atan2(sum(sin(radians(longitude))) OVER w, sum(cos(radians(longitude))) OVER w)) AS ref FROM cells WINDOW w AS (PARTITION BY lat_bin, lon_bin)
), u AS (
  SELECT *, ref + ((longitude - ref + 180) - 360 * floor((longitude - ref + 180) / 360)) - 180 AS u FROM ref
), g AS (
  SELECT arg_min("Location", "Location") AS "Location",
         TIMESTAMP '2020-01-01' + to_microseconds(CAST(round_even({since}, 0) AS BIGINT)) AS ts,
         {reduce.format("latitude")} AS latitude, {reduce.format("u")} AS lon, {reduce.format("value")} AS value
  FROM u GROUP BY lat_bin, lon_bin HAVING count(*) >= {least}
), o AS (SELECT "Location", ts, latitude, (lon + 180) - 360 * floor((lon + 180) / 360) - 180 AS longitude, value FROM g)
SELECT "Location", ts, round(latitude, 7) AS latitude, round(longitude, 7) AS longitude, round(value, 7) AS value FROM o WHERE {condition}"""


def _superob_radiance(agg: str) -> str:
    cells = _cells(20, 20).replace(OBS, OBS.replace("event_id", "vec_id").replace("CAST(ts AS TIMESTAMP) AS ts, value, user_id", "embedding").replace("events", "embeddings"))
    each = ", ".join(f"round({agg}(embedding[{i}]::DOUBLE)::FLOAT::DOUBLE, 4) AS r{i}" for i in (1, 32, 64))
    return f'WITH {cells} SELECT min("Location") AS "Location", {each} FROM cells GROUP BY lat_bin, lon_bin'


def _clusters(distance_km: float) -> str:
    """cells: obs with the leader of their cluster, by a plain scan over the seeds in row order."""
    c = chord(distance_km)
    width = c / math.sqrt(3.0)
    voxel = ", ".join(f"floor({n} / {width!r}::DOUBLE)" for n in "xyz")
    apart = " + ".join(f"pow(l.{n} - s.{n}, 2)" for n in "xyz")
    dot = " + ".join(f"xyz.{n} * leaders.l.{n}" for n in "xyz")
    return f"""{OBS}, xyz AS (
  SELECT *, cos(radians(latitude)) * cos(radians(longitude)) AS x, cos(radians(latitude)) * sin(radians(longitude)) AS y, sin(radians(latitude)) AS z FROM obs
), seeds AS (
  SELECT *, row_number() OVER (ORDER BY "Location") AS i FROM (SELECT "Location", x, y, z FROM xyz QUALIFY row_number() OVER (PARTITION BY {voxel} ORDER BY "Location") = 1)
), scan(i, ls) AS (
  SELECT 0::BIGINT, []::STRUCT(p BIGINT, x DOUBLE, y DOUBLE, z DOUBLE)[]
  UNION ALL
  SELECT s.i, CASE WHEN len(list_filter(ls, lambda l: {apart} <= {c * c!r}::DOUBLE)) > 0 THEN ls ELSE list_append(ls, {{'p': s."Location", 'x': s.x, 'y': s.y, 'z': s.z}}) END
  FROM scan JOIN seeds s ON s.i = scan.i + 1
), leaders AS (SELECT unnest(ls) AS l FROM (SELECT ls FROM scan ORDER BY i DESC LIMIT 1)
), cells AS (
  SELECT xyz.*, leaders.l.p AS lat_bin, 0 AS lon_bin FROM xyz, leaders QUALIFY row_number() OVER (PARTITION BY "Location" ORDER BY -({dot}), leaders.l.p) = 1
)"""


def _thin_clusters(distance_km: float, center: bool) -> str:
    off = " + ".join(f"pow({n} - avg({n}) OVER (PARTITION BY lat_bin), 2)" for n in "xyz") if center else "0"
    return f"WITH RECURSIVE {_clusters(distance_km)}, off AS (SELECT *, {off} AS off FROM cells) SELECT {ROW} FROM off QUALIFY row_number() OVER (PARTITION BY lat_bin ORDER BY off, \"Location\") = 1"


def _periodic(period: str, window: str, inside: str) -> str:
    return f"""WITH {OBS}, o AS (SELECT * FROM obs WHERE {inside}), s AS (
  SELECT unnest(generate_series((SELECT arg_min(ts, "Location") FROM o), (SELECT arg_max(ts, "Location") FROM o), INTERVAL {period})) AS s)
SELECT {ROW} FROM o WHERE EXISTS (SELECT 1 FROM s WHERE o.ts BETWEEN s.s AND s.s + INTERVAL {window})"""


def oracle_sql() -> dict[str, str]:
    box = _box(-75, -10, 20, 35.5)
    in_time = f"ts >= TIMESTAMP '{START}' AND ts < TIMESTAMP '{END}'"
    return {
        "time_window": _where("true", True),
        "periodic": _periodic("'6 hours'", "'90 minutes'", "true"),
        "periodic_full": _periodic("'5 hours'", "'5 hours'", in_time),
        "bounding_box": _where(box, True),
        "spatial_or": _where(f"{box} OR {_region('nino4')} OR {_region('south_polar')}"),
        "region_rect": _where(_region("nh_extratropics")),
        "region_poly": _where(f"{_region('conus')} OR {_region('alaska')}"),
        "region_border": _where(" OR ".join([_wide_box(144.5, 13.2, 146.0, 15.4, 4.0), _wide_box(160, -5, 180, 5, 2), _wide_box(-180, -5, -150, 5, 2)])),
        "geojson": _where(_shape(TRIANGLE)),
        "variables": f'WITH {OBS} SELECT "Location", ts, latitude, user_id AS station FROM obs WHERE {in_time}',
        "channels": 'SELECT vec_id AS "Location", ' + ", ".join(f"round(embedding[{c}]::DOUBLE, 5) AS r{c}" for c in (3, 9, 64)) + " FROM embeddings",
        "thin_grid_center": _thin(10, 10, CENTER),
        "thin_grid_first": _thin(5, 12.5, '"Location"'),
        "thin_distance_center": _thin_clusters(1500, True),
        "thin_distance_first": _thin_clusters(10 * KM_PER_DEGREE, False),
        "distance_clusters": f'WITH RECURSIVE {_clusters(1500)} SELECT "Location", lat_bin AS leader FROM cells',
        "superob_distance": "WITH RECURSIVE " + _superob("mean").removeprefix("WITH ").replace(_cells(10, 10), _clusters(2000)),
        "superob_mean": _superob("mean"),
        "superob_median": _superob("median"),
        "superob_first": f"WITH {_cells(10, 10)} SELECT \"Location\", ts, round(latitude, 7) AS latitude, round(longitude, 7) AS longitude, round(value, 7) AS value FROM cells QUALIFY row_number() OVER (PARTITION BY lat_bin, lon_bin ORDER BY \"Location\") = 1",
        "superob_min_obs": _superob("mean", 8),
        "superob_channels": _superob_radiance("avg"),
        "superob_channels_median": _superob_radiance("median"),
        "thin_then_region": _thin(15, 15, CENTER, _region("tropics")),
        "superob_then_region": _superob("mean", 1, 12, _region("northern_hemisphere")),
        "lake_get": _where(f"{_region('tropics')} OR {_box(-20, 40, 30, 60)}", True),
        "list_types": "SELECT * FROM (VALUES ('events'), ('sounder_n20')) t(data_type)",
        "export": f'WITH {OBS} SELECT row_number() OVER (ORDER BY "Location") - 1 AS n, CAST(floor(date_diff(\'microsecond\', TIMESTAMP \'1970-01-01\', ts) / 1000000) AS BIGINT) AS epoch_s, value FROM obs WHERE {in_time} AND {_region("hawaii")}',
        "notify_parse": """SELECT event_type || '/' || user_id AS ident,
  CASE WHEN event_id % 3 = 0 THEN 'https://old.example/' || event_id ELSE 'https://data.example/a/' || event_id || '.bufr?k=1' END AS file_url,
  CASE WHEN event_id % 3 = 0 THEN 'old.bufr' ELSE event_id || '.bufr' END AS file_name
FROM events WHERE event_id % 3 = 0 OR event_id % 7 <> 0""",
    }
