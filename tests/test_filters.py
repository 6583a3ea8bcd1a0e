import datetime as dt
import math
import warnings

import numpy as np
import pytest
from pyspark.sql import functions as F

from aeroquarry.functions import regions
from aeroquarry.functions.frame import POS, facts
from aeroquarry.functions.polygons import contains
from aeroquarry.operators.clustering import greedy_leaders
from aeroquarry.operators.temporal import seconds
from aeroquarry.plans import planner
from aeroquarry.plans.client import decode_time
from aeroquarry.plans.registry import FilterError, make_filter

WIDE = (dt.datetime(1900, 1, 1), dt.datetime(2200, 1, 1))


def run(df, *filters, window=WIDE):
    return planner.apply(df, *window, list(filters)).orderBy(POS).collect()


def ids(rows):
    return [r["Location"] for r in rows]


SOUNDER = [(0, 0.48, 0.60, [200.0, 210.0], 7), (10, 0.50, 0.625, [210.0, 220.0], 2147483647), (20, 0.51, 0.64, [290.0, 260.0], 9), (30, 10.20, 20.30, [300.0, 310.0], 1)]


def sounder(frame):
    return frame(SOUNDER, obs="brightness array<float>, stationID int", facts={"channels": [1, 2]})


def test_window_is_half_open_and_drops_missing_times(frame):
    at = dt.datetime(2021, 7, 30)
    rows = [(at + dt.timedelta(hours=h) if h is not None else None, 0.0, 0.0, 1.0) for h in (9, 3, None, 5, 12)]
    got = run(frame(rows), window=(at + dt.timedelta(hours=3), at + dt.timedelta(hours=9)))
    assert ids(got) == [1, 3]


def test_times_decode():
    assert decode_time("2024-01-02T03:04:05") == dt.datetime(2024, 1, 2, 3, 4, 5)
    assert decode_time(np.datetime64("2024-01-02T03:04:05.123456789")) == dt.datetime(2024, 1, 2, 3, 4, 5, 123456)
    assert decode_time("2024-01-02T03:00:00+02:00") == dt.datetime(2024, 1, 2, 1)
    with pytest.raises(ValueError):
        decode_time(5)


@pytest.mark.parametrize(("value", "want"), [(2, 7200), (0.5, 1800), ("6", 21600), ("1:30", 5400), ("0:0:5", 5), (np.timedelta64(90, "s"), 90)])
def test_durations(value, want):
    assert seconds(value) == want


@pytest.mark.parametrize("arg", [{"period": 1, "window": 2}, {"period": 0, "window": 0}, {"period": "x", "window": 1}, {"period": 1}, {"period": True, "window": 1}])
def test_bad_periods(arg):
    with pytest.raises(FilterError):
        make_filter("periodic", arg)


@pytest.mark.parametrize("ordered", [True, False])
def test_periodic_against_windows(frame, rng, ordered):
    for period, window in ((600, 120), (300, 300), (977, 5)):
        times = rng.integers(0, 8000, 300)
        times = np.sort(times) if ordered else times
        got = run(frame([(int(t), 0.0, 0.0, 1.0) for t in times]), {"periodic": {"period": np.timedelta64(period, "s"), "window": np.timedelta64(window, "s")}})
        keep, start = np.zeros(len(times), bool), times[0]
        while start <= times[-1]:
            keep |= (times >= start) & (times <= start + window)
            start += period
        assert ids(got) == np.flatnonzero(keep).tolist()


def test_spatial_filters_are_joined_by_or_after_thinning(frame):
    rows = [(0, 5.0, 5.0, 1.0), (1, 5.1, 5.1, 2.0), (2, -40.0, 100.0, 3.0), (3, 70.0, -100.0, 4.0)]
    box = {"bounding_box": {"min_lat": 0, "max_lat": 10, "min_lon": 0, "max_lon": 10}}
    assert ids(run(frame(rows), box, {"region": "north_polar"})) == [0, 1, 3]
    assert ids(run(frame(rows), {"region": " Tropics "}, {"thinning": {"grid": 10, "strategy": "first"}})) == [0]


def test_rows_on_borders_are_inside(frame):
    rows = [(0, 0.0, -180.0, 1.0), (1, 40.0, -140.0, 1.0), (2, 40.0001, -150.0, 1.0), (3, 51.0, 180.0, 1.0)]
    assert ids(run(frame(rows), {"region": "central_pacific_basin"})) == [0, 1]
    assert ids(run(frame(rows), {"region": "alaska"})) == [3]


def test_border_width_wraps(frame):
    rows = [(0, 0.0, 159.0, 1.0), (1, 0.0, 157.0, 1.0), (2, 0.0, -149.0, 1.0), (3, 6.9, -170.0, 1.0), (4, 6.3, 158.3, 1.0), (5, 6.9, 158.1, 1.0)]
    assert ids(run(frame(rows), {"region": {"name": "nino4", "border_width": 2}})) == [0, 2, 3]


def test_polygons_against_numpy(spark, rng):
    lon, lat = rng.uniform(-130, -60, 4000).round(1), rng.uniform(20, 55, 4000).round(1)
    df = spark.createDataFrame(list(zip(lon.tolist(), lat.tolist(), strict=True)), "lon double, lat double")
    shape = regions.geometry("conus")
    got = np.array([r[0] for r in df.select(contains(F.col("lon"), F.col("lat"), shape)).collect()])
    ring = np.array(shape["coordinates"][0][0])
    odd = np.zeros(len(lon), bool)
    on = np.zeros(len(lon), bool)
    for (x1, y1), (x2, y2) in zip(ring, ring[1:], strict=False):
        if y1 != y2:
            odd ^= ((y1 > lat) != (y2 > lat)) & (lon < (lat - y1) * ((x2 - x1) / (y2 - y1)) + x1)
        on |= ((lon - x1) * (y2 - y1) == (lat - y1) * (x2 - x1)) & (lon >= min(x1, x2)) & (lon <= max(x1, x2)) & (lat >= min(y1, y2)) & (lat <= max(y1, y2))
    assert (got == (odd | on)).all() and 0 < got.sum() < len(got)


def test_holes_and_unknown_shapes(spark):
    shape = {"type": "Polygon", "coordinates": [[[0, 0], [10, 0], [10, 10], [0, 10], [0, 0]], [[4, 4], [6, 4], [6, 6], [4, 6], [4, 4]]]}
    df = spark.createDataFrame([(5.0, 5.0), (1.0, 1.0), (4.0, 5.0)], "lon double, lat double")
    assert [r[0] for r in df.select(contains(F.col("lon"), F.col("lat"), shape)).collect()] == [False, True, True]
    with pytest.raises(FilterError):
        make_filter("geojson", {"type": "Point", "coordinates": [0, 0]})


def test_region_names():
    assert len(regions.names()) == 21
    with pytest.raises(FilterError):
        make_filter("region", "atlantis")


def test_variables(frame):
    df = planner.apply(sounder(frame), *WIDE, [{"variables": ["/ObsValue/stationID"]}])
    assert df.columns == [POS, "Location", "MetaData", "ObsValue"] and df.schema["ObsValue"].dataType.names == ["stationID"]
    assert df.schema["MetaData"].dataType.names == ["dateTime", "latitude", "longitude"] and facts(df)["channels"] == [1, 2]
    with pytest.raises(ValueError):
        planner.apply(sounder(frame), *WIDE, [{"variables": ["ObsValue/nothing"]}])


def test_channels(frame):
    df = planner.apply(sounder(frame), *WIDE, [{"channels": [2, 77]}])
    assert facts(df)["channels"] == [2] and [r["ObsValue"]["brightness"] for r in df.orderBy(POS).collect()] == [[210.0], [220.0], [260.0], [310.0]]
    with warnings.catch_warnings(record=True) as said:
        warnings.simplefilter("always")
        assert len(run(frame([(0, 0.0, 0.0, 1.0)]), {"channels": [1]})) == 1
    assert any("no channels" in str(w.message) for w in said)
    for bad in ([], [0], [1, 1], "1", [True]):
        with pytest.raises(FilterError):
            make_filter("channels", bad)


def test_integers_keep_their_fill(frame):
    assert [r["ObsValue"]["stationID"] for r in run(sounder(frame))] == [7, 2147483647, 9, 1]


def test_plan_rejects_odd_filters(frame):
    for bad in ([{"nothing": 1}], [{"variables": ["a"], "channels": [1]}]):
        with pytest.raises(ValueError):
            planner.apply(sounder(frame), *WIDE, bad)


BAD = [{}, {"grid": 1, "distance": 1}, {"grid": 0}, {"grid": -1}, {"grid": float("nan")}, {"grid": float("inf")}, {"grid": True}, {"grid": "1"}, {"grid": [1]}, {"grid": [1, 2, 3]}, {"grid": [1, 0]}, {"grid": [1, True]}, {"distance": 0}, {"distance": -5}, {"distance": float("inf")}, {"distance": "5"}, {"distance": 5, "units": "mi"}]


@pytest.mark.parametrize("arg", BAD)
@pytest.mark.parametrize("name", ["thinning", "superobbing"])
def test_bad_resolutions(name, arg):
    with pytest.raises(FilterError):
        make_filter(name, arg)


def test_thinning_keeps_the_middle(frame):
    got = run(sounder(frame), {"thinning": {"grid": [1, 1.25]}})
    assert [(r["MetaData"]["latitude"], r["MetaData"]["longitude"]) for r in got] == [(0.50, 0.625), (10.20, 20.30)]
    assert len(run(sounder(frame), {"thinning": {"distance": 100}})) == 2
    assert len(run(sounder(frame), {"thinning": {"distance": 0.9, "units": "deg", "strategy": "random"}})) == 2


def test_rows_without_position_are_dropped(frame):
    rows = [(0, float("nan"), 1.0, 1.0), (1, 1.0, float("inf"), 1.0), (2, None, 1.0, 1.0), (3, 1.0, 1.0, 1.0)]
    assert ids(run(frame(rows), {"thinning": {"grid": 1}})) == [3]
    assert ids(run(frame(rows), {"superobbing": {"grid": 1}})) == [3]
    assert run(frame(rows[:3]), {"superobbing": {"distance": 10}}) == []


def test_random_thinning_follows_the_generator(frame, rng):
    rows = [(i, float(a), float(b), 1.0) for i, (a, b) in enumerate(zip(rng.uniform(-20, 20, 300), rng.uniform(-20, 20, 300), strict=True))]
    got = ids(run(frame(rows), {"thinning": {"grid": 10, "strategy": "random", "seed": 5}}))
    draw, best = np.random.default_rng(5).random(300), {}
    for i, (_, lat, lon, _) in enumerate(rows):
        row = math.floor((lat + 90) / 10)
        n = max(1, np.rint(360 * math.cos(math.radians((row + 0.5) * 10 - 90)) / 10))
        key = row, min(math.floor((lon % 360) / 360 * n), n - 1)
        if key not in best or draw[i] < draw[best[key]]:
            best[key] = i
    assert got == sorted(best.values())


def test_superob_values(frame):
    (r,) = run(sounder(frame), {"superobbing": {"grid": [1, 1.25], "min_obs": 2}})
    assert r["ObsValue"]["brightness"] == pytest.approx([700 / 3, 230.0], rel=1e-5) and r["ObsValue"]["stationID"] == 7
    assert r["MetaData"]["dateTime"] == dt.datetime(2021, 7, 31, 22, 44, 10)
    (r,) = run(sounder(frame), {"superobbing": {"grid": [1, 1.25], "min_obs": 2, "aggregation": "median"}})
    assert r["ObsValue"]["brightness"] == [210.0, 220.0]
    (r,) = run(sounder(frame), {"superobbing": {"grid": [1, 1.25], "min_obs": 2, "aggregation": "first"}})
    assert r["ObsValue"]["brightness"] == [200.0, 210.0]


def test_superob_wraps_longitudes(frame):
    rows = [(0, 0.2, 359.2, 1.0), (1, 0.3, 359.8, 3.0), (2, 80.2, 10.0, 1.0), (3, 80.3, 11.0, 3.0)]
    got = run(frame(rows), {"superobbing": {"grid": [1, 1], "min_obs": 2}})
    assert [r["MetaData"]["longitude"] for r in got][0] == pytest.approx(359.5) and [r["MetaData"]["latitude"] for r in got] == pytest.approx([0.25, 80.25])
    for kind in ("float", "double"):
        rows = [(0, 0.0, 179.9, 1.0), (1, 0.0, -179.9, 1.0), (2, 0.0, -0.1, 1.0), (3, 0.0, 0.1, 1.0), (4, 0.0, 45.0, 1.0), (5, 0.0, 45.2, 1.0)]
        got = run(frame(rows, lon_type=kind), {"superobbing": {"distance": 50}})
        assert [r["MetaData"]["longitude"] for r in got] == pytest.approx([-180.0, 0.0, 45.1], abs=1e-4)


def test_superob_puts_sorted_rows_back_in_time_order(frame):
    rows = [(0, 0.1, 0.1, 10.0), (5, 10.1, 10.3, 20.0), (6, 10.2, 10.4, 40.0), (100, 0.2, 0.2, 30.0)]
    got = run(frame(rows, facts={"sorted": True}), {"superobbing": {"grid": 1}})
    assert [r["ObsValue"]["value"] for r in got] == [30.0, 20.0]
    assert [r["ObsValue"]["value"] for r in run(frame(rows), {"superobbing": {"grid": 1}})] == [20.0, 30.0]


def test_superob_skips_missing_values(frame):
    rows = [(0, 0.1, 0.1, float("nan")), (None, 0.1, 0.1, 4.0), (4, 0.1, 0.1, 6.0), (5, 50.0, 50.0, float("nan"))]
    for method in ("mean", "median"):
        a, b = make_filter("superobbing", {"grid": 1, "aggregation": method}).apply(frame(rows)).orderBy(POS).collect()
        assert a["ObsValue"]["value"] == 5.0 and a["MetaData"]["dateTime"] == dt.datetime(2021, 7, 31, 22, 44, 2) and math.isnan(b["ObsValue"]["value"])


def test_distance_clusters_against_a_plain_scan(spark, frame, rng, monkeypatch):
    lat, lon = rng.uniform(-30, 30, 500), rng.uniform(-180, 180, 500)
    rows = [(i, float(a), float(b), 1.0) for i, (a, b) in enumerate(zip(lat, lon, strict=True))]
    phi, lam = np.radians(lat), np.radians(lon)
    xyz = np.column_stack([np.cos(phi) * np.cos(lam), np.cos(phi) * np.sin(lam), np.sin(phi)])
    c = 2 * math.sin(900 / (2 * 6371.0))
    seeds, seen = [], set()
    for i, v in enumerate(np.floor(xyz / (c / math.sqrt(3))).astype(int).tolist()):
        if tuple(v) not in seen:
            seen.add(tuple(v))
            seeds.append(i)
    leaders = []
    for i in seeds:
        if not leaders or ((xyz[leaders] - xyz[i]) ** 2).sum(1).min() > c * c:
            leaders.append(i)
    nearest = np.array(leaders)[(xyz @ xyz[leaders].T).argmax(1)]
    want = sorted({int(np.flatnonzero(nearest == x)[0]) for x in set(nearest.tolist())})
    one = {"thinning": {"distance": 900, "strategy": "first"}}
    assert ids(run(frame(rows), one)) == want
    from aeroquarry.operators import clustering

    monkeypatch.setattr(clustering, "MAX_SCAN", 0)
    assert ids(run(frame(rows), one)) == want
    import pandas as pd

    small = pd.DataFrame({POS: [2, 1], "x": [1.0, 1.0], "y": [0.0, 0.001], "z": [0.0, 0.0]})
    assert greedy_leaders(small, 0.01)[POS].tolist() == [1]


def test_window_and_box_reach_the_scan(spark):
    from aeroquarry import queries

    df = queries.observations(spark, "/root/testdata/sf0.001")
    plan = planner.apply(df, *WIDE, [])._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual" in plan and "props" not in plan
