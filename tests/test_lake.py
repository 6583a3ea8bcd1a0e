import datetime as dt
import json
import os
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aeroquarry import cli, config
from aeroquarry.functions.frame import POS, facts
from aeroquarry.plans.client import get
from aeroquarry.sources import decoders, dumps, export, netcdf, zarr
from aeroquarry.sources.lake import AppendSchemaError, Lake, check_append, open_store
from aeroquarry.streaming import notify

START, END = dt.datetime(2021, 7, 31), dt.datetime(2021, 8, 2)


def rows(frame, n=4, first=0, **more):
    return frame([(first + i * 36_000, float(i), float(10 * i), float(i)) for i in range(n)], **more)


def pruned_by(spark, df):
    """Partition filters of a plan's only scan."""
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    plan = df.select("*")._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert plan.count("PartitionFilters: [") == 1
    return plan.split("PartitionFilters: [")[1].split("PushedFilters")[0]


def test_create_append_and_get(spark, frame, tmp_path):
    lake = Lake(spark, f"file://{tmp_path}/lake")
    assert lake.list_data_types() == [] and lake.manifest("a") is None
    assert lake.put(rows(frame), "a", is_sorted=True) == 0 and lake.put(rows(frame, 2, 1), "a", is_sorted=True) == 1
    lake.put(rows(frame), "b", "sub", channels=[3, 4])
    assert lake.list_data_types() == ["a", "b_sub"]
    df = lake.read("a")
    assert df.count() == 6 and facts(df) == {"sorted": True} and facts(lake.read("b_sub"))["channels"] == [3, 4]
    assert [r["Location"] for r in df.orderBy(POS).collect()] == [0, 1, 2, 3, 0, 1]
    got = get(spark, lake, "a", "2021-08-01T00:00:00", END, [{"bounding_box": {"min_lat": 1, "max_lat": 2, "min_lon": 0, "max_lon": 90}}])
    assert sorted(r["ObsValue"]["value"] for r in got.collect()) == [1.0, 1.0, 2.0]
    assert "_date#" in pruned_by(spark, got) and "_batch#" in pruned_by(spark, got)
    with pytest.raises(ValueError):
        lake.read("c")


def test_layouts_are_read_by_path(spark, frame, tmp_path):
    for layout in ("none", "year", "month", "day"):
        base = f"file://{tmp_path}/{layout}"
        Lake(spark, base, layout).put(rows(frame), "a")
        Lake(spark, base, "month").put(rows(frame, 2, 1), "a")  # a table may change its layout
        assert get(spark, base, "a", "2021-08-01T00:00:00", END).count() == 3, layout
        assert get(spark, base, "a", "2021-01-01T00:00:00", "2021-08-01T00:00:00").count() == 2, layout
        assert "_date#" in pruned_by(spark, get(spark, base, "a", START, END))


def test_zarr_store(spark, frame, tmp_path):
    for layout, stores in (("none", ["z.zarr"]), ("day", ["2021_07_31.zarr", "2021_08_01.zarr", "2021_08_02.zarr"])):
        assert isinstance(open_store(spark, "file:///x", "zarr", layout), zarr.ZarrStore)
        store = zarr.ZarrStore(spark, f"file://{tmp_path}/{layout}", layout, 3)  # appends fill chunks up
        assert store.list_data_types() == []
        first = rows(frame, 4).withColumn("ObsValue", F.struct("ObsValue.value", F.lit(7).alias("n"), F.array(F.col("ObsValue.value"), F.lit(2.5)).alias("wide")))
        store.put(first, "z", channels=[1, 2])
        store.put(first.where(f"{POS} < 2"), "z", channels=[1, 2])
        assert store.list_data_types() == ["z"] and sorted(p for p in os.listdir(tmp_path / layout / ("z" if layout == "day" else "")) if p.endswith(".zarr")) == stores
        got = store.read("z")
        assert facts(got)["channels"] == [1, 2] and got.schema["ObsValue"].dataType.simpleString() == first.schema["ObsValue"].dataType.simpleString()
        want = sorted([str(r[1:]) for r in first.collect()] + [str(r[1:]) for r in first.where(f"{POS} < 2").collect()])
        assert sorted(str(r[1:]) for r in got.collect()) == want and sorted(r[POS] for r in got.collect()) == list(range(6))
        window = get(spark, store, "z", "2021-08-01T00:00:00", END).collect()
        assert sorted(r["ObsValue"]["value"] for r in window) == [1.0, 1.0, 2.0]
        with pytest.raises(AppendSchemaError):
            store.put(rows(frame), "z")
        for number in (0, 0, 1):
            decoders.store(store, rows(frame).withColumn("category", F.lit("k")), "y", once=("w", number))
        assert store.read("y_k").count() == 8
    meta = json.loads((tmp_path / "none/z.zarr/ObsValue/wide/.zarray").read_text())
    assert meta["shape"] == [6, 2] and meta["chunks"] == [3, 2] and (tmp_path / "none/z.zarr/.zmetadata").exists()
    assert store.path("a", "b", dt.datetime(2024, 3, 5)).endswith("/a_b/2024_03_05.zarr")


def test_netcdf_files_follow_the_format():
    """Every field of the header by hand, as the format's description has them."""
    raw = netcdf.encode({"Location": 2}, {"a@G": (("Location",), np.array([1, -2], "<i4"), {"u": "m"}), "t": (("Location",), np.array([5, 2**40], "<i8"), {})}, {"k": np.array([1.5])})
    n = lambda v: v.to_bytes(8, "big")
    tag = lambda v: v.to_bytes(4, "big")
    head = b"CDF\x05" + n(0) + tag(10) + n(1) + n(8) + b"Location" + n(2)
    head += tag(12) + n(1) + n(1) + b"k\0\0\0" + tag(6) + n(1) + struct.pack(">d", 1.5)
    first = n(3) + b"a@G\0" + n(1) + n(0) + tag(12) + n(1) + n(1) + b"u\0\0\0" + tag(2) + n(1) + b"m\0\0\0" + tag(4) + n(8)
    second = n(1) + b"t\0\0\0" + n(1) + n(0) + tag(0) + n(0) + tag(10) + n(16)
    begin = len(head) + 12 + len(first) + 8 + len(second) + 8
    assert raw == head + tag(11) + n(2) + first + n(begin) + second + n(begin + 8) + struct.pack(">ii", 1, -2) + struct.pack(">qq", 5, 2**40)
    dims, variables, attributes = netcdf.decode(raw)
    assert dims == {"Location": 2} and variables["a@G"][1].tolist() == [1, -2] and variables["a@G"][2] == {"u": "m"} and attributes == {"k": [1.5]}


def test_netcdf_store_and_export(spark, frame, tmp_path):
    store = open_store(spark, f"file://{tmp_path}/n", "netcdf", "day")
    assert store.list_data_types() == []
    first = rows(frame, 4).withColumn("ObsValue", F.struct("ObsValue.value", F.lit(7).alias("n"), F.array(F.col("ObsValue.value"), F.lit(2.5)).alias("wide")))
    for number in (0, 0):
        store.put(first, "z", "s", channels=[1, 2], once=("w", number))
    store.put(first.where(f"{POS} < 2"), "z", "s")
    assert store.list_data_types() == ["z_s"] and sorted(os.listdir(tmp_path / "n/z_s")) == ["2021_07_31.nc", "2021_08_01.nc", "2021_08_02.nc"]
    got = store.read("z_s")
    assert facts(got)["channels"] == [1, 2] and got.schema["ObsValue"].dataType.simpleString() == first.schema["ObsValue"].dataType.simpleString()
    assert sorted(str(r[1:]) for r in got.collect()) == sorted([str(r[1:]) for r in first.collect()] + [str(r[1:]) for r in first.where(f"{POS} < 2").collect()])
    assert got.select(POS).distinct().count() == 6
    assert sorted(r["ObsValue"]["value"] for r in get(spark, store, "z_s", "2021-08-01T00:00:00", END).collect()) == [1.0, 1.0, 2.0]
    with pytest.raises(AppendSchemaError):
        store.put(rows(frame), "z", "s")
    target = f"file://{tmp_path}/out.nc"
    assert export.export_window(first, target, form="netcdf") and not export.export_window(first.where("false"), f"{target}2", form="netcdf")
    with pytest.raises(FileExistsError):
        export.export_window(first, target, form="netcdf")
    dims, variables, _ = netcdf.decode((tmp_path / "out.nc").read_bytes())
    assert dims == {"Location": 4, "Channel": 2} and variables["dateTime@MetaData"][1][0] == 1627771440 and variables["wide@ObsValue"][1].tolist() == [[float(i), 2.5] for i in range(4)]


def test_replayed_batches_are_stored_once(spark, frame, tmp_path):
    lake = Lake(spark, f"file://{tmp_path}/lake")
    for number in (0, 1, 1, 0):
        lake.put(rows(frame), "a", once=("stream", number))
    lake.put(rows(frame), "a", once=("other", 0))
    assert lake.read("a").count() == 12 and lake.manifest("a")["writers"] == {"stream": 1, "other": 0}
    assert sorted(r[POS] for r in lake.read("a").collect())[0] == 0 and lake.read("a").select(POS).distinct().count() == 12


def test_snapshots_do_not_change(spark, frame, tmp_path):
    lake = Lake(spark, f"file://{tmp_path}/lake", "none")
    lake.put(rows(frame), "a")
    before = lake.read("a")
    lake.put(rows(frame), "a")
    assert before.count() == 4 and lake.read("a").count() == 8


def test_append_checks(spark, frame, tmp_path):
    lake = Lake(spark, f"file://{tmp_path}/lake")
    lake.put(rows(frame), "a", channels=[1])
    base = rows(frame)
    for other in (base.withColumn("ObsValue", F.struct(F.lit(1.0).alias("other"))), base.drop("ObsValue"), base.withColumn("More", F.struct(F.lit(1).alias("x"))), base.withColumn("ObsValue", F.struct(F.lit(1).alias("value")))):
        with pytest.raises(AppendSchemaError):
            lake.put(other, "a")
    with pytest.raises(AppendSchemaError):
        lake.put(base, "a", channels=[2])
    assert lake.read("a").count() == 4
    with pytest.raises(AppendSchemaError, match="missing \\['value'\\]"):
        check_append(base.schema, base.withColumn("ObsValue", F.struct(F.lit(1.0).alias("w"))).schema)


def test_an_interrupted_first_write_counts_as_new(spark, frame, tmp_path):
    lake = Lake(spark, f"file://{tmp_path}/lake")
    os.makedirs(tmp_path / "lake/a/batches/abandoned")
    assert lake.list_data_types() == [] and lake.put(rows(frame), "a") == 0


def test_two_writers_cannot_take_a_number(spark, frame, tmp_path):
    lake = Lake(spark, f"file://{tmp_path}/lake")
    lake.put(rows(frame), "a")
    with pytest.raises(Exception, match="exists"):
        lake._publish("a", 0, {})


def test_export(spark, frame, tmp_path):
    df = frame([(None, 1.0, 2.0, [1.0, 2.0]), (5, 1.0, 2.0, [3.0, 4.0])], obs="r array<float>")
    out = export.formatted(df).orderBy("Location").collect()
    assert [r["Location"] for r in out] == [0, 1] and [r["MetaData"]["dateTime"] for r in out] == [2**63 - 1, 1627771445] and out[0]["Channel"] == [1, 2]
    path = f"file://{tmp_path}/out"
    assert not export.export_window(df.limit(0), path) and export.export_window(df, path)
    with pytest.raises(FileExistsError):
        export.export_window(df, path)
    assert export.export_window(df, path, clobber=True)


def test_dump_paths():
    paths = dumps.file_paths("/r", "atms", dt.date(2024, 1, 31), dt.date(2024, 2, 1))
    assert len(paths) == 8 and paths[4] == "/r/gdas.20240201/00/atmos/gdas.t00z.atms.tm00.bufr_d"
    assert len(dumps.file_paths("/r", "avhrr", dt.date(2024, 1, 1), dt.date(2024, 1, 1))) == 8
    with pytest.raises(ValueError):
        dumps.file_paths("/r", "nothing", dt.date(2024, 1, 1), dt.date(2024, 1, 1))


def test_ingest_through_a_decoder(spark, frame, tmp_path):
    lake = Lake(spark, f"file://{tmp_path}/lake")

    @decoders.register_decoder("ncep_dump/atms", "atms")
    def decode(session, paths):
        df = rows(frame).withColumn("category", F.when(F.col(POS) < 3, "n20").otherwise("npp"))
        return df.withColumn("MetaData", F.struct(F.col("MetaData.dateTime").alias("datetime"), "MetaData.latitude", "MetaData.longitude"))

    assert dumps.ingest(lake, "/r", "atms", dt.date(2024, 1, 1), dt.date(2024, 1, 1)) == ["atms_n20", "atms_npp"]
    assert "dateTime" in lake.read("atms_n20").schema["MetaData"].dataType.names and "ncep_dump/atms" in decoders.directory()
    for unknown in ("ncep_dump/iasi", "x"):
        with pytest.raises(LookupError):
            decoders.source(unknown)
    assert decoders.SYNOP["ObsValue"].dataType.names[0] == "pressure"


def test_notifications(spark, frame, tmp_path):
    link = {"rel": "canonical", "type": "application/bufr", "href": "https://h/a/b.bufr?x=1"}
    payloads = [json.dumps({"links": [{"rel": "via", "href": "x"}, link]}), json.dumps({"url": "https://o/c", "filename": "c.bufr"}), "oops", json.dumps({"links": [{**link, "rel": "update", "href": "https://h/u"}]})]
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "1.json").write_text("".join(json.dumps({"topic": "a/b/land/temp9", "payload": p}) + "\n" for p in payloads) + json.dumps({"topic": "z/b", "payload": payloads[0]}) + "\n")
    got = notify.parsed(spark.read.schema(notify.LANDING).json(str(landing)), "a/b/#").collect()
    assert [(r["ident"], r["file_url"], r["file_name"]) for r in got] == [("land/temp9", "https://h/a/b.bufr?x=1", "b.bufr"), ("land/temp9", "https://o/c", "c.bufr"), ("land/temp9", "https://h/u", "u")]
    lake, log = Lake(spark, f"file://{tmp_path}/lake"), str(tmp_path / "log")
    decoders.register_decoder("wis2/land/temp9", "temp9")(lambda session, paths: rows(frame, len(paths)))

    def fetch(url, name, folder):
        with open(log, "a+") as f:
            f.seek(0)
            seen = f.read().count(url + "\n")
            f.write(url + "\n")
        if url == "https://h/u" and not seen or name == "never":
            return ""  # the first try of one file fails, and every try of another
        os.makedirs(folder, exist_ok=True)
        path = os.path.join(folder, name)
        open(path, "w").close()
        return path

    def run():
        stream = notify.listen(spark, lake, str(landing), str(tmp_path / "files"), str(tmp_path / "check"), "a/b/#", fetch, tries=2)
        stream.processAllAvailable()
        stream.stop()

    run()
    assert lake.read("temp9").count() == 2
    (landing / "2.json").write_text(json.dumps({"topic": "a/b/land/temp9", "payload": json.dumps({"url": "https://o/n", "filename": "never"})}) + "\n")
    run()  # what failed is tried again with the next batch
    assert lake.read("temp9").count() == 3 and not os.listdir(tmp_path / "files/land/temp9")
    (landing / "3.json").write_text(json.dumps({"topic": "z/b", "payload": "{}"}) + "\n")
    run()
    failed = spark.read.parquet(str(tmp_path / "check/failed/2")).collect()
    assert [(r["file_name"], r["tries"]) for r in failed] == [("never", 2)] and open(log).read().count("https://o/n") == 2
    assert notify.download("file:///nothing/here", "x", str(tmp_path / "d")) == ""
    (tmp_path / "source").write_text("bulletin")
    for text in ("bulletin", "changed"):  # a file that is there already is kept
        got = notify.download(f"file://{tmp_path}/source", "../y", str(tmp_path / "d"))
        assert got == str(tmp_path / "d/y") and open(got).read() == "bulletin" and sorted(os.listdir(tmp_path / "d")) == ["y"]
        (tmp_path / "source").write_text("changed")


def test_message_catalogue(tmp_path):
    path = tmp_path / "types.yaml"
    path.write_text("""
0:
  category: surface land
  standard subtypes: {}
  local subtypes:
    1: {dataset: land_a, format: FM-12, restricted: false}
    100: {dataset: land_b, format: BUFR, restricted: true}
7: {category: empty, standard subtypes: {}, local subtypes: {}}
21:
  category: radiances
  local subtypes:
    3: {dataset: sounder}
""")
    got = decoders.message_types(str(path))
    assert [(r["category"], r["name"], r["subtype"], r["dataset"], r["format"], r["restricted"]) for r in got] == [
        (0, "surface land", 1, "land_a", "FM-12", False), (0, "surface land", 100, "land_b", "BUFR", True), (21, "radiances", 3, "sounder", None, False)
    ]


def test_decoded_rows_are_ingested(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"time": "2024-01-01T06:00:00", "latitude": 1.5, "longitude": 2.5, "pressure": 1000, "more": 1, "category": "n"}\n{"time": "2024-01-02T06:00:00", "latitude": 3.5, "longitude": 2.5, "category": "s"}\n')
    (tmp_path / "b.csv").write_text("datetime,latitude,longitude,height\n2024-01-01T12:00:00,1,2,30\n")
    lake = Lake(spark, f"file://{tmp_path}/lake")
    assert decoders.ingest(lake, "rows/synop", [f"file://{tmp_path}/a.jsonl"]) == ["synop_n", "synop_s"]
    assert decoders.ingest(lake, "rows/temp", [f"file://{tmp_path}/b.csv"]) == ["temp"]
    row = lake.read("synop_n").collect()[0]
    assert row["MetaData"]["dateTime"] == dt.datetime(2024, 1, 1, 6) and row["ObsValue"]["pressure"] == 1000 and row["ObsValue"]["temperature"] is None
    assert lake.read("temp").select("MetaData").schema == T.StructType([T.StructField("MetaData", decoders.TEMP["MetaData"].dataType)])
    with pytest.raises(ValueError):
        decoders.ingest(lake, "rows/temp", ["x.bufr"])


def test_config(tmp_path):
    path = tmp_path / "c.json"
    path.write_text(json.dumps({"root_dir": str(tmp_path), "data_lake": {"base_dir": "lake"}, "run_for_num_sec": 3}))
    got = config.from_file(str(path))
    assert got.lake_dir == f"{tmp_path}/lake" and got.data_lake.split_by == "day" and config.to_dict(got)["run_for_num_sec"] == 3
    assert "base_dir: str" in config.describe()
    for bad in ({"root_dir": "x"}, {"root_dir": "x", "data_lake": {"base_dir": "y"}, "z": 1}, {"root_dir": 1, "data_lake": {"base_dir": "y"}}, {"root_dir": "x", "data_lake": {"base_dir": "y", "split_by": "week"}}):
        with pytest.raises(config.ConfigError):
            config.load(config.Settings, bad)


def test_cli(monkeypatch, capsys):
    seen = []
    monkeypatch.setattr(cli, "dump_reader", lambda args: seen.append((args.dump_id, args.start_date, args.end_date)) or 0)
    assert cli.main(["ingest", "ncep_dump_reader", "atms", "2026-08-01", "2026-08-02"]) == 0
    assert seen == [("atms", dt.datetime(2026, 8, 1, tzinfo=dt.UTC), dt.datetime(2026, 8, 2, tzinfo=dt.UTC))]
    assert cli.main(["admin", "--list-ingestors"]) == 0 and "ncep_dump/atms" in capsys.readouterr().out
    for bad in (["ingest", "ncep_dump_reader", "atms", "2026-8-01", "2026-08-02"], ["ingest"], [], ["ingest", "ncep_dump_reader", "atms", "x", "y"]):
        with pytest.raises(SystemExit):
            cli.main(bad)
