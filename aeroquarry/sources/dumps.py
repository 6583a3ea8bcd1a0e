"""Batch ingest of six-hourly dump files."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from . import decoders
from .lake import Lake

# Hours of a day and the file of each dump id.
HOURS = ("00", "06", "12", "18")
TEMPLATES = {
    "atms": "{hour}/atmos/gdas.t{hour}z.atms.tm00.bufr_d",
    "cris": "{hour}/atmos/gdas.t{hour}z.crisf4.tm00.bufr_d",
    "iasi": "{hour}/atmos/gdas.t{hour}z.mtiasi.tm00.bufr_d",
    "radiosonde": "{hour}/atmos/gdas.t{hour}z.prepbufr",
    "surface_obs": "{hour}/atmos/gdas.t{hour}z.prepbufr",
    "ssmis": "{hour}/atmos/gdas.t{hour}z.ssmisu.tm00.bufr_d",
    "seviri_asr": "{hour}/atmos/gdas.t{hour}z.sevasr.tm00.bufr_d",
    "seviri_csr": "{hour}/atmos/gdas.t{hour}z.sevcsr.tm00.bufr_d",
    "amsua": "{hour}/atmos/gdas.t{hour}z.1bamua.tm00.bufr_d",
    "mhs": "{hour}/atmos/gdas.t{hour}z.1bmhs.tm00.bufr_d",
    "ascat": "{hour}/atmos/gdas.t{hour}z.ascatt.tm00.bufr_d",
    "viirs": "{hour}/atmos/gdas.t{hour}z.sstvcw.tm00.bufr_d",
    "avhrr": "{hour}/atmos/gdas.t{hour}z.avcs{am_pm}.tm00.bufr_d",
    "aircraft": "{hour}/atmos/gdas.t{hour}z.prepbufr.acft_profiles",
}
HALVES = {"avhrr": ("am", "pm")}
AUX_FILES = {"atms": ("atms_beamwidth.txt",)}


def file_paths(root: str, dump_id: str, start: dt.date, end: dt.date) -> list[str]:
    """Files of every hour of every day from start to end, both included."""
    if dump_id not in TEMPLATES:
        raise ValueError(f"no path template for dump id '{dump_id}'")
    days = [start + dt.timedelta(d) for d in range((end - start).days + 1)]
    halves = HALVES.get(dump_id, ("",))
    return [f"{root}/gdas.{day:%Y%m%d}/{TEMPLATES[dump_id].format(hour=h, am_pm=half)}" for day in days for h in HOURS for half in halves]


def ingest(lake: Lake, root: str, dump_id: str, start: dt.date, end: dt.date, aux_dir: str | None = None) -> list[str]:
    """All files of the range in one job; auxiliary files are sent to the executors first."""
    paths: Sequence[str] = file_paths(root, dump_id, start, end)
    for name in AUX_FILES.get(dump_id, ()):
        if aux_dir:
            lake.spark.sparkContext.addFile(f"{aux_dir}/{name}")
    return decoders.ingest(lake, f"ncep_dump/{dump_id}", paths)
