"""Geometry of cells and chords, as column expressions."""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0
KM_PER_DEGREE = 111.195


class Cell(NamedTuple):
    lat_bin: Column
    lon_bin: Column
    lat_center: Column
    lon_center: Column


def reduced_cell(lat: Column, lon: Column, dlat: float, dlon: float) -> Cell:
    """Cell of a reduced grid: rows of height dlat, each with as many columns as keep cells about dlon wide."""
    lon = F.pmod(lon.cast("double"), F.lit(360.0))
    lat_bin = F.floor((lat.cast("double") + 90.0) / dlat)
    lat_center = F.greatest(F.least((lat_bin + 0.5) * dlat - 90.0, F.lit(90.0)), F.lit(-90.0))
    columns = F.greatest(F.rint(360.0 * F.cos(F.radians(lat_center)) / dlon), F.lit(1.0))
    lon_bin = F.least(F.floor(lon / 360.0 * columns).cast("double"), columns - 1)
    return Cell(lat_bin, lon_bin.cast("long"), lat_center, (lon_bin + 0.5) * (F.lit(360.0) / columns))


def unit_xyz(lat: Column, lon: Column) -> tuple[Column, Column, Column]:
    phi, lam = F.radians(lat.cast("double")), F.radians(lon.cast("double"))
    return F.cos(phi) * F.cos(lam), F.cos(phi) * F.sin(lam), F.sin(phi)


def chord(distance_km: float) -> float:
    """Straight-line length, on the unit sphere, of a great-circle distance."""
    return 2.0 * math.sin(min(distance_km / (2.0 * EARTH_RADIUS_KM), math.pi / 2))


def resolution(arg: dict) -> tuple[str, tuple[float, float] | float]:
    """("grid", (dlat, dlon)) or ("distance", km) from filter arguments; ValueError says what is wrong."""

    def number(value, what: str) -> float:
        if isinstance(value, bool) or not isinstance(value, (int, float)):
            raise ValueError(f"{what} must be a number")
        if not math.isfinite(value) or value <= 0:
            raise ValueError(f"{what} must be finite and above zero")
        return float(value)

    given = [k for k in ("grid", "distance") if arg.get(k) is not None]
    if len(given) != 1:
        raise ValueError("exactly one of 'grid' and 'distance' is needed")
    if given == ["grid"]:
        grid = arg["grid"]
        if isinstance(grid, (list, tuple)):
            if len(grid) != 2:
                raise ValueError("grid must be a number or a pair")
            return "grid", (number(grid[0], "grid"), number(grid[1], "grid"))
        return "grid", (number(grid, "grid"),) * 2
    units = arg.get("units", "km")
    if units not in ("km", "deg"):
        raise ValueError("units must be 'km' or 'deg'")
    return "distance", number(arg["distance"], "distance") * (KM_PER_DEGREE if units == "deg" else 1.0)
