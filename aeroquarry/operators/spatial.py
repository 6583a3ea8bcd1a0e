"""Spatial OR filters: boxes, GeoJSON shapes and named regions."""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import regions
from ..functions.frame import LATITUDE, LONGITUDE
from ..functions.polygons import contains, polygons, within_box
from ..plans.registry import OrFilter, register_filter


@register_filter("bounding_box")
class BoundingBox(OrFilter):
    """A closed box; it can't span the antimeridian."""

    def checked(self, arg):
        box = {k: float(arg[k]) for k in ("min_lat", "max_lat", "min_lon", "max_lon")}
        if any(math.isnan(v) for v in box.values()):
            raise ValueError("bounds must be numbers")
        if box["min_lat"] > box["max_lat"] or box["min_lon"] > box["max_lon"]:
            raise ValueError("a minimum lies above its maximum")
        return box

    def condition(self, df: DataFrame) -> Column:
        b = self.arg
        return within_box(F.col(LONGITUDE), F.col(LATITUDE), b["min_lon"], b["min_lat"], b["max_lon"], b["max_lat"])


@register_filter("geojson")
class GeoJson(OrFilter):
    """Inside or on a Polygon or MultiPolygon, given as a dict or the path of a file."""

    def checked(self, arg):
        if isinstance(arg, str):
            import os

            with open(os.path.expanduser(arg)) as f:
                arg = json.load(f)
        if not polygons(arg):
            raise ValueError("the geometry is empty")
        return arg

    def condition(self, df: DataFrame) -> Column:
        return contains(F.col(LONGITUDE), F.col(LATITUDE), self.arg)


@register_filter("region")
class Region(OrFilter):
    """A named region, optionally widened by ``border_width`` degrees."""

    def checked(self, arg):
        if isinstance(arg, str):
            arg = {"name": arg}
        if not isinstance(arg, dict) or "name" not in arg:
            raise ValueError(f"a region name is needed; known: {regions.names()}")
        try:
            shape = regions.geometry(arg["name"])
        except KeyError:
            raise ValueError(f"unknown region '{arg['name']}'; known: {regions.names()}") from None
        width = arg.get("border_width")
        if width is not None and (isinstance(width, bool) or not isinstance(width, (int, float)) or width < 0):
            raise ValueError("border_width must be a number from zero")
        return shape, width

    def condition(self, df: DataFrame) -> Column:
        shape, width = self.arg
        return contains(F.col(LONGITUDE), F.col(LATITUDE), shape, width)
