"""Point-in-polygon tests as column expressions, boundary included.

A bounding-box test stands first in every expression: it reaches the Parquet
scan and spares most rows the edge tests. Edges are listed by bands of latitude,
so a row meets only the few that can lie at its height.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

Ring = list[list[float]]


def polygons(geometry: dict) -> list[list[Ring]]:
    """Polygons, each a list of rings, of a GeoJSON Polygon or MultiPolygon (or a wrapper of those)."""
    kind = geometry.get("type") if isinstance(geometry, dict) else None
    if kind == "Polygon":
        return [geometry["coordinates"]]
    if kind == "MultiPolygon":
        return list(geometry["coordinates"])
    if kind == "Feature":
        return polygons(geometry["geometry"])
    if kind == "FeatureCollection":
        return [p for f in geometry["features"] for p in polygons(f)]
    raise ValueError(f"unsupported geometry: {kind}")


def _edges(rings: list[Ring]):
    for ring in rings:
        closed = ring if list(ring[0]) == list(ring[-1]) else [*ring, ring[0]]
        for a, b in zip(closed, closed[1:], strict=False):
            yield float(a[0]), float(a[1]), float(b[0]), float(b[1])


def _is_box(rings: list[Ring]) -> bool:
    if len(rings) != 1:
        return False
    edges = list(_edges(rings))
    return len(edges) == 4 and all(x1 == x2 or y1 == y2 for x1, y1, x2, y2 in edges)


def _bounds(rings: list[Ring]) -> tuple[float, float, float, float]:
    xs, ys = [p[0] for p in rings[0]], [p[1] for p in rings[0]]
    return float(min(xs)), float(min(ys)), float(max(xs)), float(max(ys))


def within_box(lon: Column, lat: Column, x1: float, y1: float, x2: float, y2: float) -> Column:
    return lon.between(x1, x2) & lat.between(y1, y2)


def _listed(edges) -> str:
    """A constant array of edges as SQL: one expression, however many edges."""
    named = (f"named_struct('x1', {x1!r}D, 'y1', {y1!r}D, 'x2', {x2!r}D, 'y2', {y2!r}D)" for x1, y1, x2, y2 in edges)
    return f"array({', '.join(named)})"


def _table(edges) -> Column:
    return F.expr(_listed(edges))


def _edge_table(rings: list[Ring]) -> Column:
    """The edges as a constant array: the tests fold over it, so generated code does not grow with the ring."""
    return _table(_edges(rings))


#: Edges that a band aims at, and bands at most.
BAND_EDGES, MOST_BANDS = 4, 512


def _at_height(lat: Column, rings: list[Ring]) -> Column:
    """The edges whose heights reach the band of a latitude: all that it can cross or lie on."""
    edges = list(_edges(rings))
    low, high = min(e[1] for e in edges), max(e[1] for e in edges)
    n = min(MOST_BANDS, len(edges) // BAND_EDGES)
    if n < 2 or high <= low:
        return _table(edges)
    step = (high - low) / n
    slack = step * 1e-6  # rounding may put a latitude into the next band
    bands = [[e for e in edges if min(e[1], e[3]) <= low + (k + 1) * step + slack and max(e[1], e[3]) >= low + k * step - slack] for k in range(n)]
    at = F.greatest(F.least(F.floor((lat - low) / step), F.lit(n - 1)), F.lit(0)).cast("int")
    return F.get(F.expr(f"array({', '.join(map(_listed, bands))})"), at)  # no band of a closed ring is empty


def _in_rings(lon: Column, lat: Column, rings: list[Ring]) -> Column:
    """Even-odd rule over all rings, or on an edge."""

    def crosses(e):
        # No level edge passes the first test, so the slope is always defined where it counts.
        slope = (e["x2"] - e["x1"]) / F.nullif(e["y2"] - e["y1"], F.lit(0.0))
        return F.coalesce(((e["y1"] > lat) != (e["y2"] > lat)) & (lon < (lat - e["y1"]) * slope + e["x1"]), F.lit(False))

    def on(e):
        cross = (lon - e["x1"]) * (e["y2"] - e["y1"]) - (lat - e["y1"]) * (e["x2"] - e["x1"])
        return (cross == 0) & lon.between(F.least(e["x1"], e["x2"]), F.greatest(e["x1"], e["x2"])) & lat.between(F.least(e["y1"], e["y2"]), F.greatest(e["y1"], e["y2"]))

    many = 1 << 20  # even, and more than any ring has edges: an edge that holds the point decides alone
    score = F.aggregate(_at_height(lat, rings), F.lit(0), lambda n, e: n + F.when(on(e), many).otherwise(crosses(e).cast("int")))
    return F.coalesce((score >= many) | (score % 2 == 1), F.lit(False))


def _near_edges(lon: Column, lat: Column, rings: list[Ring], width: float) -> Column:
    def near(e):
        dx, dy = e["x2"] - e["x1"], e["y2"] - e["y1"]
        along = ((lon - e["x1"]) * dx + (lat - e["y1"]) * dy) / F.nullif(dx * dx + dy * dy, F.lit(0.0))
        t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(along, F.lit(0.0))))
        return F.pow(lon - e["x1"] - t * dx, 2) + F.pow(lat - e["y1"] - t * dy, 2) <= width * width

    return F.exists(_edge_table(rings), near)


def contains(lon: Column, lat: Column, geometry: dict, border: float | None = None) -> Column:
    """Inside or on the boundary; with ``border``, also within that many degrees of it, wrapped at the antimeridian."""
    if border is not None and border < 0:
        raise ValueError("border width must not be negative")
    lon, lat = lon.cast("double"), lat.cast("double")

    def one(rings: list[Ring], x: Column) -> Column:
        x1, y1, x2, y2 = _bounds(rings)
        if not border:
            box = within_box(x, lat, x1, y1, x2, y2)
            return box if _is_box(rings) else box & _in_rings(x, lat, rings)
        box = within_box(x, lat, x1 - border, y1 - border, x2 + border, y2 + border)
        return box & (_in_rings(x, lat, rings) | _near_edges(x, lat, rings, border))

    shapes = polygons(geometry)
    plain = reduce(lambda a, b: a | b, (one(p, lon) for p in shapes))
    if not border:
        return plain
    shifted = [one(p, lon + s) for p in shapes for s in (-360.0, 360.0)]
    return within_box(lon, lat, -180.0, -90.0, 180.0, 90.0) & reduce(lambda a, b: a | b, shifted, plain)
