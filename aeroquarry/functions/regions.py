"""Named regions. Longitudes are in [-180, 180]."""

from __future__ import annotations


def _box(west: float, south: float, east: float, north: float) -> list:
    return [[[west, south], [east, south], [east, north], [west, north], [west, south]]]


# The regions' boundaries.
BOXES = {
    "central_pacific_basin": [(-180.0, 0.0, -140.0, 40.0)],
    "global": [(-180.0, -90.0, 180.0, 90.0)],
    "guam": [(144.5, 13.2, 146.0, 15.4)],
    "hawaii": [(-160.8, 18.5, -154.4, 22.5)],
    "nh_extratropics": [(-180.0, 20.0, 180.0, 80.0)],
    "nino12": [(-90.0, -10.0, -80.0, 0.0)],
    "nino3": [(-150.0, -5.0, -90.0, 5.0)],
    "nino34": [(-170.0, -5.0, -120.0, 5.0)],
    "nino4": [(160.0, -5.0, 180.0, 5.0), (-180.0, -5.0, -150.0, 5.0)],
    "north_polar": [(-180.0, 60.0, 180.0, 90.0)],
    "northern_hemisphere": [(-180.0, 0.0, 180.0, 90.0)],
    "pna": [(-180.0, 20.0, -40.0, 75.0)],
    "puerto_rico": [(-68.0, 17.8, -65.2, 18.6)],
    "sh_extratropics": [(-180.0, -80.0, 180.0, -20.0)],
    "south_polar": [(-180.0, -90.0, 180.0, -60.0)],
    "southern_hemisphere": [(-180.0, -90.0, 180.0, 0.0)],
    "tropics": [(-180.0, -20.0, 180.0, 20.0)],
}
RINGS = {
    "alaska": [
        [[-180.0, 51.0], [-165.0, 53.5], [-155.0, 55.0], [-145.0, 59.0], [-137.0, 57.0], [-133.0, 54.4], [-130.0, 54.6], [-130.0, 56.1], [-135.0, 59.6], [-137.5, 59.2], [-139.0, 60.3], [-141.0, 60.3], [-141.0, 69.7], [-150.0, 70.6], [-156.8, 71.5], [-162.0, 70.5], [-166.0, 69.0], [-168.97, 69.0], [-168.97, 65.5], [-173.0, 63.5], [-180.0, 62.0], [-180.0, 51.0]],
        [[172.0, 51.5], [180.0, 51.0], [180.0, 55.0], [172.0, 54.0], [172.0, 51.5]],
    ],
    "atlantic_basin": [
        [[-77.5, 7.0], [-83.0, 9.5], [-86.0, 12.5], [-90.0, 15.0], [-94.5, 17.0], [-100.0, 22.0], [-104.0, 28.0], [-100.0, 60.0], [0.0, 60.0], [0.0, 0.0], [-50.0, 0.0], [-60.0, 8.0], [-77.5, 7.0]],
    ],
    "conus": [
        [[-124.7, 48.4], [-123.2, 48.2], [-123.0, 49.0], [-95.15, 49.0], [-95.15, 49.38], [-89.6, 48.0], [-84.8, 46.5], [-82.4, 43.0], [-83.1, 42.0], [-79.0, 42.8], [-79.2, 43.4], [-76.4, 44.2], [-74.7, 45.0], [-71.5, 45.0], [-70.8, 45.4], [-70.0, 46.7], [-69.2, 47.45], [-67.8, 47.1], [-67.8, 45.7], [-66.9, 44.8], [-70.0, 43.7], [-70.6, 42.6], [-69.9, 41.6], [-71.9, 41.0], [-74.0, 40.4], [-74.9, 38.9], [-75.5, 35.2], [-77.9, 33.8], [-81.0, 31.5], [-80.0, 26.7], [-80.1, 25.6], [-80.4, 25.1], [-81.8, 24.5], [-82.9, 27.5], [-84.3, 29.9], [-87.5, 30.2], [-89.4, 30.0], [-89.4, 29.0], [-91.5, 29.3], [-94.0, 29.6], [-97.2, 27.6], [-97.15, 25.95], [-99.5, 27.5], [-101.4, 29.8], [-103.2, 29.0], [-104.7, 30.0], [-106.5, 31.8], [-108.2, 31.8], [-108.2, 31.33], [-111.1, 31.33], [-114.8, 32.5], [-117.1, 32.5], [-118.5, 34.0], [-120.6, 34.5], [-121.9, 36.6], [-122.5, 37.8], [-123.7, 38.9], [-124.4, 40.4], [-124.2, 42.0], [-124.5, 43.0], [-124.0, 46.3], [-124.7, 48.4]],
    ],
    "eastern_pacific_basin": [
        [[-140.0, 0.0], [-79.0, 0.0], [-77.5, 7.0], [-83.0, 9.5], [-86.0, 12.5], [-90.0, 15.0], [-94.5, 17.0], [-100.0, 22.0], [-104.0, 28.0], [-114.0, 33.0], [-125.0, 40.0], [-140.0, 40.0], [-140.0, 0.0]],
    ],
}


def names() -> list[str]:
    return sorted({*BOXES, *RINGS})


def geometry(name: str) -> dict:
    """GeoJSON MultiPolygon of a region; names are trimmed and lower-cased."""
    key = name.strip().lower()
    if key in BOXES:
        return {"type": "MultiPolygon", "coordinates": [_box(*b) for b in BOXES[key]]}
    if key in RINGS:
        return {"type": "MultiPolygon", "coordinates": [[r] for r in RINGS[key]]}
    raise KeyError(name)
