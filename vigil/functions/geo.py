"""Great-circle distance and grid cells as built-in expressions.

A cell is a square of ``CELL_DEGREES`` of latitude and longitude, numbered row by row from the south pole and from 180 degrees west: the
cells of a stretch of a row are one range of numbers. A table that carries its rows' cells (``with_cell``), sorted by them within
its files, answers a circle by a few ranges, which the scan compares with the row groups' least and largest numbers.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0
CELL_DEGREES = 1.0
#: Ranges of a cover at most; beyond it neighbouring rows are put together, which only makes it coarser.
MAX_RANGES = 24


def haversine_km(lat1: Column, lon1: Column, lat2: float | Column, lon2: float | Column) -> Column:
    lat2 = lat2 if isinstance(lat2, Column) else F.lit(float(lat2))
    lon2 = lon2 if isinstance(lon2, Column) else F.lit(float(lon2))
    p1, p2 = F.radians(lat1), F.radians(lat2)
    dphi = F.radians(lat2 - lat1)
    dlmb = F.radians(lon2 - lon1)
    a = F.pow(F.sin(dphi / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dlmb / 2), 2)
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(F.when(a > 1, F.lit(1.0)).otherwise(a)))


def within_km(lat: Column, lon: Column, center_lat: float, center_lon: float, radius_km: float) -> Column:
    return haversine_km(lat, lon, center_lat, center_lon) <= F.lit(float(radius_km))


def _columns(degrees: float) -> int:
    return math.ceil(360 / degrees)


def cell_of(lat: Column, lon: Column, degrees: float = CELL_DEGREES) -> Column:
    """The number of a place's cell; null for a null place or a latitude that isn't one. Longitudes count modulo 360."""
    lat, lon = lat.cast("double"), lon.cast("double")
    rows = math.ceil(180 / degrees)
    row = F.least(F.floor((lat + 90) / degrees), F.lit(rows - 1))
    column = F.least(F.floor(F.pmod(lon + 180, F.lit(360.0)) / degrees), F.lit(_columns(degrees) - 1))
    return F.when(lat.between(-90, 90), row * _columns(degrees) + column).cast("long")


def with_cell(df: DataFrame, lat: str = "lat", lon: str = "lon", cell: str = "geo_cell", degrees: float = CELL_DEGREES) -> DataFrame:
    """The rows with their cell, in files sorted by it: ready to be written."""
    out = df.withColumn(cell, cell_of(F.col(lat), F.col(lon), degrees))
    return out.repartitionByRange(F.col(cell)).sortWithinPartitions(cell)


def box(center_lat: float, center_lon: float, radius_km: float) -> tuple[float, float, list[tuple[float, float]]]:
    """(least latitude, largest latitude, stretches of longitude within -180 to 180) that hold the circle, a little widened. Around a pole and for
    very large circles all longitudes."""
    reach = radius_km / EARTH_RADIUS_KM * (1 + 1e-9) + 1e-9
    low, high = center_lat - math.degrees(reach), center_lat + math.degrees(reach)
    if low <= -90 or high >= 90 or reach >= math.pi / 2:
        return max(low, -90.0), min(high, 90.0), [(-180.0, 180.0)]
    half = math.degrees(math.asin(min(1.0, math.sin(reach) / math.cos(math.radians(center_lat))))) + 1e-9
    if half >= 180:
        return low, high, [(-180.0, 180.0)]
    west, east = (center_lon - half + 180) % 360 - 180, (center_lon + half + 180) % 360 - 180
    return low, high, [(west, east)] if west <= east else [(-180.0, east), (west, 180.0)]


def cover(center_lat: float, center_lon: float, radius_km: float, degrees: float = CELL_DEGREES) -> list[tuple[int, int]]:
    """Ranges of cell numbers (both ends included) that hold every place of the circle."""
    low, high, stretches = box(center_lat, center_lon, radius_km)
    n, rows = _columns(degrees), math.ceil(180 / degrees)
    first, last = (min(max(math.floor((x + 90) / degrees), 0), rows - 1) for x in (low, high))

    def column(lon: float) -> int:
        return min(max(math.floor((lon + 180) / degrees), 0), n - 1)

    each = [(row * n + column(west), row * n + column(east)) for row in range(first, last + 1) for west, east in stretches]
    if any(east == 180.0 for _, east in stretches):  # 180 degrees east is 180 degrees west
        each += [(row * n, row * n) for row in range(first, last + 1)]
    merged: list[tuple[int, int]] = []
    for a, b in sorted(each):
        if merged and a <= merged[-1][1] + 1:
            merged[-1] = (merged[-1][0], max(b, merged[-1][1]))
        else:
            merged.append((a, b))
    while len(merged) > MAX_RANGES:  # close the smallest gaps
        gaps = sorted(range(len(merged) - 1), key=lambda i: merged[i + 1][0] - merged[i][1])[:len(merged) - MAX_RANGES]
        closed = set(gaps)
        out: list[tuple[int, int]] = []
        for i, (a, b) in enumerate(merged):
            if i and i - 1 in closed:
                out[-1] = (out[-1][0], b)
            else:
                out.append((a, b))
        merged = out
    return merged


def in_circle(lat: Column, lon: Column, circle: Sequence[float], cell: Column | None = None, degrees: float = CELL_DEGREES) -> Column:
    """Whether a place lies within (latitude, longitude, km): a box of latitudes and, where the table has cells, their ranges, which reach
    the scan, then the exact distance."""
    center_lat, center_lon, radius = circle
    low, high, stretches = box(center_lat, center_lon, radius)
    parts = lat.between(low, high)
    if cell is not None:
        parts = parts & reduce(or_, [cell.between(a, b) for a, b in cover(center_lat, center_lon, radius, degrees)])
    elif len(stretches) == 1 and stretches[0] != (-180.0, 180.0) and -180 <= center_lon <= 180:
        # stored longitudes may run past 180; only then the box doesn't hold
        parts = parts & (lon.between(*stretches[0]) | (lon < -180) | (lon > 180))
    return parts & within_km(lat, lon, center_lat, center_lon, radius)
