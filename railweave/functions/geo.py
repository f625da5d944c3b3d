"""Distances and the cells that bring near points together (GEO-01)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

EARTH_M = 6371000.0
#: Edge of a cell for pairs within 100 m: a hair over, so that rounding loses none. A chord is never longer than its arc.
CELL_M = 100.0001


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Metres between two points; infinite if a coordinate is null or NaN."""
    phi1, phi2 = F.radians(lat1), F.radians(lat2)
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2.0), 2) + F.cos(phi1) * F.cos(phi2) * F.pow(F.sin(F.radians(lon2 - lon1) / 2.0), 2)
    d = F.lit(EARTH_M) * 2.0 * F.atan2(F.sqrt(a), F.sqrt(1.0 - a))
    return F.coalesce(F.nanvl(d, F.lit(float("inf"))), F.lit(float("inf")))


def cell(lat: Column, lon: Column, edge: float = CELL_M) -> Column:
    """The cube (x, y, z) of a point on the sphere, which works at the poles and across 180 degrees; null without coordinates."""
    flat = F.cos(F.radians(lat)) * EARTH_M
    x, y, z = flat * F.cos(F.radians(lon)), flat * F.sin(F.radians(lon)), F.sin(F.radians(lat)) * EARTH_M
    known = lat.isNotNull() & lon.isNotNull() & ~F.isnan(lat) & ~F.isnan(lon)
    return F.when(known, F.struct(*(F.floor(v / edge).alias(n) for v, n in ((x, "x"), (y, "y"), (z, "z")))))


def around(c: Column) -> Column:
    """A cell and its 26 neighbours."""
    steps = [(i, j, k) for i in (-1, 0, 1) for j in (-1, 0, 1) for k in (-1, 0, 1)]
    return F.array(*(F.struct((c["x"] + i).alias("x"), (c["y"] + j).alias("y"), (c["z"] + k).alias("z")) for i, j, k in steps))


def names_match(a: Column, b: Column) -> Column:
    """FLT-06: one name holds the other; an empty name is held by all."""
    return F.contains(a, b) | F.contains(b, a)
