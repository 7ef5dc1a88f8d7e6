"""Great-circle expressions; everything stays inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Earth radius in metres used by every distance here.
EARTH_RADIUS_M = 6_371_000.0


def haversine(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Metres between two points in degrees; null if any coordinate is null."""
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(
        F.sin(F.radians(lon2 - lon1) / 2), 2
    )
    return F.lit(2 * EARTH_RADIUS_M) * F.asin(F.sqrt(F.least(F.lit(1.0), a)))


def usable_position(lat: Column, lon: Column) -> Column:
    """True for a position that is present, finite, inside the globe and not (0, 0)."""
    return F.coalesce(
        ~F.isnan(lat) & ~F.isnan(lon) & lat.between(-90.0, 90.0) & lon.between(-180.0, 180.0) & ~((lat == 0.0) & (lon == 0.0)),
        F.lit(False),
    )


def unit_xyz(lat: Column, lon: Column) -> tuple[Column, Column, Column]:
    """The point on the sphere in metres from the centre; free of poles and date line."""
    la, lo = F.radians(lat), F.radians(lon)
    r = F.lit(EARTH_RADIUS_M)
    return r * F.cos(la) * F.cos(lo), r * F.cos(la) * F.sin(lo), r * F.sin(la)


def polyline_length(coords: Column) -> Column:
    """Sum of the legs of an array<struct<lat,lon>>; 0 for fewer than two points."""
    legs = F.zip_with(
        F.slice(coords, F.lit(1), F.greatest(F.size(coords) - 1, F.lit(0))),
        F.slice(coords, F.lit(2), F.greatest(F.size(coords) - 1, F.lit(0))),
        lambda a, b: haversine(a["lat"], a["lon"], b["lat"], b["lon"]),
    )
    return F.aggregate(legs, F.lit(0.0), lambda s, x: s + x)


def centroid(coords: Column) -> Column:
    """Arithmetic mean of the vertices as struct<lat,lon>; null for an empty array."""
    n = F.size(coords)
    mean = lambda f: F.aggregate(coords, F.lit(0.0), lambda s, c: s + c[f]) / n
    return F.when(n > 0, F.struct(mean("lat").alias("lat"), mean("lon").alias("lon")))
