"""Points are pairs of double columns (degrees)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_METRES = 6_371_010.0


def latlon_text(text: Column) -> tuple[Column, Column]:
    """``(lat, lon)`` text to two doubles; malformed text fails the query (ANSI cast)."""
    parts = F.split(F.translate(text, "()", ""), ",")
    return parts[0].cast("double"), parts[1].cast("double")


def haversine_metres(lat1: Column, lon1: Column, lat2: Column, lon2: Column, radius: float = EARTH_RADIUS_METRES) -> Column:
    """Great-circle distance; null when any coordinate is null."""
    dlat = F.sin(F.radians(lat2 - lat1) / 2)
    dlon = F.sin(F.radians(lon2 - lon1) / 2)
    root = dlat * dlat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * dlon * dlon
    # least() skips nulls, so keep the null case explicit
    return F.when(root.isNotNull(), F.asin(F.sqrt(F.least(root, F.lit(1.0)))) * (2 * radius))


def unit_vector(lat: Column, lon: Column) -> tuple[Column, Column, Column]:
    """Point on the unit sphere. Straight-line distance orders points like great-circle distance."""
    return (
        F.cos(F.radians(lat)) * F.cos(F.radians(lon)),
        F.cos(F.radians(lat)) * F.sin(F.radians(lon)),
        F.sin(F.radians(lat)),
    )


def chord2(a: tuple[Column, Column, Column], b: tuple[Column, Column, Column]) -> Column:
    """Squared straight-line distance of two unit vectors."""
    dx, dy, dz = a[0] - b[0], a[1] - b[1], a[2] - b[2]
    return dx * dx + dy * dy + dz * dz
