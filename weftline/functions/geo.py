"""Great-circle distances."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

RADIUS_KM = 6371.0


def haversine_km(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    p1, p2 = F.radians(lat1), F.radians(lat2)
    a = F.pow(F.sin((p2 - p1) / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(F.radians(lng2 - lng1) / 2), 2)
    return 2 * RADIUS_KM * F.atan2(F.sqrt(a), F.sqrt(1 - a))


def rounded_km(km: Column) -> Column:
    """To whole kilometres, halves to even."""
    return F.bround(km).cast("long")
