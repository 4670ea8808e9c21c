"""Great-circle distance and grid cells (f17), native expressions only."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values ---------------------------------------------------------------
EARTH_RADIUS_MI = 3958.7613
EARTH_RADIUS_KM = 6371.0
# ----------------------------------------------------------------------------
KM_PER_DEG_LAT = math.pi * EARTH_RADIUS_KM / 180.0


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def haversine(lat1, lon1, lat2, lon2, radius: float = EARTH_RADIUS_KM) -> Column:
    """f17: great-circle distance; asin argument capped at 1."""
    p1, p2 = F.radians(_c(lat1)), F.radians(_c(lat2))
    dphi = p2 - p1
    dl = F.radians(_c(lon2)) - F.radians(_c(lon1))
    a = F.pow(F.sin(dphi / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dl / 2), 2)
    return F.lit(2.0 * radius) * F.asin(F.least(F.lit(1.0), F.sqrt(a)))


def haversine_miles(lat1, lon1, lat2, lon2) -> Column:
    return haversine(lat1, lon1, lat2, lon2, EARTH_RADIUS_MI)


def haversine_sql(a: str, b: str, radius: float = EARTH_RADIUS_KM) -> str:
    """The same formula as SQL text (used by oracles and SQL views)."""
    return (f"(2.0 * {radius} * asin(least(1.0, sqrt(pow(sin((radians({b}.lat) - radians({a}.lat)) / 2), 2) "
            f"+ cos(radians({a}.lat)) * cos(radians({b}.lat)) * pow(sin((radians({b}.lon) - radians({a}.lon)) / 2), 2)))))")
