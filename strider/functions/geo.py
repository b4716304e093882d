"""Great-circle distance on latitude / longitude in degrees."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Mean Earth radius in metres; degrees → radians factor.
EARTH_RADIUS_M = 6371000.0
DEG_TO_RAD = math.pi / 180.0


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def haversine_m(lat1: Column | str, lng1: Column | str,
                lat2: Column | str, lng2: Column | str) -> Column:
    """Haversine distance in metres."""
    lat1, lng1, lat2, lng2 = _col(lat1), _col(lng1), _col(lat2), _col(lng2)
    rad = F.lit(DEG_TO_RAD)
    s_lat = F.sin((lat2 - lat1) * rad / 2)
    s_lng = F.sin((lng2 - lng1) * rad / 2)
    a = s_lat * s_lat + F.cos(lat1 * rad) * F.cos(lat2 * rad) * (s_lng * s_lng)
    return F.lit(2 * EARTH_RADIUS_M) * F.asin(F.sqrt(a))
