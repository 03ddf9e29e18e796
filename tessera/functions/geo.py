"""SCA13 / SCA14: great-circle distance in km as native column math."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0  # fixed value used by the reference


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _hav_a(lat1, lon1, lat2, lon2) -> Column:
    p1, p2 = F.radians(_c(lat1)), F.radians(_c(lat2))
    dphi = F.radians(_c(lat2) - _c(lat1))
    dlmb = F.radians(_c(lon2) - _c(lon1))
    return F.pow(F.sin(dphi / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dlmb / 2), 2)


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    """asin form: 2 R asin(sqrt(a))."""
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(_hav_a(lat1, lon1, lat2, lon2)))


def haversine_atan2_km(lat1, lon1, lat2, lon2) -> Column:
    """atan2 form: 2 R atan2(sqrt(a), sqrt(1-a)); same value as the asin form."""
    a = _hav_a(lat1, lon1, lat2, lon2)
    return F.lit(2 * EARTH_RADIUS_KM) * F.atan2(F.sqrt(a), F.sqrt(F.lit(1.0) - a))
