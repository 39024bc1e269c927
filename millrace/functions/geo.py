"""Great-circle distance."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: mean radius of the earth in km.
EARTH_RADIUS_KM = 6371.0


def haversine_km(lat1: str, lng1: str, lat2: str, lng2: str) -> Column:
    half_lat = F.radians(F.col(lat2) - F.col(lat1)) / 2
    half_lng = F.radians(F.col(lng2) - F.col(lng1)) / 2
    chord = F.pow(F.sin(half_lat), F.lit(2.0)) + F.cos(F.radians(F.col(lat1))) * F.cos(
        F.radians(F.col(lat2))
    ) * F.pow(F.sin(half_lng), F.lit(2.0))
    # Rounding can push the chord of two opposite points just above 1.
    return 2 * EARTH_RADIUS_KM * F.asin(F.sqrt(F.when(chord > 1.0, 1.0).otherwise(chord)))
