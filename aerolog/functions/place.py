"""Places on the globe."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

#: Mean Earth radius in km for the reference-station search and for the urban circle (fixed values).
EARTH_KM = 6371.0
EARTH_KM_URBAN = 6373.0


def great_circle_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column,
                    radius: float = EARTH_KM) -> Column:
    """Great-circle distance of two points given in degrees."""
    dlat = F.radians(lat2 - lat1)
    dlon = F.radians(lon2 - lon1)
    a = (F.pow(F.sin(dlat / 2), F.lit(2.0))
         + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(dlon / 2), F.lit(2.0)))
    return 2 * radius * F.atan2(F.sqrt(a), F.sqrt(1 - a))


def parse_coords(text: Column) -> Column:
    """Struct ``(lat, lon)`` from the legacy text ``"(45.07, 7.69)"``; NULL if it does not parse."""
    pattern = r"^\s*\(\s*([^,\s]+)\s*,\s*([^,\s]+)\s*\)\s*$"
    return F.struct(
        F.regexp_extract(text, pattern, 1).try_cast("double").alias("lat"),
        F.regexp_extract(text, pattern, 2).try_cast("double").alias("lon"),
    )
