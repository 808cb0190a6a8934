"""Temperature gap between the stations inside and outside an urban circle."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.place import EARTH_KM_URBAN, great_circle_km
from ..schemas import KEYS


def zone_of(lat: Column, lon: Column, center: tuple[float, float], radius_km: float) -> Column:
    """``urban`` up to the radius, ``suburban`` beyond."""
    distance = great_circle_km(lat, lon, F.lit(float(center[0])), F.lit(float(center[1])), EARTH_KM_URBAN)
    return F.when(distance <= radius_km, "urban").when(distance > radius_km, "suburban")


def zones(stations: DataFrame, center: tuple[float, float], radius_km: float,
          keys: Sequence[str] = KEYS) -> DataFrame:
    return stations.select(
        *keys, zone_of(F.col("lat"), F.col("lon"), center, radius_km).alias("zone"))


#: Sizes of the grids that circles and stations meet on, in degrees. A circle takes the finest one that is at least its own size.
GRIDS = tuple(360.0 / 2 ** k for k in range(3, 16))


def _half_width(lat: Column, radius_km: Column) -> Column:
    """Degrees of longitude that a circle reaches to either side; 180 if it holds a pole."""
    angle = radius_km / F.lit(EARTH_KM_URBAN)
    ratio = F.sin(angle) / F.greatest(F.cos(F.radians(lat)), F.lit(1e-12))
    return F.when((angle >= math.pi / 2) | (F.abs(F.radians(lat)) + angle >= math.pi / 2) | (ratio >= 1), 180.0).otherwise(
        F.degrees(F.asin(F.least(ratio, F.lit(1.0)))))


def in_circles(stations: DataFrame, circles: DataFrame, keys: Sequence[str] = KEYS, circle: str = "circle") -> DataFrame:
    """(circle, keys, km) of every station inside each of ``circles`` (circle, lat, lon, radius_km).

    A distance-range join without pairing: a circle is covered by the cells of a grid about its own
    size, a few whatever its radius; a station lies in one cell of each grid; they meet by an
    equi-join on grid and cell, and the exact distance decides. Stations or circles without a place meet nothing.
    """
    lat, lon = F.col("lat").cast("double"), F.pmod(F.col("lon").cast("double") + 180, F.lit(360.0)) - 180
    reach = F.degrees(F.col("radius_km") / F.lit(EARTH_KM_URBAN)) + 1e-9
    # a grid must not be finer than the circle is high; nor may a circle near a pole span too many cells of it
    width = F.least(_half_width(F.col("lat"), F.col("radius_km")) + 1e-9, F.lit(180.0))
    grids = F.array(*map(F.lit, GRIDS))
    size = F.greatest(reach, width / 4)
    level = F.greatest(F.size(F.filter(grids, lambda g: g >= size)) - 1, F.lit(0))
    cell = F.get(grids, F.col("level"))
    around = F.col("around")
    covered = (
        circles.where("lat is not null and lon is not null and radius_km >= 0")
        .select(F.col(circle).alias("_circle"), lat.alias("_lat"), lon.alias("_lon"), F.col("radius_km").cast("double").alias("_r"), level.alias("level"),
                reach.alias("_reach"), width.alias("_width"))
        .withColumns({"_cell": cell}).withColumn("around", F.round(360 / F.col("_cell")).cast("long"))
        .withColumn("j", F.explode(F.sequence(F.floor((F.col("_lat") - F.col("_reach") + 90) / F.col("_cell")), F.floor((F.col("_lat") + F.col("_reach") + 90) / F.col("_cell")))))
        .withColumn("first", F.floor((F.col("_lon") - F.col("_width") + 180) / F.col("_cell")))
        .withColumn("last", F.least(F.floor((F.col("_lon") + F.col("_width") + 180) / F.col("_cell")), F.col("first") + around - 1))
        .withColumn("i", F.explode(F.sequence("first", "last")))
        .select("_circle", "_lat", "_lon", "_r", "level", F.pmod("i", around).alias("i"), "j")
    )
    placed = (
        stations.where("lat is not null and lon is not null").select(*keys, F.col("lat").cast("double"), lon.alias("lon"), F.posexplode(grids).alias("level", "_cell"))
        .withColumns({"i": F.floor((F.col("lon") + 180) / F.col("_cell")), "j": F.floor((F.col("lat") + 90) / F.col("_cell"))})
    )
    km = great_circle_km(F.col("lat"), F.col("lon"), F.col("_lat"), F.col("_lon"), EARTH_KM_URBAN)
    return placed.join(covered, ["level", "i", "j"]).withColumn("km", km).where(F.col("km") <= F.col("_r")).select(F.col("_circle").alias(circle), *keys, "km")


def circle_gaps(hourly: DataFrame, stations: DataFrame, circles: DataFrame, part: Column, name: str,
                t: str = "t_db", keys: Sequence[str] = KEYS, circle: str = "circle") -> DataFrame:
    """:func:`zone_gap` of many circles at once: for each, the stations inside against all others that have a place.

    Sums of the stations inside come from :func:`in_circles`; those outside are all less these, so
    no circle meets the stations outside of it. A circle without stations, or a part without values in it, has no row.
    """
    here = stations.where("lat is not null and lon is not null").select(*keys, "lat", "lon")
    folded = hourly.groupBy(*keys, part.alias(name)).agg(F.sum(t).alias("_sum"), F.count(t).alias("_n"))
    whole = folded.join(here.select(*keys), list(keys), "left_semi").groupBy(name).agg(F.sum("_sum").alias("_all"), F.sum("_n").alias("_all_n"))
    inside = folded.join(in_circles(here, circles, keys, circle), list(keys)).groupBy(circle, name).agg(F.sum("_sum").alias("_in"), F.sum("_n").alias("_in_n"))
    both = inside.join(whole, name)
    urban, suburban = F.try_divide("_in", "_in_n"), F.try_divide(F.col("_all") - F.col("_in"), F.col("_all_n") - F.col("_in_n"))
    return both.select(circle, name, urban.alias("urban"), suburban.alias("suburban"), (urban - suburban).alias("gap"))


def zone_gap(hourly: DataFrame, station_zones: DataFrame, part: Column, name: str,
             t: str = "t_db", keys: Sequence[str] = KEYS) -> DataFrame:
    """Mean of urban minus mean of suburban hourly values per ``part`` (hour or month).

    The series are folded to one sum and count per station and part before they meet the zones.
    """
    folded = hourly.groupBy(*keys, part.alias(name)).agg(
        F.sum(t).alias("_sum"), F.count(t).alias("_n"))

    def mean(zone: str) -> Column:
        here = F.col("zone") == zone
        return F.try_divide(F.sum(F.when(here, F.col("_sum"))), F.sum(F.when(here, F.col("_n"))))

    return folded.join(station_zones, list(keys), "left").groupBy(name).agg(
        mean("urban").alias("urban"), mean("suburban").alias("suburban"),
        (mean("urban") - mean("suburban")).alias("gap"))
