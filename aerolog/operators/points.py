"""The long table of points: building it, selecting from it, keeping it unique."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.air import nan_to_null
from ..functions.place import parse_coords
from ..schemas import KEYS

POINT_KEYS = ("source", "station_id", "lat", "lon", "ts", "field")


def to_points(wide: DataFrame, fields: Sequence[str], ids: Sequence[str]) -> DataFrame:
    """Unpivot wide rows to one point per reading; readings that are missing make no point."""
    columns = [nan_to_null(F.col(f).cast("double")).alias(f) for f in fields]
    return (
        wide.select(*ids, *columns)
        .unpivot(list(ids), list(fields), "field", "value")
        .where(F.col("value").isNotNull())
    )


def to_wide(points: DataFrame, fields: Sequence[str], ids: Sequence[str]) -> DataFrame:
    """The inverse of :func:`to_points` over a fixed list of fields, in one aggregation."""
    return points.groupBy(*ids).agg(*[
        F.max(F.when(F.col("field") == f, F.col("value"))).alias(f) for f in fields])


def in_range(points: DataFrame, start: Column, stop: Column, ts: str = "ts") -> DataFrame:
    """Half-open time range ``[start, stop)``.

    If the table still carries its partition columns ``year`` and ``month``, whole months are
    pruned too.
    """
    if {"year", "month"} <= set(points.columns):
        def month(moment: Column) -> Column:
            return F.year(moment) * 12 + F.month(moment)
        stored = F.col("year") * 12 + F.col("month")
        points = points.where(stored.between(month(start), month(stop)))
    return points.where((F.col(ts) >= start) & (F.col(ts) < stop))


def select_points(points: DataFrame, start: Column, stop: Column,
                  stations: Sequence[str] | None = None,
                  fields: Sequence[str] | None = None) -> DataFrame:
    """Time range and, if given, stations and fields; every predicate reaches the scan."""
    chosen = in_range(points, start, stop)
    if stations is not None:
        chosen = chosen.where(F.col("station_id").isin(list(stations)))
    if fields is not None:
        chosen = chosen.where(F.col("field").isin(list(fields)))
    return chosen


def years_window(first_year: int, last_year: int) -> tuple[Column, Column]:
    """The range whose right-labelled hours are exactly those of the given calendar years."""
    def eve(year: int) -> Column:
        return F.lit(f"{year}-12-31 23:00:00").cast("timestamp_ntz")
    return eve(first_year - 1), eve(last_year)


def latest_points(points: DataFrame, ingested: Column,
                  keys: Sequence[str] = POINT_KEYS) -> DataFrame:
    """One value per key: the one ingested last (the larger value if two came together).

    An aggregate, not a window, so that copies of a hot key collapse before the shuffle.  It sorts
    within tasks (its state is a pair) but moves every key once.
    """
    return points.groupBy(*keys).agg(
        F.max_by("value", F.struct(ingested, F.col("value"))).alias("value"))


def decode_coords(df: DataFrame, column: str = "coords") -> DataFrame:
    """Replace the legacy coordinate text by ``lat`` and ``lon``."""
    return (
        df.withColumn("_place", parse_coords(F.col(column)))
        .withColumns({"lat": F.col("_place.lat"), "lon": F.col("_place.lon")})
        .drop(column, "_place")
    )


def station_places(points: DataFrame, keys: Sequence[str] = KEYS, order: str = "ts") -> DataFrame:
    """The latest coordinate pair of every station, as one pair of one row.

    The points fold to the distinct places first, by hashing; only those few are then compared.
    """
    places = points.groupBy(*keys, "lat", "lon").agg(F.max(order).alias("_last"))
    return (
        places.groupBy(*keys)
        .agg(F.max_by(F.struct("lat", "lon"), F.struct("_last", "lat", "lon")).alias("_place"))
        .select(*keys, "_place.lat", "_place.lon")
    )
