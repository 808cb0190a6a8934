"""Climate indicators straight from stored points, for every source and station at once.

All of them read one or a few fields of a range of years and fold them to hourly means first, so
hours weigh equally however many points they hold.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.calendar import day_index
from ..operators import compare, degree, urban
from ..operators.gapfill import interpolate
from ..operators.points import in_range, years_window
from ..operators.resample import daily_mean, hourly_wide, yearly_mean
from ..schemas import KEYS


def hourly_years(points: DataFrame, first_year: int, last_year: int, fields: Sequence[str] = ("t_db",),
                 keys: Sequence[str] = KEYS) -> DataFrame:
    start, stop = years_window(first_year, last_year)
    return hourly_wide(in_range(points, start, stop), fields, keys)


def degree_day_trend(points: DataFrame, first_year: int, last_year: int, heating: bool,
                     keys: Sequence[str] = KEYS) -> DataFrame:
    """Degree days per station and year; a year without data counts zero."""
    daily = daily_mean(hourly_years(points, first_year, last_year, keys=keys), ["t_db"], keys)
    degrees = degree.heating_degrees if heating else degree.cooling_degrees
    return degree.degree_days(daily, degrees(F.col("t_db")), keys, years=(first_year, last_year))


def temperature_trend(points: DataFrame, first_year: int, last_year: int,
                      keys: Sequence[str] = KEYS) -> DataFrame:
    """Yearly mean temperature per station; a year without data is NULL."""
    return yearly_mean(hourly_years(points, first_year, last_year, keys=keys), ["t_db"], keys,
                       years=(first_year, last_year))


def urban_gap(points: DataFrame, places: DataFrame, center: tuple[float, float], radius_km: float,
              first_year: int, last_year: int, by: str = "hour",
              keys: Sequence[str] = KEYS) -> DataFrame:
    """Gap between urban and suburban stations by hour of day or month of year."""
    part = {"hour": F.hour("ts"), "month": F.month("ts")}[by]
    hourly = hourly_years(points, first_year, last_year, keys=keys)
    return urban.zone_gap(hourly, urban.zones(places, center, radius_km, keys), part, by, keys=keys)


def urban_gaps(points: DataFrame, places: DataFrame, circles: DataFrame, first_year: int, last_year: int, by: str = "hour",
               keys: Sequence[str] = KEYS) -> DataFrame:
    """:func:`urban_gap` of many circles (circle, lat, lon, radius_km) in one pass over the points."""
    part = {"hour": F.hour("ts"), "month": F.month("ts")}[by]
    return urban.circle_gaps(hourly_years(points, first_year, last_year, keys=keys), places, circles, part, by, keys=keys)


def degree_hours_by_method(typical_rows: DataFrame, heating: bool,
                           keys: Sequence[str] = (*KEYS, "method")) -> DataFrame:
    """Degree hours of typical years, one row per series, method and threshold."""
    run = degree.heating_degree_hours if heating else degree.cooling_degree_hours
    return run(typical_rows, keys=keys)


def daily_curves(typical_rows: DataFrame, columns: Sequence[str] = ("t_db",),
                 keys: Sequence[str] = (*KEYS, "method")) -> DataFrame:
    """Daily means of typical years with gaps interpolated, to lay methods or periods side by side."""
    daily = daily_mean(typical_rows, columns, keys, "tmy_ts")
    return interpolate(daily, columns, day_index(F.col("day")), keys)


def weather_file_against_station(epw: DataFrame, points: DataFrame, start: Column, stop: Column,
                                 keys: Sequence[str] = KEYS, files: Sequence[str] = (), pairs: DataFrame | None = None) -> DataFrame:
    """Bias and correlation of the dry bulb of EPW rows ``(ts, dry_bulb_temperature)`` with stations.

    ``files`` names the columns that tell one file from another; each is compared on its own, with the
    stations that ``pairs`` (files, keys) gives it, by station and hour. Without pairs it is compared with every station,
    which is meant for one file or a few. An hour that a file holds twice is an error.

    EPW hour h (1 to 24) belongs to the station hour labelled h - 1, which is the ``ts`` that
    reading and writing EPW files use.
    """
    series = hourly_wide(in_range(points, start, stop), ("t_db",), keys)
    once = F.when(F.count(F.lit(1)) > 1, F.raise_error(F.lit("a weather file holds an hour twice"))).otherwise(
        F.max("dry_bulb_temperature"))
    file = epw.where("ts is not null").groupBy(*files, "ts").agg(once.cast("double").alias("epw_t"))
    if pairs is None:
        both = compare.aligned(series, file, ["ts"])
    else:
        both = compare.paired(series, file, pairs, keys, files, ["ts"])
    return compare.pearson_and_bias(both, "epw_t", "t_db", [*keys, *files])
