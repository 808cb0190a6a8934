"""Points to typical years, for every station and source at once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions.air import station_pressure
from ..operators.gapfill import fill_same_hour
from ..operators.points import in_range, years_window
from ..operators.resample import hourly_wide
from ..operators.typical_year import iso_typical_year, mean_typical_year
from ..schemas import FIELDS, KEYS
from ..session import bucketed, materialized


def filled_hours(points: DataFrame, first_year: int, last_year: int,
                 fields: Sequence[str] = FIELDS, keys: Sequence[str] = KEYS,
                 stations: DataFrame | None = None, by_station: bool = False) -> DataFrame:
    """Dense, gap-filled hourly series of whole calendar years.

    The raw points are read once: the hourly table is written and everything else reads that. With
    ``by_station`` it is written in buckets of stations while it is sparse: the filled hours are then made where their
    station lies, and whatever goes by station after that moves none of them. That suits networks, not a few long series.
    """
    start, stop = years_window(first_year, last_year)
    sparse = hourly_wide(in_range(points, start, stop), fields, keys)
    hourly = bucketed(sparse, keys) if by_station else materialized(sparse)
    return fill_same_hour(
        hourly, fields, F.lit(f"{first_year}-01-01 00:00:00").cast("timestamp_ntz"),
        F.lit(f"{last_year}-12-31 23:00:00").cast("timestamp_ntz"), keys, stations=stations)


def with_pressure(series: DataFrame) -> DataFrame:
    """One ``p_atm`` for sources that store it and for those that store its extremes."""
    return series.withColumn("p_atm", station_pressure(
        F.col("p_atm"), F.col("p_atm_min"), F.col("p_atm_max")))


def iso_years(points: DataFrame, first_year: int, last_year: int, columns: Sequence[str],
              keys: Sequence[str] = KEYS, **options) -> DataFrame:
    """Typical years by the ranked selection; options of ``iso_typical_year``.

    The filled table is written because it is read twice: the ranking reads four columns of it,
    the gathering one year in ``last_year - first_year + 1``. It stays bucketed by station, so neither moves it.
    """
    hourly = bucketed(filled_hours(points, first_year, last_year, columns, keys, by_station=True), keys)
    return iso_typical_year(hourly, columns, keys, **options)


def mean_years(points: DataFrame, first_year: int, last_year: int, mean: Sequence[str],
               mode: Sequence[str] = ("wind_dir",), keys: Sequence[str] = KEYS) -> DataFrame:
    """Typical years by averaging."""
    hourly = filled_hours(points, first_year, last_year, [*mean, *mode], keys)
    return mean_typical_year(hourly, mean, mode, keys)
