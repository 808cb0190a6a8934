"""Hourly series to EPW files, for every station at once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.air import absolute_humidity
from ..functions.calendar import hour_index
from ..functions.codes import present_weather, present_weather_code, rain_type, wind_sector
from ..operators.design import design_line
from ..operators.elevation import with_elevation
from ..operators.epw import data_span, epw_header, epw_lines, epw_rows, pad_first_day
from ..operators.gapfill import fill_window_mean, interpolate
from ..operators.ground import ground_line
from ..operators.nearest import nearest_reference
from ..operators.radiation import split, with_infrared
from ..operators.resample import daily_mean
from ..operators.weeks import season_weeks, weeks_line
from ..operators.zones import CELL, with_zone
from ..schemas import KEYS
from ..session import materialized
from ..sources.epw_files import write_epw
from .typical_year import filled_hours, with_pressure

#: Columns that are interpolated once radiation has been filled.
CONTINUOUS = ("v_air", "wind_dir", "t_db", "t_dp", "rh", "p_atm", "rain", "rain_type", "ghi")


def clean(series: DataFrame) -> DataFrame:
    """Add absolute humidity and rain type to gap-filled hours (needs ``p_atm``, see typical years)."""
    rate = F.col("prec_rate") if "prec_rate" in series.columns else None
    return series.withColumns({
        "abs_humidity": absolute_humidity(F.col("t_db"), F.col("rh")),
        "rain_type": rain_type(F.col("rain"), rate).cast("double"),
    })


def derive(series: DataFrame, places: DataFrame, keys: Sequence[str] = KEYS, ts: str = "ts",
           offset: Column | None = None, clock: str = "local", label: str = "end") -> DataFrame:
    """Everything an EPW row needs, from a dense hourly series and ``(keys, lat, lon, tz)``.

    Radiation gaps take the mean of the neighbouring days, all other gaps are interpolated, then
    follow wind sector, radiation split, infrared and weather codes.  The left join lets only the
    places, never the series, be the side that Spark may broadcast.
    """
    # one exchange by station serves the hours of a day, the gaps of a series and the sun of a day
    rows = interpolate(fill_window_mean(series.repartition(*keys), "ghi", keys, ts),
                       [c for c in CONTINUOUS if c in series.columns], hour_index(F.col(ts)), keys)
    rows = rows.withColumn("wind_dir", wind_sector(F.col("wind_dir")))
    rows = with_infrared(split(rows.join(places, list(keys), "left"), keys, ts, offset, clock, label))
    rows = rows.withColumn(
        "present_weather_observation", present_weather(F.col("rain"), F.col("rain_type")))
    return rows.withColumn("present_weather_codes", present_weather_code(
        F.col("present_weather_observation"), F.col("rain_type")))


def data_lines(derived: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    return epw_lines(pad_first_day(epw_rows(derived, keys), keys), keys)


def with_reference(stations: DataFrame, references: DataFrame, station_key: str | Sequence[str] | None = None,
                   ref_key: str = "wmo") -> DataFrame:
    """Station dimension with the attributes of its nearest reference station.

    Attributes a station already has (its city, say) are kept. A station is told by the columns of
    the library's key that the dimension has, unless others are named.
    """
    if station_key is None:
        station_key = [k for k in KEYS if k in stations.columns]
    own = [station_key] if isinstance(station_key, str) else list(station_key)
    nearest = nearest_reference(stations, references, own, ref_key)
    return stations.join(nearest, own, "left").join(
        references.drop(*[c for c in stations.columns if c != ref_key]), ref_key, "left")


def with_time_zone(stations: DataFrame, cells: DataFrame, keys: Sequence[str] = KEYS, cell: float = CELL) -> DataFrame:
    """Stations with the time zone of their place where they have none (``cells`` from ``zones.zone_cells``)."""
    found = with_zone(stations, cells, cell, keys, out="_zone").select(*keys, "_zone")
    own = F.col("tz") if "tz" in stations.columns else F.lit(None).cast("string")
    return stations.join(found, list(keys), "left").withColumn("tz", F.coalesce(own, "_zone")).drop("_zone")


def with_design_conditions(stations: DataFrame, hourly: DataFrame, keys: Sequence[str] = KEYS, ts: str = "ts") -> DataFrame:
    """Stations with design conditions of their own hours (t_db, rh, v_air, if there wind_dir; many years) where no reference gave any.

    The series is read for each kind of value: hand in a written table.
    """
    computed = design_line(hourly, keys, ts).withColumnRenamed("design_conditions", "_line")
    own = F.col("design_conditions") if "design_conditions" in stations.columns else F.lit(None).cast("string")
    return stations.join(computed, list(keys), "left").withColumn("design_conditions", F.coalesce(own, "_line")).drop("_line")


def with_raster_elevation(stations: DataFrame, tiles: DataFrame, origin: tuple[float, float], step: float, keys: Sequence[str] = KEYS) -> DataFrame:
    """Stations with the elevation of their place, in whole metres, where they have none."""
    found = with_elevation(stations, tiles, origin, step, keys=keys, out="_height").select(*keys, F.round("_height").cast("int").alias("_height"))
    own = F.col("elevation") if "elevation" in stations.columns else F.lit(None).cast("int")
    return stations.join(found, list(keys), "left").withColumn("elevation", F.coalesce(own, "_height")).drop("_height")


def header_lines(stations: DataFrame, series: DataFrame, soil: DataFrame,
                 keys: Sequence[str] = KEYS, ts: str = "ts", **options) -> DataFrame:
    """Header of every station from its hourly ``series`` (one year) and its ``soil`` layers.

    ``stations`` comes from :func:`with_reference`; options of ``epw_header``.
    """
    daily = materialized(daily_mean(series, ["t_db"], keys, ts))  # the series is folded once
    spans = data_span(daily, keys, "day")

    def of_first_year(lines: DataFrame) -> DataFrame:
        return lines.groupBy(*keys).agg(F.min_by("line", "year").alias("line"))

    weeks = of_first_year(weeks_line(season_weeks(daily, keys=keys), keys))
    return epw_header(stations, weeks, of_first_year(ground_line(soil, keys, ts)), spans, keys, **options)


def write_weather_files(series: DataFrame, stations: DataFrame, references: DataFrame,
                        soil: DataFrame, path: str, keys: Sequence[str] = KEYS,
                        station_key: str | Sequence[str] | None = None, ref_key: str = "wmo", **options) -> None:
    """EPW files of all stations from one dense hourly year each.

    ``stations`` carries ``lat, lon, tz`` and the header attributes, ``soil`` the four layers.
    Rows, weeks and spans all read ``series``: hand in a written table (``session.materialized``).
    """
    derived = derive(clean(series), stations.select(*keys, "lat", "lon", "tz"), keys)
    header = header_lines(with_reference(stations, references, station_key, ref_key),
                          series, soil, keys, **options)
    write_epw(header, data_lines(derived, keys), path, keys)


def write_station_year(points: DataFrame, stations: DataFrame, references: DataFrame,
                       soil: DataFrame, year: int, path: str, fields: Sequence[str],
                       keys: Sequence[str] = KEYS, **options) -> None:
    """Stored points of one calendar year to EPW files."""
    hours = materialized(with_pressure(filled_hours(points, year, year, fields, keys)))
    write_weather_files(hours, stations, references, soil, path, keys, **options)
