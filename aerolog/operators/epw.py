"""EPW rows and header lines for all stations at once.

The words and the field order of the header lines are fixed values of the file format.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.air import hpa_to_pa
from ..functions.calendar import month_day
from ..schemas import EPW_COLUMNS, KEYS


def epw_rows(series: DataFrame, keys: Sequence[str] = KEYS, ts: str = "ts") -> DataFrame:
    """The 35 columns, typed; columns the file leaves blank are NULL strings.

    Hours run from 1 to 24; humidity and pressure are truncated to whole numbers, after taking off
    the noise that would turn 100350 into 100349.
    """
    def whole(value: Column) -> Column:
        return F.round(value, 6).cast("int")

    filled = {
        "year": F.year(ts), "month": F.month(ts), "day": F.dayofmonth(ts),
        "hour": F.hour(ts) + 1, "minute": F.minute(ts) + 1,
        "dry_bulb_temperature": F.col("t_db"),
        "dew_point_temperature": F.col("t_dp"),
        "relative_humidity": whole(F.col("rh")),
        "atmospheric_station_pressure": whole(hpa_to_pa(F.col("p_atm"))),
        "horizontal_infrared_radiation_intensity": F.col("hiri"),
        "direct_normal_radiation": F.col("dni"),
        "diffuse_horizontal_radiation": F.col("dif"),
        "wind_direction": F.col("wind_dir"),
        "wind_speed": F.col("v_air"),
        "present_weather_observation": F.col("present_weather_observation"),
        "liquid_precipitation_depth": F.col("rain"),
    }
    return series.select(*keys, *[
        filled.get(c, F.lit(None).cast("string")).alias(c) for c in EPW_COLUMNS])


def pad_first_day(rows: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Add date-only rows for the hours missing before the first row of each series."""
    order = F.struct("year", "month", "day", "hour")
    first = rows.groupBy(*keys).agg(
        F.min_by(F.struct("year", "month", "day", "hour", "minute"), order).alias("_f"))
    missing = first.where(F.col("_f.hour") > 1).select(
        *keys, "_f.year", "_f.month", "_f.day",
        F.explode(F.sequence(F.lit(1), F.col("_f.hour") - 1)).alias("hour"), "_f.minute")
    return rows.unionByName(missing, allowMissingColumns=True)


def epw_lines(rows: DataFrame, keys: Sequence[str] = KEYS, first_line: int = 9) -> DataFrame:
    """``(keys, line_no, line)``: data lines, numbered after the eight header lines by hour."""
    moment = F.make_timestamp_ntz("year", "month", "day", F.col("hour") - 1, F.lit(0), F.lit(0))
    hours = F.unix_date(moment.cast("date")).cast("bigint") * 24 + F.hour(moment)
    text = F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in EPW_COLUMNS])
    return rows.select(*keys, (hours + first_line).alias("line_no"), text.alias("line"))


def data_span(series: DataFrame, keys: Sequence[str] = KEYS, ts: str = "ts") -> DataFrame:
    """First and last day of each series."""
    return series.groupBy(*keys).agg(
        F.min(F.col(ts)).cast("date").alias("first_day"), F.max(F.col(ts)).cast("date").alias("last_day"))


def epw_header(stations: DataFrame, weeks: DataFrame, ground: DataFrame, spans: DataFrame,
               keys: Sequence[str] = KEYS, leap: bool = False, dst_start: str = "0",
               dst_end: str = "0", weekday: str = "Monday", comment1: str = "",
               comment2: str = "") -> DataFrame:
    """``(keys, line_no, line)`` with the eight header lines of every station.

    ``stations`` is the station dimension with the attributes of the nearest reference station:
    ``city, state, country, origin, wmo, lat, lon, tz_hours, elevation, design_conditions``.
    ``weeks`` and ``ground`` hold one ``line`` per key.
    """
    def text(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(""))

    def with_year(d: str) -> Column:
        return F.concat_ws("/", month_day(F.col(d)), F.year(d).cast("string"))

    rows = (
        stations
        .join(weeks.select(*keys, F.col("line").alias("_weeks")), list(keys), "left")
        .join(ground.select(*keys, F.col("line").alias("_ground")), list(keys), "left")
        .join(spans, list(keys), "left")
    )
    lines = [
        F.concat_ws(",", F.lit("LOCATION"), *[text(c) for c in (
            "city", "state", "country", "origin", "wmo", "lat", "lon", "tz_hours", "elevation")]),
        text("design_conditions"),
        text("_weeks"),
        text("_ground"),
        F.lit(f"HOLIDAYS/DAYLIGHT SAVINGS,{'Yes' if leap else 'No'},{dst_start},{dst_end},0"),
        F.lit(f"COMMENTS 1,{comment1}"),
        F.lit(f"COMMENTS 2,{comment2}"),
        F.concat_ws(",", F.lit(f"DATA PERIODS,1,1,Data,{weekday}"),
                    with_year("first_day"), with_year("last_day")),
    ]
    return rows.select(*keys, F.posexplode(F.array(*lines)).alias("_no", "line")).select(
        *keys, (F.col("_no") + 1).cast("bigint").alias("line_no"), "line")
