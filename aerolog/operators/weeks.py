"""Typical and extreme weeks of the seasons (northern hemisphere, meteorological seasons)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.calendar import day_index, month_day
from ..schemas import KEYS

#: Header phrases in file order: season, kind, text (fixed values).
PHRASES = (
    ("summer", "extreme", "Summer - Week Nearest Max Temperature For Period,Extreme"),
    ("summer", "typical", "Summer - Week Nearest Average Temperature For Period,Typical"),
    ("winter", "extreme", "Winter - Week Nearest Min Temperature For Period,Extreme"),
    ("winter", "typical", "Winter - Week Nearest Average Temperature For Period,Typical"),
    ("autumn", "typical", "Autumn - Week Nearest Average Temperature For Period,Typical"),
    ("spring", "typical", "Spring - Week Nearest Average Temperature For Period,Typical"),
)


def season(day: Column) -> Column:
    m = F.month(day)
    return (F.when(m.between(3, 5), "spring").when(m.between(6, 8), "summer")
            .when(m.between(9, 11), "autumn").otherwise("winter"))


def season_scalars(daily: DataFrame, t: str = "t_db", keys: Sequence[str] = KEYS,
                   day: str = "day") -> DataFrame:
    """Maximum, minimum and mean of the daily values per station, year and season."""
    return daily.groupBy(*keys, F.year(day).alias("year"), season(F.col(day)).alias("season")).agg(
        F.max(t).alias("t_max"), F.min(t).alias("t_min"), F.avg(t).alias("t_mean"))


def season_weeks(daily: DataFrame, t: str = "t_db", keys: Sequence[str] = KEYS,
                 day: str = "day") -> DataFrame:
    """Per station, year and season: start and end of the typical and of the extreme week.

    A week is seven present days in a row inside one stretch of the season; the winter of a year
    is its January-February and its December, which are separate stretches with a common target.
    The extreme of spring and autumn is NULL.  Groups hold at most 366 rows.
    """
    d = F.col(day)
    rows = (
        daily.select(*keys, d.alias("_day"), F.year(d).alias("year"), season(d).alias("season"),
                     (F.month(d) == 12).alias("_december"), F.col(t).alias("_t"))
        .repartition(*keys, "year")
    )
    of_season = Window.partitionBy(*keys, "year", "season")
    seven = (
        Window.partitionBy(*keys, "year", "season", "_december")
        .orderBy(day_index(F.col("_day"))).rangeBetween(-6, 0)
    )
    extreme = F.when(F.col("season") == "summer", F.max("_t").over(of_season)).when(
        F.col("season") == "winter", F.min("_t").over(of_season))
    weeks = rows.select(
        *keys, "year", "season", "_day",
        extreme.alias("_extreme"), F.avg("_t").over(of_season).alias("_mean"),
        F.avg("_t").over(seven).alias("_week"), F.count("_t").over(seven).alias("_n"),
    ).where(F.col("_n") == 7)

    def nearest(target: str) -> Column:
        distance = F.round(F.abs(F.col("_week") - F.col(target)), 9)
        return F.min_by("_day", F.when(distance.isNotNull(), F.struct(distance, F.col("_day"))))

    return weeks.groupBy(*keys, "year", "season").agg(
        nearest("_mean").alias("typical_end"), nearest("_extreme").alias("extreme_end"),
    ).select(
        *keys, "year", "season",
        F.date_sub("typical_end", 6).alias("typical_start"), "typical_end",
        F.date_sub("extreme_end", 6).alias("extreme_start"), "extreme_end",
    )


def weeks_line(weeks: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """The ``TYPICAL/EXTREME PERIODS`` header line per station and year.

    A season too short to hold a week contributes empty dates.
    """
    def dates(which: str, kind: str) -> Column:
        def one(edge: str) -> Column:
            value = F.max(F.when(F.col("season") == which, F.col(f"{kind}_{edge}")))
            return F.coalesce(month_day(value), F.lit(""))
        return F.concat_ws(",", one("start"), one("end"))

    parts = [F.concat_ws(",", F.lit(text), dates(which, kind)) for which, kind, text in PHRASES]
    return weeks.groupBy(*keys, "year").agg(
        F.concat_ws(",", F.lit(f"TYPICAL/EXTREME PERIODS,{len(PHRASES)}"), *parts).alias("line"))
