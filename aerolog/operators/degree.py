"""Heating and cooling degree days and degree hours."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.calendar import not_leap_day
from ..schemas import KEYS
from .resample import with_all_years

#: Base and limit temperatures of degree days in °C (fixed values).
HEATING_BASE, HEATING_LIMIT = 18, 15
COOLING_BASE, COOLING_LIMIT = 21, 24

#: Thresholds of degree hours in °C (fixed values).
HEATING_HOURS = (18, 20, 22)
COOLING_HOURS = (18, 21, 24, 26, 28)
RESIDUAL_HOURS = (18, 21, 24, 26)


def heating_degrees(t: Column) -> Column:
    return F.when(t <= HEATING_LIMIT, HEATING_BASE - t)


def cooling_degrees(t: Column) -> Column:
    return F.when(t >= COOLING_LIMIT, t - COOLING_BASE)


def degree_days(daily: DataFrame, degrees: Column, keys: Sequence[str] = KEYS, day: str = "day",
                years: tuple[int, int] | None = None) -> DataFrame:
    """Yearly sum of ``degrees`` (:func:`heating_degrees` or :func:`cooling_degrees`).

    February 29 does not count.  With ``years``, only these, and every station with data in them
    has a row for each.
    """
    rows = daily.where(not_leap_day(F.col(day))).select(
        *keys, F.year(day).alias("year"), degrees.alias("_degrees"))
    if years is not None:
        rows = rows.where(F.col("year").between(*years))
    totals = rows.groupBy(*keys, "year").agg(
        F.coalesce(F.sum("_degrees"), F.lit(0.0)).alias("degree_days"))
    return totals if years is None else with_all_years(totals, ["degree_days"], *years, keys, 0.0)


def degree_hours(hourly: DataFrame, sums: dict[str, Column], thresholds: Sequence[int],
                 heating: bool = False, keys: Sequence[str] = KEYS) -> DataFrame:
    """Sum of the positive distances to each threshold, one row per key and threshold.

    ``sums`` names the result columns and the temperatures behind them.  All thresholds are
    summed in one pass and only the totals are turned into rows.
    """
    def total(t: Column, threshold: int) -> Column:
        distance = threshold - t if heating else t - threshold
        return F.coalesce(F.sum(F.when(distance > 0, distance)), F.lit(0.0))

    wide = hourly.groupBy(*keys).agg(F.array(*[
        F.struct(F.lit(th).alias("threshold"), *[total(t, th).alias(n) for n, t in sums.items()])
        for th in thresholds]).alias("_rows"))
    return wide.select(*keys, F.inline("_rows"))


def heating_degree_hours(hourly: DataFrame, t: str = "t_db", keys: Sequence[str] = KEYS,
                         thresholds: Sequence[int] = HEATING_HOURS) -> DataFrame:
    return degree_hours(hourly, {"degree_hours": F.col(t)}, thresholds, True, keys)


def cooling_degree_hours(hourly: DataFrame, t: str = "t_db", keys: Sequence[str] = KEYS,
                         thresholds: Sequence[int] = COOLING_HOURS) -> DataFrame:
    return degree_hours(hourly, {"degree_hours": F.col(t)}, thresholds, False, keys)


def cooling_residual(hourly: DataFrame, treated: Column, t: str = "t_db",
                     keys: Sequence[str] = KEYS,
                     thresholds: Sequence[int] = RESIDUAL_HOURS) -> DataFrame:
    """Cooling degree hours before and after passive treatment of the air."""
    return degree_hours(hourly, {"baseline": F.col(t), "residual": treated}, thresholds, False, keys)
