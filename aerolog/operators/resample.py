"""Resampling to hours, days, months and years.

Everything here is a two-phase aggregate: each task first folds its own points, so what is
shuffled is at most one row per task and group however many points a station sends.  Past this
step a station holds at most one row per hour, 8,784 a year, which is what bounds the groups of
the window functions in the other modules.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.calendar import hour_end, hour_start
from ..schemas import FIELDS, KEYS


def _hour(ts: str, label: str) -> Column:
    if label not in ("end", "start"):
        raise ValueError(f"label must be 'end' or 'start', not {label!r}")
    return hour_end(F.col(ts)) if label == "end" else hour_start(F.col(ts))


def hourly_mean(points: DataFrame, keys: Sequence[str] = KEYS, label: str = "end",
                out: str = "hour") -> DataFrame:
    """Mean per series, field and hour; hours without points are absent."""
    return (
        points.select(*keys, "field", _hour("ts", label).alias(out), "value")
        .groupBy(*keys, "field", out).agg(F.avg("value").alias("value"))
    )


def hourly_wide(points: DataFrame, fields: Sequence[str] = FIELDS, keys: Sequence[str] = KEYS,
                label: str = "end", out: str = "ts") -> DataFrame:
    """Hourly means with one column per field: resampling and pivot in one shuffle."""
    return (
        points.where(F.col("field").isin(list(fields)))
        .select(*keys, "field", _hour("ts", label).alias(out), "value")
        .groupBy(*keys, out)
        .agg(*[F.avg(F.when(F.col("field") == f, F.col("value"))).alias(f) for f in fields])
    )


def hourly_multi_agg(points: DataFrame, mean: Sequence[str] = (), total: Sequence[str] = (),
                     mode: Sequence[str] = (), mode_nonzero: Sequence[str] = (),
                     keys: Sequence[str] = KEYS, label: str = "start",
                     out: str = "ts", found: str | None = None) -> DataFrame:
    """Different aggregates per field over the hour, in two aggregations.

    ``found`` is a part of a name: all other fields that have it, in any case, are averaged too,
    whatever they are called and however many a station sends, into the map ``others`` by field.

    The first counts and sums per value (of the fields whose mode is wanted), the second picks
    the mode among the counted values; no task ever holds the values of a whole hour.
    """
    modal = [*mode, *mode_nonzero]
    wanted = [*mean, *total, *modal]
    field, value = F.col("field"), F.col("_value")
    other = F.lit(False) if found is None else F.lower(field).contains(found.lower()) & ~field.isin(wanted)
    counted = (
        points.where(field.isin(wanted) | other)
        .select(*keys, "field", _hour("ts", label).alias(out), "value",
                (F.when(field.isin(modal), F.col("value")) if modal
                 else F.lit(None).cast("double")).alias("_value"))
        .groupBy(*keys, out, "field", "_value")
        .agg(F.sum("value").alias("_sum"), F.count("value").alias("_n"))
    )

    def of(f: str, column: str) -> Column:
        return F.sum(F.when(field == f, F.col(column)))

    def top(f: str, condition: Column) -> Column:
        return F.max_by("_value", F.when((field == f) & condition, F.struct("_n", -value)))

    # such a field has one row by now, its value not being counted
    others = [] if found is None else [F.map_from_entries(F.collect_list(F.when(other, F.struct("field", F.try_divide("_sum", "_n"))))).alias("others")]
    return counted.groupBy(*keys, out).agg(
        *[F.try_divide(of(f, "_sum"), of(f, "_n")).alias(f) for f in mean],
        *[F.coalesce(of(f, "_sum"), F.lit(0.0)).alias(f) for f in total],
        *[top(f, value.isNotNull()).alias(f) for f in mode],
        *[F.coalesce(top(f, value != 0), F.lit(0.0)).alias(f) for f in mode_nonzero],
        *others,
    )


def daily_mean(hourly: DataFrame, columns: Sequence[str], keys: Sequence[str] = KEYS,
               ts: str = "ts", out: str = "day") -> DataFrame:
    """Daily means; fed with hourly means, so that hours weigh equally."""
    return hourly.groupBy(*keys, F.col(ts).cast("date").alias(out)).agg(
        *[F.avg(c).alias(c) for c in columns])


def monthly_mean(series: DataFrame, columns: Sequence[str], keys: Sequence[str] = KEYS,
                 ts: str = "ts") -> DataFrame:
    """Means per calendar month of each year."""
    return series.groupBy(*keys, F.year(ts).alias("year"), F.month(ts).alias("month")).agg(
        *[F.avg(c).alias(c) for c in columns])


def with_all_years(totals: DataFrame, columns: Sequence[str], first: int, last: int,
                   keys: Sequence[str] = KEYS, missing: float | None = None) -> DataFrame:
    """A row for every year from ``first`` to ``last``, from one row per key and existing year.

    Works on the totals (a few rows per key), so the series behind them is not read again to
    find the keys.
    """
    packed = totals.groupBy(*keys).agg(F.map_from_entries(F.collect_list(
        F.struct("year", F.struct(*columns)))).alias("_of"))
    rows = packed.select(*keys, "_of", F.explode(F.sequence(F.lit(first), F.lit(last))).alias("year"))
    found = F.try_element_at("_of", F.col("year"))
    return rows.select(*keys, "year", *[
        F.coalesce(found[c], F.lit(missing).cast("double")).alias(c) for c in columns])


def yearly_mean(series: DataFrame, columns: Sequence[str], keys: Sequence[str] = KEYS,
                ts: str = "ts", years: tuple[int, int] | None = None) -> DataFrame:
    """Means per year; with ``years``, only these, and a missing one is a row of NULLs."""
    rows = series.select(*keys, F.year(ts).alias("year"), *columns)
    if years is not None:
        rows = rows.where(F.col("year").between(*years))
    means = rows.groupBy(*keys, "year").agg(*[F.avg(c).alias(c) for c in columns])
    return means if years is None else with_all_years(means, columns, *years, keys)


def mode_by_group(df: DataFrame, column: str, keys: Sequence[str]) -> DataFrame:
    """``mode_std`` (smallest on ties) and ``mode_zero`` (zero only if nothing else) per group.

    Values are counted first, so a group's values are never gathered in one place.
    """
    value = F.col(column)
    counts = df.where(value.isNotNull()).groupBy(*keys, column).agg(F.count(F.lit(1)).alias("_n"))
    rank = F.struct("_n", -value)
    return counts.groupBy(*keys).agg(
        F.max_by(value, rank).alias("mode_std"),
        F.coalesce(F.max_by(value, F.when(value != 0, rank)), F.lit(0.0)).alias("mode_zero"),
    )


def station_day_map(points: DataFrame, field: str = "t_db",
                    keys: Sequence[str] = KEYS) -> DataFrame:
    """Daily mean of one field per station, shown with one decimal (the data of the heat map).

    The inner rounding takes off the noise of summation order before the half-way cases.
    """
    return (
        points.where(F.col("field") == field)
        .groupBy(*keys, F.col("ts").cast("date").alias("day"))
        .agg(F.round(F.round(F.avg("value"), 9), 1).alias("mean"))
    )


def days_present(points: DataFrame, ts: str = "ts") -> DataFrame:
    """The distinct days that hold data."""
    return points.select(F.col(ts).cast("date").alias("day")).distinct()
