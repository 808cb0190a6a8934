"""Completing hourly series.

The dense spine is never joined or shuffled: windows run over the rows that exist, and the
missing hours are generated from each row's distance to its successor.  Input series hold one row
per key and hour (see :mod:`resample`), so a group is bounded by the calendar.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.calendar import hour_index
from ..schemas import KEYS


def fill_same_hour(series: DataFrame, columns: Sequence[str], start: Column, stop: Column,
                   keys: Sequence[str] = KEYS, ts: str = "ts",
                   stations: DataFrame | None = None) -> DataFrame:
    """Dense hourly series from ``start`` to ``stop`` (both included).

    A gap takes the last earlier value of the same hour of day, before the first value the first
    one.  ``stations`` lists the keys to produce; by default those that have rows in the range.
    """
    inside = series.where(F.col(ts).between(start, stop)).select(*keys, ts, *columns)
    if stations is None:
        stations = inside.select(*keys).distinct()
    # One empty row at each of the first 24 hours opens the chain of that hour of day.
    anchors = stations.select(*keys, F.explode(F.sequence(F.lit(0), F.lit(23))).alias("_h")).select(
        *keys, (start + F.make_dt_interval(hours=F.col("_h"))).alias(ts), F.lit(0).alias("_real"))
    rows = (
        inside.withColumn("_real", F.lit(1))
        .unionByName(anchors, allowMissingColumns=True)
        .withColumns({"_hour": F.hour(ts), "_i": hour_index(F.col(ts))})
    )
    chain = Window.partitionBy(*keys, "_hour").orderBy("_i", "_real")
    so_far = chain.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = chain.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    following = F.coalesce(
        F.lead("_i").over(chain),
        # one step past the last slot of this hour of day
        F.col("_i") + (F.floor((hour_index(stop) - F.col("_i")) / 24) + 1) * 24,
    )
    filled = rows.select(
        *keys, ts,
        *[F.coalesce(F.last(c, ignorenulls=True).over(so_far),
                     F.first(c, ignorenulls=True).over(whole)).alias(c) for c in columns],
        ((following - F.col("_i")) / 24).cast("int").alias("_days"),
    )
    return (
        filled.where("_days > 0")
        .withColumn("_d", F.explode(F.sequence(F.lit(0), F.col("_days") - 1)))
        .select(*keys, (F.col(ts) + F.make_dt_interval(days=F.col("_d"))).alias(ts), *columns)
    )


def fill_window_mean(series: DataFrame, column: str, keys: Sequence[str] = KEYS, ts: str = "ts",
                     hours: int = 72) -> DataFrame:
    """Fill gaps with the mean of the same hour of day within ``hours`` before and after.

    Only measured values enter the mean.
    """
    near = (
        Window.partitionBy(*keys, F.hour(ts)).orderBy(hour_index(F.col(ts)))
        .rangeBetween(-hours, hours)
    )
    return series.withColumn(column, F.coalesce(F.col(column), F.avg(column).over(near)))


def interpolate(series: DataFrame, columns: Sequence[str], position: Column,
                keys: Sequence[str] = KEYS) -> DataFrame:
    """Linear interpolation between the neighbouring values of a regular series.

    ``position`` is an integer that grows by one per row (hour or day index).  Leading gaps stay
    NULL, trailing gaps repeat the last value.
    """
    backward = Window.partitionBy(*keys).orderBy("_i").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    # Descending order instead of a frame that reaches forward: those are quadratic.
    forward = Window.partitionBy(*keys).orderBy(F.col("_i").desc()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)

    def known(c: str) -> Column:
        return F.when(F.col(c).isNotNull(), F.struct(F.col("_i").alias("i"), F.col(c).alias("v")))

    rows = series.withColumn("_i", position)
    rows = rows.withColumns({
        f"_p_{c}": F.last(known(c), ignorenulls=True).over(backward) for c in columns})
    rows = rows.withColumns({
        f"_n_{c}": F.last(known(c), ignorenulls=True).over(forward) for c in columns})

    def value(c: str) -> Column:
        before, after = F.col(f"_p_{c}"), F.col(f"_n_{c}")
        share = (F.col("_i") - before["i"]) / (after["i"] - before["i"])
        return (F.when(F.col(c).isNotNull(), F.col(c))
                .when(after.isNull(), before["v"])
                .otherwise(before["v"] + (after["v"] - before["v"]) * share))

    return rows.select(*[value(c).alias(c) if c in columns else F.col(c) for c in series.columns])
