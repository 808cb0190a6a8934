"""Solar columns of a dense hourly series.

The previous and next hour and the daily sums are windows that all cluster on the series key, so
one shuffle by station serves them together (a station holds 8,784 rows a year).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import sun as S
from ..functions.air import dew_point, infrared_intensity, vapour_pressure
from ..functions.calendar import hour_index, utc_offset_hours
from ..schemas import KEYS


def clock_of(ts: Column, offset: Column, clock: str, label: str = "end") -> Column:
    """The clock that day and hour are read from: the beginning of the hour that ``ts`` labels.

    ``"local"`` moves the instant to local time, ``"as_stored"`` reads the stored UTC hour together
    with the offset. ``label`` tells whether ``ts`` is the end or the start of its hour.
    """
    if label not in ("end", "start"):
        raise ValueError(f"label must be 'end' or 'start', not {label!r}")
    begin = ts - F.expr("INTERVAL 1 HOUR") if label == "end" else ts
    if clock == "as_stored":
        return begin
    if clock == "local":
        return begin + F.make_dt_interval(mins=F.round(offset * 60).cast("int"))
    raise ValueError(f"clock must be 'as_stored' or 'local', not {clock!r}")


def with_sun(series: DataFrame, offset: Column | None = None, ts: str = "ts",
             clock: str = "local", label: str = "end") -> DataFrame:
    """Add ``sun`` (see :func:`functions.sun.solar_position`), ``g0``, ``kt`` and ``_date``.

    Needs ``lat``, ``lon``, ``ghi`` and, unless ``offset`` is given, the IANA zone in ``tz``.
    """
    offset = utc_offset_hours(F.col(ts), F.col("tz")) if offset is None else offset
    rows = series.withColumn("_offset", offset.cast("double"))
    rows = rows.withColumn("_clock", clock_of(F.col(ts), F.col("_offset"), clock, label))
    # One step per quantity that is used more than once, so that each is computed once per row.
    rows = rows.withColumns({
        "_angle": S.orbit_angle(F.col("_clock"), F.col("lon")),
        "_b": S.season_angle(F.col("_clock")),
    })
    rows = rows.withColumns({
        "_decl": S.declination(F.col("_angle")),
        "_time": S.solar_time(F.col("_clock"), F.col("_b"), F.col("lon"), F.col("_offset")),
    })
    rows = rows.withColumn(
        "_altitude", F.asin(S.sine_of_altitude(F.col("lat"), F.col("_decl"), F.col("_time"))))
    rows = rows.withColumn("g0", S.extraterrestrial(F.col("_clock"), F.col("_altitude")))
    rows = rows.withColumn("sun", F.struct(
        F.col("_time").alias("solar_time"), F.col("_decl").alias("declination"),
        F.col("_altitude").alias("altitude"), "g0"))
    return rows.withColumns({
        "kt": S.clearness(F.col("ghi"), F.col("sun")),
        "_date": F.col("_clock").cast("date"),
    }).drop("_offset", "_clock", "_angle", "_b", "_decl", "_time", "_altitude")


def daily_clearness(with_sun_rows: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Sum of global over sum of extraterrestrial radiation per day."""
    return with_sun_rows.groupBy(*keys, F.col("_date").alias("day")).agg(
        F.try_divide(F.coalesce(F.sum("ghi"), F.lit(0.0)), F.sum("g0")).alias("kt_d"))


def split(series: DataFrame, keys: Sequence[str] = KEYS, ts: str = "ts",
          offset: Column | None = None, clock: str = "local", label: str = "end") -> DataFrame:
    """Add ``g0``, ``kt``, ``kt_d``, ``dif`` and ``dni``; first and last hour of a series get no split."""
    in_order = Window.partitionBy(*keys).orderBy("_date", hour_index(F.col(ts)))
    of_day = Window.partitionBy(*keys, "_date")
    # Neighbours first: their order (day, hour) then serves the daily sums without another sort.
    rows = with_sun(series, offset, ts, clock, label).withColumns({
        "_before": F.lag("kt").over(in_order),
        "_after": F.lead("kt").over(in_order),
        "_first": F.lag(F.lit(1)).over(in_order).isNull(),
        "_last": F.lead(F.lit(1)).over(in_order).isNull(),
    })
    rows = rows.withColumn("kt_d", F.try_divide(
        F.coalesce(F.sum("ghi").over(of_day), F.lit(0.0)), F.sum("g0").over(of_day)))
    both = S.split_radiation(
        F.col("ghi"), F.col("kt"), F.col("kt_d"),
        S.persistence(F.col("_before"), F.col("kt"), F.col("_after")), F.col("sun"))
    rows = rows.withColumn("_split", F.when(~F.col("_first") & ~F.col("_last"), both))
    return rows.withColumns({"dif": F.col("_split.dif"), "dni": F.col("_split.dni")}).drop(
        "sun", "_date", "_before", "_after", "_first", "_last", "_split")


def with_infrared(series: DataFrame) -> DataFrame:
    """Add ``t_dp`` where missing, ``es`` and ``hiri`` (needs ``t_db``, ``rh`` and ``kt_d``)."""
    rows = series.withColumn(
        "t_dp", F.coalesce(F.col("t_dp"), dew_point(F.col("t_db"), F.col("rh")))
        if "t_dp" in series.columns else dew_point(F.col("t_db"), F.col("rh")))
    rows = rows.withColumn("es", vapour_pressure(F.col("t_dp")))
    return rows.withColumn(
        "hiri", infrared_intensity(F.col("es"), F.col("t_db"), F.col("kt_d")))
