"""Soil temperatures: climate parameters, profiles, passive cooling, header line."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import soil as soil_fn
from ..functions.air import treated_air, wet_bulb
from ..functions.calendar import day_of_year0, hour_index
from ..schemas import KEYS
from .degree import RESIDUAL_HOURS, cooling_residual
from .resample import monthly_mean

#: Depths of the profile in m, of the daily curves in m, and of the four measured layers (fixed values).
PROFILE_DEPTHS = (0.5, 1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0, 8.0, 9.0, 10.0)
DAILY_DEPTHS = (1, 2, 3, 4, 5, 6)
LAYERS = (("soil_t_0_7", "0.04"), ("soil_t_7_28", "0.18"),
          ("soil_t_28_100", "0.64"), ("soil_t_100_255", "1.77"))
#: Zero-based day of the year of the 15th of each month (fixed values, common year).
MID_MONTH = (14, 45, 73, 104, 134, 165, 195, 226, 257, 287, 318, 348)
CURVE_DEPTHS = tuple(0.5 + 9.5 * i / 99 for i in range(100))


def phase_day(coldest: Column) -> Column:
    """Day of least radiation plus 46 days, inside the year."""
    later = coldest + 46
    return F.when(later <= 364, later).otherwise(later - 365)


def soil_parameters(series: DataFrame, keys: Sequence[str] = KEYS, ts: str = "ts",
                    phase: str = "daily_min", warmest: bool = False, light: str = "ghi") -> DataFrame:
    """``amplitude``, ``mean_t`` and ``phase_day`` of a one-year series per key.

    ``phase="daily_min"`` looks for the day with the least mean radiation, ``"hourly_min"`` for
    the first hour with the least.  Group by the year too if the series has several.  With
    ``warmest``, also the zero-based hour of the year with the highest temperature (the phase of
    the alternative soil model). ``light`` is the radiation that the phase follows; sources without
    global radiation name another.
    """
    if phase not in ("daily_min", "hourly_min"):
        raise ValueError(f"unknown phase {phase!r}")
    slot = F.col(ts).cast("date") if phase == "daily_min" else F.col(ts)
    # sums per slot first, so that the monthly and yearly means stay those of the rows
    slots = series.groupBy(*keys, slot.alias("_slot")).agg(
        F.avg(light).alias("_ghi"), F.sum("t_db").alias("_sum"), F.count("t_db").alias("_n"))
    month = F.month("_slot")

    def month_mean(m: int) -> Column:
        return F.try_divide(F.sum(F.when(month == m, F.col("_sum"))),
                            F.sum(F.when(month == m, F.col("_n"))))

    parameters = slots.groupBy(*keys).agg(
        (0.5 * (month_mean(7) - month_mean(1)) + 1.1).alias("amplitude"),
        (F.try_divide(F.sum("_sum"), F.sum("_n")) + 1.7).alias("mean_t"),
        phase_day(F.min_by(day_of_year0(F.col("_slot")), F.when(
            F.col("_ghi").isNotNull(), F.struct(F.round("_ghi", 9), F.col("_slot"))))).alias("phase_day"),
    )
    if not warmest:
        return parameters
    d = F.col(ts).cast("date")
    dated = series.schema[ts].dataType.typeName() == "date"
    hour = day_of_year0(d) * 24 + (F.lit(0) if dated else F.hour(ts))
    hottest = series.groupBy(*keys).agg(F.max_by(hour, F.when(
        F.col("t_db").isNotNull(), F.struct(F.col("t_db"), -hour))).alias("warmest"))
    return parameters.join(hottest, list(keys))


def soil_profile(parameters: DataFrame, keys: Sequence[str] = KEYS, model: str = "labs",
                 depths: Sequence[float] = PROFILE_DEPTHS) -> DataFrame:
    """Mid-month temperature per soil and depth, from the parameters of each key.

    Each parameter row is expanded through literal arrays (4 soils x 12 months x depths).
    """
    soils = F.array(*[F.struct(F.lit(n).alias("soil"), F.lit(a).alias("alpha"))
                      for n, a in soil_fn.DIFFUSIVITY.items()])
    months = F.array(*[F.struct(F.lit(m).alias("month"), F.lit(d).alias("day"))
                       for m, d in enumerate(MID_MONTH, start=1)])
    rows = parameters.select("*", F.inline(soils)).select("*", F.inline(months)).select(
        "*", F.explode(F.array(*[F.lit(float(d)) for d in depths])).alias("depth"))
    if model == "labs":
        t = soil_fn.soil_temperature(F.col("mean_t"), F.col("amplitude"), F.col("phase_day"),
                                     F.col("day"), F.col("depth"), F.col("alpha") * 86400, 365.0)
    elif model == "hadvig":
        t = soil_fn.soil_temperature_hadvig(
            F.col("mean_t"), F.col("amplitude"), F.col("warmest") * 3600.0,
            F.col("day") * 86400.0 + 43200.0, F.col("depth"), F.col("alpha"))
    else:
        raise ValueError(f"unknown model {model!r}")
    return rows.select(*keys, "soil", "month", "depth", t.alias("t_soil"))


def soil_daily(daily: DataFrame, parameters: DataFrame, keys: Sequence[str] = KEYS,
               day: str = "day", t: str = "t_db", depths: Sequence[int] = DAILY_DEPTHS,
               diffusivity: float = soil_fn.DIFFUSIVITY["wet_clay"]) -> DataFrame:
    """Soil temperature at each depth next to the air temperature, per day."""
    rows = daily.select(*keys, day, F.col(t).alias("t_air")).join(parameters, list(keys), "left")
    rows = rows.withColumn("depth", F.explode(F.array(*[F.lit(d) for d in depths])))
    return rows.select(*keys, day, "depth", "t_air", soil_fn.soil_temperature(
        F.col("mean_t"), F.col("amplitude"), F.col("phase_day"), day_of_year0(F.col(day)),
        F.col("depth"), F.lit(diffusivity * 86400), 365.0).alias("t_soil"))


def residual_exchanger(hourly: DataFrame, parameters: DataFrame, keys: Sequence[str] = KEYS,
                       ts: str = "ts", t: str = "t_db", depth: float = 2.5,
                       diffusivity: float = soil_fn.DIFFUSIVITY["wet_clay"],
                       efficiency: float = 0.8,
                       thresholds: Sequence[int] = RESIDUAL_HOURS) -> DataFrame:
    """Cooling degree hours before and after an earth-to-air heat exchanger."""
    hours = hour_index(F.col(ts)) - hour_index(F.trunc(F.col(ts).cast("date"), "year").cast("timestamp_ntz"))
    rows = hourly.select(*keys, ts, t).join(parameters, list(keys), "left")
    soil = soil_fn.soil_temperature(
        F.col("mean_t"), F.col("amplitude"), F.col("phase_day") * 24, hours,
        F.lit(depth), F.lit(diffusivity * 3600), 8760.0)
    return cooling_residual(rows, treated_air(F.col(t), soil, efficiency), t, keys, thresholds)


def residual_evaporative(hourly: DataFrame, keys: Sequence[str] = KEYS, t: str = "t_db",
                         rh: str = "rh", efficiency: float = 0.8,
                         thresholds: Sequence[int] = RESIDUAL_HOURS) -> DataFrame:
    """Cooling degree hours before and after a downdraught evaporative tower."""
    treated = treated_air(F.col(t), wet_bulb(F.col(t), F.col(rh)), efficiency)
    return cooling_residual(hourly, treated, t, keys, thresholds)


def ground_line(series: DataFrame, keys: Sequence[str] = KEYS, ts: str = "ts",
                layers: Sequence[tuple[str, str]] = LAYERS) -> DataFrame:
    """The ``GROUND TEMPERATURES`` header line per station and year.

    Monthly means of every layer; the array per group has at most twelve entries.
    """
    names = [c for c, _ in layers]
    months = monthly_mean(series, names, keys, ts)
    packed = months.groupBy(*keys, "year").agg(F.array_sort(F.collect_list(
        F.struct("month", *[F.round(c, 2).alias(c) for c in names]))).alias("_m"))

    def part(column: str, depth: str) -> Column:
        values = F.transform("_m", lambda m: F.coalesce(m[column].cast("string"), F.lit("nan")))
        return F.concat_ws(",", F.lit(f"{depth},,,"), values)

    return packed.select(*keys, "year", F.concat_ws(
        ",", F.lit(f"GROUND TEMPERATURES,{len(layers)}"),
        *[part(c, d) for c, d in layers]).alias("line"))
