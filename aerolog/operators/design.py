"""Design conditions from long hourly series: values that so many hours exceed, and means coincident with them.

A value is exceeded for a share p of n hours if ``floor(n * p)`` hours come before it, from the warm end (or, with ``cold``,
from the other end). It is found exactly without sorting a series anywhere: hours are counted by bins of ``WIDTH``
first, which tells the bin of every wanted rank; then the values of these bins alone are
counted. Both counts fold within tasks, so a station is a few hundred bins, and a bin its distinct values,
however many hours there are. Missing values are no hours.

The coincident mean of another variable runs over the hours whose value is at most ``NEAR`` from the
design value. They meet it by an equi-join on the bin.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.air import dew_point, vapour_pressure, wet_bulb
from ..schemas import KEYS

WIDTH, NEAR = 1.0, 0.5
#: Shares of the hours for heating and for cooling conditions, and years of the return periods (fixed values).
HEATING, COOLING, RETURN_YEARS = (0.004, 0.01), (0.004, 0.01, 0.02), (5, 10, 20, 50)
EXTREME_WIND = (0.01, 0.025, 0.05)
EULER = 0.5772


def _bin(value: Column) -> Column:
    return F.floor(value / WIDTH)


def exceeded(hourly: DataFrame, column: str, shares: Sequence[float], keys: Sequence[str] = KEYS, cold: bool = False) -> DataFrame:
    """(keys, share, value): one row for each key that has values, and share."""
    rows = hourly.where(F.col(column).isNotNull() & ~F.isnan(column)).select(*keys, F.col(column).cast("double").alias("value"), _bin(F.col(column)).alias("bin"))

    def ordered(name: str) -> list[Column]:
        return [F.col(name) if cold else F.desc(name)]

    bins = rows.groupBy(*keys, "bin").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy(*keys).orderBy(*ordered("bin")).rowsBetween(Window.unboundedPreceding, -1)
    ranked = bins.withColumns({"before": F.coalesce(F.sum("n").over(before), F.lit(0)), "all": F.sum("n").over(Window.partitionBy(*keys))})
    rank = F.floor(F.col("all") * F.col("share"))
    wanted = ranked.withColumn("share", F.explode(F.array(*(F.lit(float(p)) for p in shares)))).where((rank >= F.col("before")) & (rank < F.col("before") + F.col("n"))).select(
        *keys, "bin", "share", (rank - F.col("before")).alias("rank"))
    values = rows.join(wanted.select(*keys, "bin").distinct(), [*keys, "bin"], "left_semi").groupBy(*keys, "bin", "value").agg(F.count(F.lit(1)).alias("n"))
    inside = Window.partitionBy(*keys, "bin").orderBy(*ordered("value")).rowsBetween(Window.unboundedPreceding, -1)
    placed = values.withColumn("before", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    return placed.join(wanted, [*keys, "bin"]).where((F.col("rank") >= F.col("before")) & (F.col("rank") < F.col("before") + F.col("n"))).select(*keys, "share", "value")


def coincident(hourly: DataFrame, column: str, design: DataFrame, others: Sequence[str], keys: Sequence[str] = KEYS) -> DataFrame:
    """``design`` (keys, share, value) with the means of ``others`` over the hours near the value."""
    near = design.withColumn("bin", F.explode(F.sequence(_bin(F.col("value") - NEAR), _bin(F.col("value") + NEAR))))
    rows = hourly.where(F.col(column).isNotNull()).select(*keys, F.col(column).cast("double").alias("_x"), _bin(F.col(column)).alias("bin"), *others)
    return rows.join(near, [*keys, "bin"]).where(F.abs(F.col("_x") - F.col("value")) <= NEAR).groupBy(*keys, "share", "value").agg(*(F.avg(c).alias(c) for c in others))


def months(hourly: DataFrame, t: str = "t_db", keys: Sequence[str] = KEYS, ts: str = "ts") -> DataFrame:
    """(keys, coldest_month, hottest_month, day_range): by mean temperature, the earlier of equal ones; the mean daily range of the hottest."""
    days = hourly.groupBy(*keys, F.col(ts).cast("date").alias("day")).agg(F.sum(t).alias("s"), F.count(t).alias("n"), (F.max(t) - F.min(t)).alias("range"))
    by = days.groupBy(*keys, F.month("day").alias("month")).agg(F.try_divide(F.sum("s"), F.sum("n")).alias("mean"), F.avg("range").alias("range"))
    mean = F.round("mean", 9)
    return by.where("mean is not null").groupBy(*keys).agg(
        F.min_by("month", F.struct(mean, "month")).alias("coldest_month"), F.max_by("month", F.struct(mean, -F.col("month"))).alias("hottest_month"),
        F.max_by("range", F.struct(mean, -F.col("month"))).alias("day_range"))


def extremes(hourly: DataFrame, t: str = "t_db", keys: Sequence[str] = KEYS, ts: str = "ts") -> DataFrame:
    """(keys, min_mean, max_mean, min_std, max_std, and return values min_5, max_5, ...) of the yearly extremes; one year has no deviation."""
    years = hourly.groupBy(*keys, F.year(ts).alias("year")).agg(F.min(t).alias("low"), F.max(t).alias("high"))
    out = years.groupBy(*keys).agg(F.avg("low").alias("min_mean"), F.avg("high").alias("max_mean"), F.stddev_samp("low").alias("min_std"), F.stddev_samp("high").alias("max_std"))
    factor = {n: -math.sqrt(6) / math.pi * (EULER + math.log(math.log(n / (n - 1)))) for n in RETURN_YEARS}
    return out.select("*", *(c for n in RETURN_YEARS for c in ((F.col("min_mean") - factor[n] * F.col("min_std")).alias(f"min_{n}"),
                                                               (F.col("max_mean") + factor[n] * F.col("max_std")).alias(f"max_{n}"))))


def enthalpy(t_db: Column, ratio: Column) -> Column:
    """kJ/kg of moist air; ``ratio`` in g/kg."""
    return 1.006 * t_db + ratio / 1000 * (2501 + 1.86 * t_db)


def humidity_ratio(t_dp: Column, hpa: float = 1013.25) -> Column:
    """g/kg of air with this dew point."""
    pressure = vapour_pressure(t_dp)
    return 621.98 * pressure / (hpa - pressure)


#: Kind, variable, coincident variable, shares, and whether from the cold end.
KINDS = (
    ("heating", "t_db", "v_air", HEATING, True), ("humidification", "t_dp", "t_db", HEATING, True), ("cooling", "t_db", "t_wb", COOLING, False),
    ("evaporation", "t_wb", "t_db", COOLING, False), ("dehumidification", "t_dp", "t_db", COOLING, False), ("enthalpy", "h", "t_db", COOLING, False),
    ("wind", "v_air", "t_db", EXTREME_WIND, False),
)


def _with_moisture(hourly: DataFrame) -> DataFrame:
    rows = hourly.withColumns({"t_wb": wet_bulb(F.col("t_db"), F.col("rh")), "t_dp": dew_point(F.col("t_db"), F.col("rh"))})
    return rows.withColumn("h", enthalpy(F.col("t_db"), humidity_ratio(F.col("t_dp"))))


def _values(rows: DataFrame, kinds: Sequence[tuple], keys: Sequence[str]) -> DataFrame:
    out = None
    for kind, column, other, shares, cold in kinds:
        found = coincident(rows, column, exceeded(rows, column, shares, keys, cold), [other], keys).select(*keys, F.lit(kind).alias("kind"), "share", "value", F.col(other).alias("mean"))
        out = found if out is None else out.unionByName(found)
    return out


def design_values(hourly: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """(keys, kind, share, value, mean): the design values of an hourly series (t_db, rh, v_air), and the mean coincident with each, by :data:`KINDS`."""
    return _values(_with_moisture(hourly), KINDS, keys)


def coldest_month_wind(hourly: DataFrame, months_: DataFrame, keys: Sequence[str] = KEYS, ts: str = "ts") -> DataFrame:
    """:func:`design_values` of the wind in the coldest month."""
    rows = hourly.join(months_.select(*keys, "coldest_month"), list(keys)).where(F.month(ts) == F.col("coldest_month"))
    return _values(rows, [("month_wind", "v_air", "t_db", HEATING, False)], keys)


def coincident_wind(hourly: DataFrame, values: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """(keys, kind, speed, direction): mean speed and most frequent direction at the heating and cooling value of 0.4 %; the lowest of equally frequent ones.

    Directions are counted before they meet, so a value's hours are never gathered.
    """
    wanted = values.where((F.col("share") == 0.004) & F.col("kind").isin("heating", "cooling")).select(*keys, "kind", "value").withColumn(
        "bin", F.explode(F.sequence(_bin(F.col("value") - NEAR), _bin(F.col("value") + NEAR))))
    rows = hourly.where("t_db is not null").withColumns({
        "bin": _bin(F.col("t_db")), "direction": F.col("wind_dir").cast("double") if "wind_dir" in hourly.columns else F.lit(None).cast("double")})
    near = rows.join(wanted, [*keys, "bin"]).where(F.abs(F.col("t_db") - F.col("value")) <= NEAR)
    by = near.groupBy(*keys, "kind", "direction").agg(F.count(F.lit(1)).alias("n"), F.sum("v_air").alias("s"), F.count("v_air").alias("k"))
    return by.groupBy(*keys, "kind").agg(F.try_divide(F.sum("s"), F.sum("k")).alias("speed"), F.max_by("direction", F.when(F.col("direction").isNotNull(), F.struct("n", -F.col("direction")))).alias("direction"))


def mild_hours(hourly: DataFrame, keys: Sequence[str] = KEYS, ts: str = "ts") -> DataFrame:
    """(keys, mild, max_wb): hours a year from 8 to 16 o'clock between 12.8 and 20.6 degrees, and the highest wet bulb."""
    mild = F.hour(ts).between(8, 15) & F.col("t_db").between(12.8, 20.6)
    return _with_moisture(hourly).groupBy(*keys).agg((F.count(F.when(mild, 1)) / F.count_distinct(F.year(ts))).alias("mild"), F.max("t_wb").alias("max_wb"))


def design_line(hourly: DataFrame, keys: Sequence[str] = KEYS, ts: str = "ts") -> DataFrame:
    """(keys, design_conditions): the header line of an hourly series, its fields in the order that weather files have; one decimal, unknown ones empty."""
    months_ = months(hourly, keys=keys, ts=ts)
    values = design_values(hourly, keys).unionByName(coldest_month_wind(hourly, months_, keys, ts))

    def name(kind: str, share: float, column: str) -> str:
        return f"{kind}_{share}_{column}".replace(".", "_")

    asked = [(kind, p) for kind, _, _, shares, _ in (*KINDS, ("month_wind", "", "", HEATING, False)) for p in shares]
    wide = values.groupBy(*keys).agg(*(F.max(F.when((F.col("kind") == kind) & (F.col("share") == p), F.col(c))).alias(name(kind, p, c)) for kind, p in asked for c in ("value", "mean")))
    wind = coincident_wind(hourly, values, keys).groupBy(*keys).agg(*(F.max(F.when(F.col("kind") == kind, F.col(c))).alias(f"{kind}_{c}") for kind in ("heating", "cooling") for c in ("speed", "direction")))
    row = wide
    for part in (months_, extremes(hourly, keys=keys, ts=ts), mild_hours(hourly, keys, ts), wind):
        row = row.join(part, list(keys), "left")

    def text(c: Column) -> Column:
        return F.coalesce(F.call_function("format_number", F.round(c, 1), F.lit("0.0")), F.lit(""))

    def value(kind: str, share: float) -> Column:
        return F.col(name(kind, share, "value"))

    def with_mean(kind: str, share: float) -> list[Column]:
        return [text(value(kind, share)), text(F.col(name(kind, share, "mean")))]

    def with_ratio(kind: str, share: float) -> list[Column]:
        return [text(value(kind, share)), text(humidity_ratio(value(kind, share))), text(F.col(name(kind, share, "mean")))]

    def whole(c: str) -> Column:
        return F.coalesce(F.round(c).cast("int").cast("string"), F.lit(""))

    fields = [
        F.lit("DESIGN CONDITIONS,1,Computed from hourly values,,Heating"), whole("coldest_month"), *(text(value("heating", p)) for p in HEATING),
        *(c for p in HEATING for c in with_ratio("humidification", p)), *(c for p in HEATING for c in with_mean("month_wind", p)), text(F.col("heating_speed")), whole("heating_direction"),
        F.lit("Cooling"), whole("hottest_month"), text(F.col("day_range")), *(c for p in COOLING for c in with_mean("cooling", p)), *(c for p in COOLING for c in with_mean("evaporation", p)),
        text(F.col("cooling_speed")), whole("cooling_direction"), *(c for p in COOLING for c in with_ratio("dehumidification", p)), *(c for p in COOLING for c in with_mean("enthalpy", p)), whole("mild"),
        F.lit("Extremes"), *(text(value("wind", p)) for p in EXTREME_WIND), text(F.col("max_wb")), *(text(F.col(c)) for c in ("min_mean", "max_mean", "min_std", "max_std")),
        *(text(F.col(f"{side}_{n}")) for n in RETURN_YEARS for side in ("min", "max")),
    ]
    return row.select(*keys, F.concat_ws(",", *fields).alias("design_conditions"))
