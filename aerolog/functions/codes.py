"""Weather codes and wind sectors."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, functions as F

#: Present-weather code by rain type (fixed values).
PRESENT_WEATHER = {
    51: 993999999,
    52: 994999999,
    53: 995999999,
    61: 909999999,
    62: 919999999,
    63: 929999999,
    67: 909099999,
    68: 919199999,
    70: 999099999,
    71: 999099999,
    72: 999199999,
    73: 999299999,
    74: 999699999,
    89: 999994999,
}
NO_WEATHER = 999999999


def rain_type(total: Column, rate: Column | None = None) -> Column:
    """Rain type from the hourly total and, where known, the rate in mm/h."""
    dry = F.when(total == 0, 40)
    if rate is None:
        return dry.otherwise(61)
    return dry.when(rate < 0.5, 51).when(rate <= 1.0, 53).when(rate <= 2.5, 61).otherwise(63)


def present_weather(total: Column, kind: Column) -> Column:
    """9 when dry, else 0."""
    return F.when((kind == 40) | (total == 0), 9).otherwise(0)


def present_weather_code(observation: Column, kind: Column) -> Column:
    """Nine-digit code: by rain type where listed, else by the observation."""
    table = F.create_map(*[F.lit(x).cast("bigint") for x in chain(*PRESENT_WEATHER.items())])
    return F.coalesce(
        F.try_element_at(table, kind.cast("bigint")),
        F.when(observation == 9, F.lit(NO_WEATHER).cast("bigint")).otherwise(
            observation.cast("bigint")),
    )


def wind_sector(direction: Column) -> Column:
    """Nearest of eight 45° sectors; directions from 337.5° give 360, not 0."""
    return F.floor((direction + 22.5) / 45) * 45
