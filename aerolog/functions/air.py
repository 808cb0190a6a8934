"""Humid-air expressions and unit changes.

The coefficients in the expressions are fixed values of the published formulas.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

KELVIN = 273.15


def nan_to_null(value: Column) -> Column:
    """Missing readings are NULL inside Spark: NaN would sort last and poison averages."""
    return F.when(~F.isnan(value), value)


def kmh_to_ms(speed: Column) -> Column:
    return speed / 3.6


def hpa_to_pa(pressure: Column) -> Column:
    return pressure * 100


def station_pressure(p_atm: Column, p_min: Column, p_max: Column) -> Column:
    """The stored pressure, else the middle of the hour's extremes."""
    return F.coalesce(p_atm, (p_min + p_max) / 2)


def dew_point(t_db: Column, rh: Column) -> Column:
    """Dew point in °C from dry bulb (°C) and relative humidity (%); NULL where that is zero."""
    return F.when(
        rh != 0,
        1 / (1 / (t_db + KELVIN) - 1.85e-4 * F.log(rh / 100)) - KELVIN,
    )


def vapour_pressure(t_dp: Column) -> Column:
    """Vapour pressure in hPa at the dew point."""
    return 6.11 * F.exp(17.1 * t_dp / (234.2 + t_dp))


def infrared_intensity(es: Column, t_db: Column, kt_day: Column) -> Column:
    """Horizontal infrared radiation intensity (W/m²) from vapour pressure and clearness."""
    sky = 94 + 12.6 * F.log(100 * es) - 13 * kt_day + 0.341 * (t_db + KELVIN)
    return 5.67e-8 * F.pow(sky, F.lit(4.0))


def absolute_humidity(t_db: Column, rh: Column) -> Column:
    """Absolute humidity in g/m³."""
    saturation = 6.112 * F.exp(17.67 * t_db / (t_db + 243.5))
    return saturation * rh * 18.02 / ((KELVIN + t_db) * 100 * 0.08314)


def wet_bulb(t_db: Column, rh: Column) -> Column:
    """Wet-bulb temperature in °C, arctangent regression."""
    return (
        t_db * F.atan(0.151977 * F.sqrt(rh + 8.313659))
        + F.atan(t_db + rh)
        - F.atan(rh - 1.676331)
        + 0.00391838 * F.pow(rh, F.lit(1.5)) * F.atan(0.023101 * rh)
        - 4.686035
    )


def treated_air(t_db: Column, t_sink: Column, efficiency: float = 0.8) -> Column:
    """Air cooled towards a sink (soil or wet bulb) with the given efficiency."""
    return t_db - efficiency * (t_db - t_sink)
