"""Solar geometry and the split of global radiation, as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

#: Solar constant in W/m² and cap of the clearness index (fixed values).
SOLAR_CONSTANT = 1366.0
MAX_CLEARNESS = 0.8

# The numbers below, and those in the expressions for orbit, equation of time and distance, are
# fixed values of the published models.

#: Declination series: constant, then (sine, cosine) weights of the first three harmonics.
DECLINATION = (0.0064979, ((0.405906, -0.0132296), (0.0020054, 0.0063809), (-0.002988, 0.0003508)))

#: Boland-Ridley-Lauret weights: constant, clearness, solar time, altitude, day clearness, persistence.
BRL = (-5.38, 6.63, 0.006, -0.007, 1.75, 1.31)


def orbit_angle(clock: Column, lon: Column) -> Column:
    """Angle of the Earth on its orbit."""
    years = F.year(clock) - 1957
    shift = (-0.5 - F.radians(lon) / (2 * math.pi)
             - (78.8946 + 0.2422 * years - (years / 4).cast("int")))
    return (2 * math.pi / 365.2422) * (F.dayofyear(clock) + shift)


def declination(angle: Column) -> Column:
    constant, harmonics = DECLINATION
    series = F.lit(constant)
    for n, (sine, cosine) in enumerate(harmonics, start=1):
        series = series + sine * F.sin(n * angle) + cosine * F.cos(n * angle)
    return series


def season_angle(clock: Column) -> Column:
    """The argument of the equation of time."""
    return F.radians(360 * (F.dayofyear(clock) - 81) / 365)


def solar_time(clock: Column, b: Column, lon: Column, utc_offset: Column) -> Column:
    """Solar time in hours at the middle of the hour; ``b`` is the :func:`season_angle`."""
    equation_of_time = 9.87 * F.sin(2 * b) - 7.53 * F.cos(b) - 1.5 * F.sin(b)
    return F.hour(clock) + (equation_of_time + 4 * (lon - utc_offset * 15)) / 60 + 0.5


def sine_of_altitude(lat: Column, decl: Column, time: Column) -> Column:
    lat_r = F.radians(lat)
    return (F.sin(lat_r) * F.sin(decl)
            + F.cos(lat_r) * F.cos(decl) * F.cos(F.radians((time - 12) * 15)))


def extraterrestrial(clock: Column, altitude: Column) -> Column:
    """Horizontal radiation outside the atmosphere in W/m², zero at night."""
    distance = 1 + 0.0334 * F.cos(F.dayofyear(clock) * (2 * math.pi / 365.25) - 0.048869)
    return F.when(altitude >= 0, SOLAR_CONSTANT * distance * F.sin(altitude)).otherwise(F.lit(0.0))


def solar_position(clock: Column, lat: Column, lon: Column, utc_offset: Column) -> Column:
    """Struct ``(solar_time, declination, altitude, g0)`` at the middle of the hour of ``clock``.

    ``lat`` and ``lon`` in degrees, ``utc_offset`` in hours for the zone ``clock`` is read in,
    angles in radians, ``g0`` (extraterrestrial horizontal radiation) in W/m².
    """
    decl = declination(orbit_angle(clock, lon))
    time = solar_time(clock, season_angle(clock), lon, utc_offset)
    altitude = F.asin(sine_of_altitude(lat, decl, time))
    return F.struct(
        time.alias("solar_time"),
        decl.alias("declination"),
        altitude.alias("altitude"),
        extraterrestrial(clock, altitude).alias("g0"),
    )


def clearness(ghi: Column, sun: Column) -> Column:
    """Hourly clearness index, at most 0.8 and zero at night."""
    ratio = F.try_divide(ghi, sun["g0"])
    return F.when(sun["altitude"] < 0, F.lit(0.0)).otherwise(
        F.when(ratio > MAX_CLEARNESS, F.lit(MAX_CLEARNESS)).otherwise(ratio))


def persistence(before: Column, now: Column, after: Column) -> Column:
    """Clearness of the neighbouring hours: next at sunrise, previous at sunset, else their mean."""
    return (
        F.when((before == 0) & (now != 0) & (after != 0), after)
        .when((before != 0) & (now != 0) & (after == 0), before)
        .otherwise((before + after) / 2)
    )


def diffuse_share(kt: Column, kt_day: Column, psi: Column, sun: Column) -> Column:
    """Boland-Ridley-Lauret diffuse fraction."""
    c0, c_kt, c_time, c_altitude, c_day, c_psi = BRL
    z = (c0 + c_kt * kt + c_time * sun["solar_time"] + c_altitude * F.degrees(sun["altitude"])
         + c_day * kt_day + c_psi * psi)
    return 1 / (1 + F.exp(z))


def clamp(value: Column, low: float, high: float) -> Column:
    """NULL stays NULL (``least``/``greatest`` would skip it)."""
    return F.when(value < low, F.lit(low)).when(value > high, F.lit(high)).otherwise(value)


def direct_normal(ghi: Column, dif: Column, sun: Column) -> Column:
    """Direct normal radiation from global and diffuse, zero at night, not clamped."""
    return F.when(sun["altitude"] >= 0,
                  F.try_divide(ghi - dif, F.sin(sun["altitude"]))).otherwise(F.lit(0.0))


def split_radiation(ghi: Column, kt: Column, kt_day: Column, psi: Column, sun: Column) -> Column:
    """Struct ``(dif, dni)``; zero global radiation gives zero for both."""
    dif = ghi * diffuse_share(kt, kt_day, psi, sun)
    beam = F.try_divide(ghi - dif, F.sin(sun["altitude"]))
    dark = ghi == 0
    return F.struct(
        F.when(dark, F.lit(0.0)).otherwise(dif).alias("dif"),
        F.when(dark, F.lit(0.0)).otherwise(clamp(beam, 0.0, SOLAR_CONSTANT)).alias("dni"),
    )
