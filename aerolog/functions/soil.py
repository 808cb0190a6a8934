"""Soil temperature at depth."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

#: Thermal diffusivity in m²/s (fixed values).
DIFFUSIVITY = {
    "wet_clay": 6.177e-7,
    "dry_clay": 4.891e-7,
    "limestone": 1.907e-7,
    "sand": 4.944e-7,
}
YEAR_SECONDS = 365 * 24 * 3600


def soil_temperature(mean: Column, amplitude: Column, phase: Column, t: Column,
                     depth: Column, diffusivity: Column, period: float) -> Column:
    """Damped, delayed annual wave.

    ``period`` is the year in the unit of ``t`` and ``phase`` (365 days or 8760 hours), and
    ``diffusivity`` is in m² per that same unit.
    """
    damping = F.exp(-depth * F.sqrt(math.pi / (period * diffusivity)))
    delay = (depth / 2) * F.sqrt(period / (math.pi * diffusivity))
    return mean - amplitude * damping * F.cos((2 * math.pi / period) * (t - phase - delay))


def soil_temperature_hadvig(mean: Column, amplitude: Column, warmest: Column, t: Column,
                            depth: Column, diffusivity: Column) -> Column:
    """The alternative soil model; ``t`` and ``warmest`` in seconds, diffusivity in m²/s."""
    damping = F.exp(-depth * F.sqrt(math.pi / (diffusivity * YEAR_SECONDS)))
    wave = F.cos((2 * math.pi / YEAR_SECONDS) * (t - warmest)
                 - depth * math.sqrt(math.pi / YEAR_SECONDS))
    return mean + amplitude * damping * wave
