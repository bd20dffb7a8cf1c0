"""Unit scaling and the panel output formula."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MS_PER_HOUR = 60 * 60 * 1000


def to_sample_energy(watts: Column, sample_ms: float = 5) -> Column:
    """Watt-hours that a constant ``watts`` gives during one sample."""
    return watts.cast("double") / F.lit(MS_PER_HOUR / sample_ms)


def watts_to_wh(watts: Column, sample_seconds: float | None) -> Column:
    """Watt-hours per sample of ``sample_seconds``; the value as it is when None."""
    return watts if sample_seconds is None else to_sample_energy(watts, sample_seconds * 1000)


def panel_output(
    capacity_kwh: Column, rated_intensity: Column, rated_temp: Column,
    intensity: Column, temp: Column, sample_ms: float = 5,
) -> Column:
    """Watt-hours of a panel in one sample.

    Rated energy per sample, times measured over rated intensity, times rated over measured
    temperature. A temperature (or rated intensity) of zero gives NULL, not an error.
    """
    rated_energy = to_sample_energy(capacity_kwh.cast("double") * 1000, sample_ms)
    light = F.try_divide(intensity.cast("double"), rated_intensity.cast("double"))
    heat = F.try_divide(rated_temp.cast("double"), temp.cast("double"))
    return rated_energy * heat * light


def avg_consumption(low: Column, high: Column) -> Column:
    return (low + high) / 2
