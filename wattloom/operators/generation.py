"""Solar output of panels and hourly load of appliances."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.functions.energy import avg_consumption, panel_output
from wattloom.operators.joins import spread_join


def solar_generation(
    weather: DataFrame, panels: DataFrame, site: str = "site_id", ts: str = "timestamp",
    sample_ms: float = 5, salts: int = 8,
) -> DataFrame:
    """Output of every panel for every weather sample of its site.

    Weather has ``site, ts, solar_intensity, temp``; panels have ``site, id, capacity_kwh,
    intensity_power_rating, temperature_power_rating``. An equi-join on the site: panels are broadcast
    when they are small; else samples of a large site are spread over ``salts`` groups.
    """
    ratings = panels.select(
        F.col(site).alias("_site"), F.col("id").alias("panel_id"), "capacity_kwh",
        "intensity_power_rating", "temperature_power_rating",
    )
    joined = spread_join(weather, ratings, {site: "_site"}, "inner", spread_by=[ts], salts=salts)
    output = panel_output(
        F.col("capacity_kwh"), F.col("intensity_power_rating"), F.col("temperature_power_rating"),
        F.col("solar_intensity"), F.col("temp"), sample_ms,
    )
    inputs = ("solar_intensity", "temp", "capacity_kwh", "intensity_power_rating", "temperature_power_rating")
    return joined.withColumn("generation_power_wh", output).drop(*inputs)


def schedule_hours(appliances: DataFrame, usage: str = "usage_time") -> DataFrame:
    """One row per appliance and hour of use.

    A schedule is ``HH:MM-HH:MM`` ranges separated by commas. A range covers its start hour up to its
    end hour, which is rounded up when it has minutes. Hour 0 is dropped.
    """
    ranges = appliances.withColumn("_range", F.explode(F.split(F.col(usage), ",")))
    ranges = ranges.withColumn("_span", F.split("_range", "-")).drop("_range")
    clock = lambda i: F.split(F.trim(F.get(F.col("_span"), F.lit(i))), ":")
    part = lambda i, j: F.get(clock(i), F.lit(j)).try_cast("int")
    start = part(0, 0)
    end = part(1, 0) + F.when(part(1, 1) > 0, 1).otherwise(0)
    hours = F.when(end > start, F.sequence(start, end - 1))
    return ranges.withColumn("hour", F.explode(hours)).filter("hour > 0").drop("_span")


def appliance_hourly_load(
    appliances: DataFrame, by: list[str] | None = None, low: str = "min_consumption_power_wh",
    high: str = "max_consumption_power_wh", load_factor: float = 1.0,
) -> DataFrame:
    """Sum of rated use by hour (per home when ``by`` names it).

    ``minute`` is the time stamp within the hour: 59 for hour 23, else 0. ``load_factor`` scales both ratings.
    """
    by = by or []
    lo, hi = F.col(low) * F.lit(load_factor), F.col(high) * F.lit(load_factor)
    used = schedule_hours(appliances).select(*by, "hour", lo.alias("_lo"), hi.alias("_hi"))
    return used.groupBy(*by, "hour").agg(
        F.sum("_lo").alias("min_consumption_wh"), F.sum("_hi").alias("max_consumption_wh"),
        F.sum(avg_consumption(F.col("_lo"), F.col("_hi"))).alias("avg_consumption_wh"),
    ).withColumn("minute", F.when(F.col("hour") == 23, 59).otherwise(0))


def repartition_by_interval(df: DataFrame, n: int | None = None, interval: str = "interval_15m") -> DataFrame:
    """Deal rows out by quarter-hour index, with a row hash so that a full interval is not one task."""
    spot = F.pmod(F.xxhash64(*df.columns), F.lit(8))
    return df.repartition(n, interval, spot) if n else df.repartition(interval, spot)
