"""High-frequency input series from climate files and appliance schedules."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattloom.functions.energy import to_sample_energy
from wattloom.operators.generation import appliance_hourly_load
from wattloom.operators.resample import expand_minutes, upsample_linear
from wattloom.sources.catalogues import read_appliances
from wattloom.sources.climate import parse_clm, rejected_clm_lines
from wattloom.sources.readings import source_path

STEP_US = 5000
WEATHER = ["solar_intensity", "temp"]
LOAD = ["min_consumption_wh", "max_consumption_wh", "avg_consumption_wh"]


def _at(date: str, hour: str, minute: str):
    day_us = F.unix_micros(F.col(date).cast("timestamp"))
    return F.timestamp_micros(day_us + (F.col(hour) * 60 + F.col(minute)).cast("bigint") * F.lit(60_000_000))


def weather_series(hourly: DataFrame, step_us: int = STEP_US) -> DataFrame:
    """Hourly climate rows to minutes, then to the sample step; each (station, date) on its own.

    A day runs from 01:01 to 23:59.
    """
    minutes = expand_minutes(hourly, WEATHER, ["station", "date"])
    stamped = minutes.select("station", "date", _at("date", "hour", "minute").alias("timestamp"), *WEATHER)
    return upsample_linear(stamped, "timestamp", WEATHER, step_us, ["station", "date"])


def home_series(
    appliances: DataFrame, first: str, last: str, by: list[str] | None = None,
    step_us: int = STEP_US, load_factor: float = 1.0,
) -> DataFrame:
    """Rated load by hour to watt-hours per sample, for every day from ``first`` to ``last``."""
    by = by or []
    hourly = appliance_hourly_load(appliances, by, load_factor=load_factor)
    days = F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))).alias("date")
    daily = hourly.select(*by, "hour", "minute", days, *(to_sample_energy(F.col(c), step_us / 1000).alias(c) for c in LOAD))
    stamped = daily.select(*by, "date", _at("date", "hour", "minute").alias("timestamp"), *LOAD)
    return upsample_linear(stamped, "timestamp", LOAD, step_us, [*by, "date"])


def write_inputs(
    spark: SparkSession, inputs: str, climate: str, appliances: str, first: str, last: str, step_us: int = STEP_US,
) -> int:
    """Write ``home/{date}.csv`` and ``weather/{date}.csv`` (folders of CSV files) of the days from ``first`` to ``last``, as the
    raw job reads them; the number of climate lines that were left out. The weather files have no station, so the climate must be
    one file."""
    found = spark.read.text(climate, wholetext=True)
    if len(found.inputFiles()) > 1:
        raise ValueError(f"{climate}: {len(found.inputFiles())} climate files would be mixed into one weather file")
    files = found.select(F.col("_metadata.file_path").alias("station"), "value")
    start, n = date.fromisoformat(first), (date.fromisoformat(last) - date.fromisoformat(first)).days + 1
    days = [str(start + timedelta(days=k)) for k in range(n)]
    year = int(first[:4])
    hours = parse_clm(files, year)
    listed = read_appliances(spark, appliances)
    for day in days:
        weather = weather_series(hours.filter(F.col("date") == F.lit(day).cast("date")), step_us).select("timestamp", *WEATHER)
        home = home_series(listed, day, day, step_us=step_us).select("timestamp", *LOAD)
        for topic, rows in (("solar", weather), ("home", home)):
            rows.write.mode("overwrite").option("header", True).option("timestampFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS").csv(source_path(inputs, topic, "file", day))
    return rejected_clm_lines(files).count()
