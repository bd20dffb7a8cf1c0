"""Readings to 15-minute rows: sums, and last or latest state per device."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattloom.functions.timebucket import QUARTER_US, bucket_start, on_day


def sum_per_bucket(
    readings: DataFrame, by: list[str], sums: dict[str, str], ts: str = "ts",
    date: str | list[str] | None = None, width_us: int = QUARTER_US,
) -> DataFrame:
    """Sum columns (``{output: input}``) per device and bucket, for one day or all.

    Sums are partial before the shuffle, so a device with a third of all samples still ships one
    row per bucket and task.
    """
    day = on_day(readings, date, ts)
    return day.groupBy(*by, bucket_start(F.col(ts), width_us).alias("bucket")).agg(
        *(F.sum(F.col(old).cast("double")).alias(new) for new, old in sums.items())
    )


def home_15m(readings: DataFrame, date: str | list[str] | None = None, by: tuple[str, ...] = (), ts: str = "timestamp") -> DataFrame:
    sums = {"min_consumption_power_wh": "min_consumption_wh", "max_consumption_power_wh": "max_consumption_wh"}
    return sum_per_bucket(readings, list(by), sums, ts, date)


def solar_15m(readings: DataFrame, date: str | list[str] | None = None, ts: str = "timestamp") -> DataFrame:
    return sum_per_bucket(readings, ["panel_id"], {"generation_power_wh": "generation_power_wh"}, ts, date)


def _newest(readings: DataFrame, by: dict[str, Column], ts: str, tie_break: list[str]) -> DataFrame:
    """Newest row of each group, with the group columns.

    One rule for all types: row number 1 per group, by time, then ``tie_break``, then a hash of the whole row, so the result
    does not depend on the order of arrival. Spark limits row numbers before the shuffle: one row per group and task goes into
    it, and a device with a third of all readings is no heavier than another.
    """
    tie = [*(F.col(c) for c in tie_break), F.xxhash64(*readings.columns)]
    last = Window.partitionBy(*by).orderBy(F.col(ts).desc(), *(c.desc() for c in tie))
    ranked = readings.withColumns(by).withColumn("_rn", F.row_number().over(last))
    return ranked.filter("_rn = 1").drop("_rn")


def newest_in(readings: DataFrame, by: list[str], ts: str, compared: list[str]) -> DataFrame:
    """Newest row of each group (``by`` and 15-minute ``bucket``); rows of one time go by a hash of the ``compared`` columns."""
    groups = {**{c: F.col(c) for c in by}, "bucket": bucket_start(F.col(ts))}
    last = Window.partitionBy(*groups).orderBy(F.col(ts).desc(), F.xxhash64(*compared).desc())
    ranked = readings.withColumns(groups).withColumn("_rn", F.row_number().over(last))
    return ranked.filter("_rn = 1").drop("_rn")


def last_per_bucket(
    readings: DataFrame, device: str, ts: str = "timestamp", tie_break: list[str] | None = None,
    date: str | list[str] | None = None,
) -> DataFrame:
    """Last reading of each (bucket, device), with its ``bucket``."""
    day = on_day(readings, date, ts)
    by = {device: F.col(device), "bucket": bucket_start(F.col(ts))}
    return _newest(day, by, ts, tie_break or []).select("bucket", *day.columns)


def latest_state(
    readings: DataFrame, device: str, ts: str = "timestamp", tie_break: list[str] | None = None,
) -> DataFrame:
    """Newest reading of every device."""
    return _newest(readings, {device: F.col(device)}, ts, tie_break or []).select(*readings.columns)


def latest_n(readings: DataFrame, n: int, ts: str = "timestamp", tie_break: list[str] | None = None) -> DataFrame:
    """The ``n`` newest samples overall."""
    order = [F.col(ts).desc(), *(F.col(c).desc() for c in tie_break or [])]
    return readings.orderBy(*order).limit(n)
