"""Fact loads. Each gives the rows to append: those whose key the target lacks.

``date`` loads one day; None loads every day of the readings in one job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattloom.functions.keys import device_id_from_name
from wattloom.functions.predicates import current
from wattloom.operators.bucketing import home_15m, last_per_bucket, solar_15m
from wattloom.operators.joins import attach_current_key
from wattloom.operators.merge import insert_new, replace_matching
from wattloom.operators.scd2 import scd2_as_of_join


Days = str | list[str] | None


def one_month(target: DataFrame, date: Days) -> DataFrame:
    """The target partitions that a load of ``date`` (a day, or several) can touch."""
    if date is None or "month" not in target.columns:
        return target
    days = [date] if isinstance(date, str) else date
    months = sorted({f"{d[:7]}-01" for d in days})
    return target.filter(F.col("month").isin(*[F.lit(m).cast("date") for m in months]))


def _keyed(staged: DataFrame, dim: DataFrame, on: dict[str, str], key: str, as_of: bool) -> DataFrame:
    """Surrogate key of the current version, or of the version valid at the bucket. The first version of a device counts
    from the beginning of time: it is loaded after the first readings. A device that the dimension lacks has no key."""
    if not as_of:
        return attach_current_key(staged, dim, on, key)
    return scd2_as_of_join(staged, dim, on, "bucket", [key], from_start=True)


def staged_home(readings: DataFrame, date: Days = None) -> DataFrame:
    return home_15m(readings, date)


def keyed_home(staged: DataFrame, dim_home: DataFrame) -> DataFrame:
    home_key: Column = current(dim_home).select("home_key").scalar()
    return staged.select(
        F.col("bucket").alias("home_power_reading_key"), home_key.alias("home_key"),
        F.col("bucket").alias("date_key"), "min_consumption_power_wh", "max_consumption_power_wh",
    )


def home_rows(readings: DataFrame, dim_home: DataFrame, date: Days = None) -> DataFrame:
    """Staged home facts of one household, whose key is the one current row of the dimension."""
    return keyed_home(staged_home(readings, date), dim_home)


def staged_solar(readings: DataFrame, date: Days = None) -> DataFrame:
    return solar_15m(readings, date)


def keyed_solar(staged: DataFrame, dim_panel: DataFrame, as_of: bool = False) -> DataFrame:
    return _keyed(staged, dim_panel, {"panel_id": "solar_panel_id"}, "solar_panel_key", as_of).select(
        "solar_panel_key", F.col("bucket").alias("date_key"),
        F.col("panel_id").alias("solar_panel_id"), "generation_power_wh",
    )


def solar_rows(readings: DataFrame, dim_panel: DataFrame, date: Days = None, as_of: bool = False) -> DataFrame:
    return keyed_solar(staged_solar(readings, date), dim_panel, as_of)


STATE = ["battery_name", "timestamp", "current_energy_wh", "is_charging", "status"]


def staged_battery(readings: DataFrame, date: Days = None, tie_break: list[str] | None = None) -> DataFrame:
    """State at the end of each bucket."""
    extra = ["day"] if "day" in readings.columns else []
    return last_per_bucket(readings.select(*STATE, *(tie_break or []), *extra), "battery_name", "timestamp", tie_break, date)


def keyed_battery(staged: DataFrame, dim_battery: DataFrame, as_of: bool = False) -> DataFrame:
    rows = staged.withColumn("battery_id", device_id_from_name(F.col("battery_name")))
    return _keyed(rows, dim_battery, {"battery_id": "battery_id"}, "battery_key", as_of).select(
        "battery_key", F.col("bucket").alias("date_key"), "battery_id", "current_energy_wh", "is_charging", "status"
    )


def battery_rows(
    readings: DataFrame, dim_battery: DataFrame, date: Days = None, as_of: bool = False,
    tie_break: list[str] | None = None,
) -> DataFrame:
    return keyed_battery(staged_battery(readings, date, tie_break), dim_battery, as_of)


def fact_home(target: DataFrame, readings: DataFrame, dim_home: DataFrame, date: Days = None) -> DataFrame:
    return insert_new(one_month(target, date), home_rows(readings, dim_home, date), ["home_power_reading_key"])


def fact_solar(
    target: DataFrame, readings: DataFrame, dim_panel: DataFrame, date: Days = None, as_of: bool = False,
) -> DataFrame:
    rows = solar_rows(readings, dim_panel, date, as_of)
    return insert_new(one_month(target, date), rows, ["solar_panel_id", "date_key"])


def fact_battery(
    target: DataFrame, readings: DataFrame, dim_battery: DataFrame, date: Days = None,
    as_of: bool = False, tie_break: list[str] | None = None,
) -> DataFrame:
    rows = battery_rows(readings, dim_battery, date, as_of, tie_break)
    return insert_new(one_month(target, date), rows, ["battery_id", "date_key"])


def reloaded(target: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """The whole fact with ``rows`` put in place of earlier ones, for buckets first loaded half full."""
    return replace_matching(target, rows, keys)
