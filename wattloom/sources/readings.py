"""Reading files: CSV with a header and JSON-lines topic logs.

Every path may be one file, a list or a glob, so many days load in one job.
"""

from __future__ import annotations

import re
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattloom.functions.predicates import flatten
from wattloom.functions.timebucket import interval_15m
from wattloom.operators.quality import CORRUPT

Paths = str | list[str]

# File schemas.
WEATHER_CSV = "timestamp TIMESTAMP, solar_intensity FLOAT, temp FLOAT"
HOME_CSV = "timestamp TIMESTAMP, min_consumption_wh FLOAT, max_consumption_wh FLOAT, avg_consumption_wh FLOAT"
POWER_LOG = "time_stamp TIMESTAMP, current_consumption_w FLOAT, consumption_accumulated_w FLOAT"
BATTERY_LOG = (
    "time_stamp TIMESTAMP, batteries MAP<STRING, STRUCT<capacity_kwh: FLOAT, max_charge_speed_w: FLOAT, "
    "current_energy_wh: FLOAT, is_charging: INT, status: STRING, max_output_w: FLOAT>>"
)

# Read as characters, a field name costs its length. The parser of bytes copies its table of names for each line with a new one, so a
# log with a name per battery costs lines times names. A line that is no UTF-8 is torn either way.
BATTERY_OPTIONS = {"encoding": "UTF-8"}

# Source kinds by topic, with the file name of one day below the input folder.
FILES = {
    ("home", "file"): "home/{date}.csv",
    ("home", "log"): "log/home_{date}.log",
    ("solar", "file"): "weather/{date}.csv",
    ("solar", "log"): "log/solar_{date}.log",
    ("battery", "log"): "log/battery_{date}.log",
}


def source_path(root: str, topic: str, kind: str, date: str) -> str:
    """File of one topic, kind and day; ``date`` may be a glob such as ``2025-02-*``."""
    try:
        return f"{root.rstrip('/')}/{FILES[topic, kind].format(date=date)}"
    except KeyError:
        kinds = sorted(k for t, k in FILES if t == topic)
        raise ValueError(f"no {kind!r} source for {topic!r}; choose one of {kinds}") from None


def _csv(spark: SparkSession, path: Paths, schema: str, origin: str | None = None) -> DataFrame:
    return _with_load(spark.read.schema(schema).option("header", True).csv(path), origin)


def _json(spark: SparkSession, path: Paths, schema: str, keep_corrupt: bool, origin: str | None = None, **options: str) -> DataFrame:
    if not keep_corrupt:
        return _with_load(spark.read.schema(schema).options(**options).json(path), origin)
    reader = spark.read.schema(f"{schema}, {CORRUPT} STRING").option("columnNameOfCorruptRecord", CORRUPT).options(**options)
    return _with_load(reader.json(path), origin)


def _with_load(df: DataFrame, origin: str | None) -> DataFrame:
    """Adds ``load``, the part of the file's path that ``origin`` takes out."""
    return df if origin is None else df.withColumn("load", F.regexp_extract(F.col("_metadata.file_path"), origin, 1))


def _with_interval(df: DataFrame, ts: str) -> DataFrame:
    return df.withColumn("interval_15m", interval_15m(F.col(ts)))


def read_weather_csv(spark: SparkSession, path: Paths, origin: str | None = None) -> DataFrame:
    return _with_interval(_csv(spark, path, WEATHER_CSV, origin), "timestamp")


def read_home_csv(spark: SparkSession, path: Paths, origin: str | None = None) -> DataFrame:
    return _with_interval(_csv(spark, path, HOME_CSV, origin), "timestamp")


def read_home_log(spark: SparkSession, path: Paths, keep_corrupt: bool = False, origin: str | None = None) -> DataFrame:
    """Log of watt samples. A torn line is a row of NULLs, or shows its text with ``keep_corrupt``."""
    return _with_interval(_json(spark, path, POWER_LOG, keep_corrupt, origin), "time_stamp")


def read_solar_log(spark: SparkSession, path: Paths, keep_corrupt: bool = False, origin: str | None = None) -> DataFrame:
    return _with_interval(_json(spark, path, POWER_LOG, keep_corrupt, origin), "time_stamp")


def explode_batteries(log: DataFrame) -> DataFrame:
    """One row per battery of each log line.

    A line without batteries gives no row, unless the corrupt-record column is there to keep it for.
    """
    spread = F.explode_outer if CORRUPT in log.columns else F.explode
    keep = [c for c in log.columns if c != "batteries"]
    rows = log.select(*keep, spread("batteries").alias("battery_name", "_reading"))
    return _with_interval(flatten(rows, "_reading"), "time_stamp")


def read_battery_log(spark: SparkSession, path: Paths, keep_corrupt: bool = False, origin: str | None = None) -> DataFrame:
    return explode_batteries(_json(spark, path, BATTERY_LOG, keep_corrupt, origin, **BATTERY_OPTIONS))


READERS = {
    ("home", "file"): read_home_csv, ("home", "log"): read_home_log,
    ("solar", "file"): read_weather_csv, ("solar", "log"): read_solar_log,
    ("battery", "log"): read_battery_log,
}


def read_topic(spark: SparkSession, root: str, topic: str, kind: str, date: str) -> DataFrame:
    """Readings of one topic and day with the ``load`` that each came in (kind and day of its file), logs with their torn
    lines kept; an unknown kind is an error before anything is read."""
    path = source_path(root, topic, kind, date)
    keep = {"keep_corrupt": True} if kind == "log" else {}
    rows = READERS[topic, kind](spark, path, **keep, origin=_file_day(topic, kind))
    return rows.withColumn("load", F.concat(F.lit(f"{kind}-"), "load"))


def loads_of(rows: DataFrame, topic: str, kind: str) -> list[str]:
    """Loads that a frame of :func:`read_topic` covers, those of files without rows included."""
    days = (re.search(_file_day(topic, kind), unquote(f)) for f in rows.inputFiles())
    return sorted({f"{kind}-{m[1]}" for m in days if m})


def _file_day(topic: str, kind: str) -> str:
    before, after = FILES[topic, kind].split("{date}")
    return f"/{re.escape(before)}([^/]+?){re.escape(after)}(?:/|$)"
