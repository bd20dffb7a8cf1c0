"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` is the table folder, ``BENCH_CPUS`` the number of local cores. Results go to a sink
that reads every row and keeps none. ``solar_day_csv`` is the job whose time the baseline gives: read one day of weather at 5 ms (16.5 million
rows) from CSV, take the output of a panel, write it as CSV by quarter hour. Making the file is not timed. ``solar_day_5ms``
makes the same samples in memory, takes the output of three panels and writes 15-minute sums as parquet.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from wattloom.functions.timebucket import bucket_start  # noqa: E402
from wattloom.operators.bucketing import sum_per_bucket  # noqa: E402
from wattloom.operators.generation import solar_generation  # noqa: E402
from wattloom.operators.resample import upsample_linear  # noqa: E402
from wattloom.session import build_session, scratch  # noqa: E402
from wattloom.sinks.tables import write_csv_by_interval  # noqa: E402
from wattloom.sources.catalogues import LOG_PANEL_ID, panel_catalogue  # noqa: E402
from wattloom.sources.readings import read_weather_csv  # noqa: E402
from wattloom.workload import QUERIES  # noqa: E402
from wattloom.workload.base import Tables  # noqa: E402

HEADLINE = [
    "home_fact_15m", "solar_fact_15m", "battery_fact_15m", "solar_generation", "solar_generation_15m",
    "latest_state", "last_per_bucket", "as_of_join", "current_key_join", "scd2_apply", "upsert_type1", "changelog",
    "dim_battery", "dim_home", "dim_date", "surrogate_dense", "daily_kwh", "minute_wh", "top_intervals",
    "upsample_linear", "minute_expand", "hourly_load", "insert_new_orders", "dup_keys", "orphan_keys",
    "read_battery_log", "raw_solar_two_sources", "stream_tumbling_15m", "daily_flows",
]
DAY_US = 24 * 3_600_000_000


def day_of_weather(spark: SparkSession, folder: str) -> DataFrame:
    """Minutes 01:01 to 23:59 of a day, each with the mean event value at that time of day over all days."""
    r = Tables(spark, folder).readings()
    minute = F.hour("timestamp") * 60 + F.minute("timestamp")
    means = r.groupBy(minute.alias("m")).agg(F.avg("generation_power_wh").alias("solar_intensity"), F.avg(F.col("capacity_kwh") + 1).alias("temp"))
    stamp = F.timestamp_seconds(F.lit(1_357_000_000 // 86400 * 86400) + F.col("m") * 60)
    return means.filter("m BETWEEN 61 AND 1439").select(F.lit(1).alias("site_id"), stamp.alias("timestamp"), "solar_intensity", "temp")


def solar_day_5ms(spark: SparkSession, folder: str, out: str) -> int:
    weather = upsample_linear(day_of_weather(spark, folder), "timestamp", ["solar_intensity", "temp"], 5000, ["site_id"])
    panels = panel_catalogue(spark).filter(F.col("id") != LOG_PANEL_ID)
    output = solar_generation(weather, panels)
    sums = sum_per_bucket(
        output.withColumn("one", F.lit(1)), ["panel_id"], {"generation_power_wh": "generation_power_wh", "samples": "one"}, "timestamp"
    )
    sums.write.mode("overwrite").parquet(out)
    return int(spark.read.parquet(out).agg(F.sum("samples")).first()[0])


def solar_day_csv(spark: SparkSession, source: str, out: str) -> None:
    """Read, derive and write by interval. Files are in time order, so a task holds few intervals and nothing is shuffled."""
    weather = read_weather_csv(spark, source).withColumn("site_id", F.lit(1))
    panel = panel_catalogue(spark).filter("id = 1")
    rows = solar_generation(weather, panel).select("timestamp", "interval_15m", "panel_id", "generation_power_wh")
    write_csv_by_interval(rows, out)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "16g",
        "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    wanted = sys.argv[1:] or [*HEADLINE, "solar_day_5ms", "solar_day_csv"]
    Tables(spark, folder)["events"].groupBy(bucket_start(F.col("ts"))).count().write.format("noop").mode("overwrite").save()

    seconds, samples, day = {}, None, ""
    if "solar_day_csv" in wanted:
        day = scratch(spark, "weather-day")
        weather = upsample_linear(day_of_weather(spark, folder), "timestamp", ["solar_intensity", "temp"], 5000, ["site_id"])
        weather = weather.select("timestamp", "solar_intensity", "temp").repartitionByRange(23, "timestamp").sortWithinPartitions("timestamp")
        weather.write.option("header", True).option("timestampFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS").csv(day)
    for name in wanted:
        start = time.perf_counter()
        if name == "solar_day_5ms":
            samples = solar_day_5ms(spark, folder, scratch(spark, "solar-day"))
        elif name == "solar_day_csv":
            solar_day_csv(spark, day, scratch(spark, "solar-by-interval"))
        else:
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    line = {
        "metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": Path(folder).name.removeprefix("sf"),
    }
    if samples:
        line["solar_day_samples"] = samples
        line["solar_day_rows_per_sec"] = round(samples / seconds["solar_day_5ms"])
    print(json.dumps(line))


if __name__ == "__main__":
    main()
