"""Readings along a curve over device and time, read by both."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.sinks import layout
from wattloom.workload.base import READINGS, Tables, query

HOURS = {"panel_id": (7, 7), "timestamp": ("2024-01-10 00:00:00", "2024-01-10 23:59:59.999999")}


def laid_out(t: Tables) -> str:
    """The readings in some fifty files."""
    path, rows = t.scratch("curved"), t.readings().select("event_id", "panel_id", "timestamp", "generation_power_wh")
    layout.write_curved(rows, path, ["panel_id", "timestamp"], max(1, rows.count() // 50))
    return path


@query("curved_device_day", f"""WITH {READINGS} SELECT event_id, panel_id, timestamp, generation_power_wh FROM readings
WHERE panel_id = 7 AND CAST(timestamp AS DATE) = DATE '2024-01-10'""")
def curved_device_day(t: Tables) -> DataFrame:
    """One device and one day, from the files that can hold it."""
    return layout.read_curved(t.spark, laid_out(t), HOURS)


@query("curved_file_share", f"""WITH {READINGS} SELECT panel_id, CAST(count(*) AS BIGINT) AS n, TRUE AS few_files FROM readings
WHERE panel_id = 7 AND CAST(timestamp AS DATE) = DATE '2024-01-10' GROUP BY panel_id""")
def curved_file_share(t: Tables) -> DataFrame:
    """The same, with whether at most a fifth of the files was opened."""
    path = laid_out(t)
    some, every = layout.files_in(t.spark, path, HOURS)
    counted = layout.read_curved(t.spark, path, HOURS).groupBy("panel_id").agg(F.count("*").alias("n"))
    return counted.withColumn("few_files", F.lit(5 * len(some) <= len(every)))


@query("curved_whole_table", f"""WITH {READINGS} SELECT event_id, panel_id, timestamp, generation_power_wh FROM readings""")
def curved_whole_table(t: Tables) -> DataFrame:
    return t.spark.read.parquet(laid_out(t))
