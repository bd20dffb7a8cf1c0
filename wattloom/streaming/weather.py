"""Readings with the weather of their site, both sides streams.

A weather sample holds from its time for one step. The join is an equi-join on site and step of time with the interval as a residual, so
a site with a third of all readings is as many groups as it has steps, and state goes step by step. A sample that does not begin with a step
of time is sent to the two that it touches; a reading is in one, so no pair is met twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.functions.timebucket import micros

HOUR_US = 3_600_000_000


def with_weather(
    readings: DataFrame, weather: DataFrame, site: str = "site_id", ts: str = "timestamp", step_us: int = HOUR_US,
    late: str = "10 minutes", weather_late: str = "1 hour",
) -> DataFrame:
    """Every reading with the weather samples that hold at its time: ``weather.ts <= readings.ts < weather.ts + step``.

    Each side has a watermark of its own. A pair comes out when its second part arrives, in whatever order; a reading without weather
    comes out with NULLs once both watermarks have passed it. Rows that come later than their lateness are dropped, by Spark's rule.
    Of several samples that hold, each gives a row. Readings and samples without site or time are left out. Columns of the weather that
    readings have too are named ``weather_...``. On tables in place of streams this is the same join.
    """
    held = [c for c in weather.columns if c not in (site, ts)]
    w = weather.filter(F.col(site).isNotNull() & F.col(ts).isNotNull())
    w = w.withColumn("_w_ts", F.col(ts).cast("timestamp")).withWatermark("_w_ts", weather_late)
    first, last = (F.floor((micros(F.col("_w_ts")) + d) / step_us) for d in (0, step_us - 1))
    w = w.select(
        F.col(site).alias("_w_site"), "_w_ts", F.explode(F.sequence(first, last)).alias("_w_step"),
        *(F.col(c).alias(f"weather_{c}" if c in readings.columns else c) for c in held))
    r = readings.filter(F.col(site).isNotNull() & F.col(ts).isNotNull())
    r = r.withColumn("_ts", F.col(ts).cast("timestamp")).withWatermark("_ts", late).withColumn("_step", F.floor(micros(F.col("_ts")) / step_us))
    until = F.col("_w_ts") + F.expr(f"INTERVAL '{step_us / 1e6:.6f}' SECOND")
    holds = (F.col(site) == F.col("_w_site")) & (F.col("_step") == F.col("_w_step")) & (F.col("_ts") >= F.col("_w_ts")) & (F.col("_ts") < until)
    return r.join(w, holds, "left_outer").drop("_w_site", "_w_ts", "_w_step", "_step", "_ts")
