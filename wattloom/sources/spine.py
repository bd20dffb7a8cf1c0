"""Time spine."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def spine_between(bounds: DataFrame, step_minutes: int = 15) -> DataFrame:
    """``timestamp`` at a fixed step, both ends included, for one row of (``start``, ``end``).

    Two levels: the days are dealt out to tasks first, each task then fills its days.
    """
    start, end = F.unix_micros("start"), F.unix_micros("end")
    step_us = step_minutes * 60_000_000
    per_block = max(1, 1440 // step_minutes)
    blocks = bounds.select(
        end.alias("_end"), F.explode(F.sequence(start, end, F.lit(step_us * per_block))).alias("_from")
    ).repartition("_from")
    stop = F.least(F.col("_from") + F.lit(step_us * (per_block - 1)), F.col("_end"))
    stamps = blocks.select(F.explode(F.sequence("_from", stop, F.lit(step_us))).alias("_us"))
    return stamps.select(F.timestamp_micros("_us").alias("timestamp"))


def time_spine(spark: SparkSession, start: str, end: str, step_minutes: int = 15) -> DataFrame:
    one = spark.range(1).select(F.lit(start).cast("timestamp").alias("start"), F.lit(end).cast("timestamp").alias("end"))
    return spine_between(one, step_minutes)
