"""Streaming ingest, windowed sums, insert-only fact writes and de-duplication."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wattloom.functions.timebucket import interval_15m, month_start
from wattloom.operators.merge import insert_new
from wattloom.operators.quality import CORRUPT
from wattloom.plans.flows import load_checked
from wattloom.session import state_in_rocksdb
from wattloom.sinks.tables import Lake, write_partitioned
from wattloom.sources.readings import BATTERY_LOG, BATTERY_OPTIONS, POWER_LOG, explode_batteries


def _log(spark: SparkSession, folder: str, schema: str, files_per_trigger: int, **options: str) -> DataFrame:
    """Lines of new files; a torn one shows its text."""
    reader = spark.readStream.schema(f"{schema}, {CORRUPT} STRING").option("columnNameOfCorruptRecord", CORRUPT).options(**options)
    return reader.option("maxFilesPerTrigger", files_per_trigger).json(folder)


def stream_power_log(spark: SparkSession, folder: str, files_per_trigger: int = 1000) -> DataFrame:
    return _log(spark, folder, POWER_LOG, files_per_trigger).withColumn("interval_15m", interval_15m(F.col("time_stamp")))


def stream_battery_log(spark: SparkSession, folder: str, files_per_trigger: int = 1000) -> DataFrame:
    return explode_batteries(_log(spark, folder, BATTERY_LOG, files_per_trigger, **BATTERY_OPTIONS))


def start_ingest(
    lake: Lake, stream: DataFrame, shape: Callable[[DataFrame], DataFrame], table: str,
    append: Callable[[DataFrame, list[str]], None], name: str, checkpoint: str,
) -> StreamingQuery:
    """Load new files into a raw table, checked like batch loads; torn lines and incomplete rows go to quarantine.

    Each micro-batch is a load of its own, ``name`` and number, so one that is run again after a failure replaces itself.
    Numbers begin again with a new checkpoint: give it a new ``name``.
    """
    def load(batch: DataFrame, n: int) -> None:
        label = f"{name}-{n}"
        load_checked(lake, shape(batch), table, label, lambda good: append(good, [label]))

    return stream.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def tumbling_sum(
    stream: DataFrame, device: str, value: str, ts: str = "timestamp", late: str = "10 minutes", width: str = "15 minutes",
) -> DataFrame:
    """Sum per device and window; in append mode a window comes out once the watermark has passed it."""
    summed = stream.withWatermark(ts, late).groupBy(F.window(ts, width), F.col(device)).agg(
        F.sum(F.col(value).cast("double")).alias(value)
    )
    return summed.select(F.col("window.start").alias("bucket"), device, value)


def drop_repeats(stream: DataFrame, keys: list[str], ts: str = "timestamp", late: str = "10 minutes") -> DataFrame:
    """First copy of each key; state is kept for the lateness only."""
    return stream.withWatermark(ts, late).dropDuplicatesWithinWatermark(keys)


def write_stream(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Rows of a stream as parquet. One with a state processor is started by :func:`write_processed`."""
    return (
        stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
        .outputMode("append").trigger(availableNow=True).start()
    )


def write_processed(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """:func:`write_stream` for a stream with a state processor, in sessions with any state store."""
    with state_in_rocksdb(stream.sparkSession):
        return write_stream(stream, path, checkpoint)


def start_insert_new(
    stream: DataFrame, read_target: Callable[[], DataFrame], keys: list[str], path: str, checkpoint: str, ts: str = "date_key",
) -> StreamingQuery:
    """Insert-only merge of each micro-batch into a fact folder by month.

    The merge itself makes a repeated batch harmless: its keys are already in the target. Keys
    are unique within a batch when the stream comes from a windowed sum or has its repeats dropped. Only
    the months that the batch holds are read of the target, so one straggler adds one month.
    """
    def load(batch: DataFrame, _: int) -> None:
        rows = batch.withColumn("month", month_start(F.col(ts))).persist(StorageLevel.MEMORY_AND_DISK)
        months = [r["month"] for r in rows.select("month").distinct().collect()]
        target = read_target().filter(F.col("month").isin(months))
        write_partitioned(insert_new(target, rows, keys), path, ["month"], keys, "append")
        rows.unpersist()

    return stream.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
