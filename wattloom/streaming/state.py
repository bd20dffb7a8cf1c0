"""Newest state of devices as a stream, with state that ends.

Rows may come out of order within the lateness. The rule for the newest row is that of the batch operators (time, then a hash of the row), so any
cut of the input into micro-batches gives the batch result. Tasks keep the newest row of each batch of rows before the
shuffle, so a device with a third of all readings sends a few rows only.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from wattloom.functions.timebucket import QUARTER_US, bucket_start, micros

# Spark also starts a processor in a Python process beside the driver, which files added to the job don't reach, so its code goes with it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

PACKED = "device STRING, bucket LONG, at TIMESTAMP, us LONG, tie LONG, row STRING"
STAMPS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


class LastOfBuckets(StatefulProcessor):
    """Newest row of each open bucket of a device; a bucket comes out, and its state goes, once the watermark has passed its end.

    The processor of an earlier :func:`last_per_bucket`, which aggregates now; for streams that want a device's open buckets under one key."""

    def __init__(self, width_us: int) -> None:
        self.width_us = width_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getMapState("open", "bucket LONG", "us LONG, tie LONG, row STRING")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        for pdf in rows:
            for bucket, us, tie, row in zip(pdf.bucket.tolist(), pdf.us.tolist(), pdf.tie.tolist(), pdf.row, strict=True):
                if not self.open.containsKey((bucket,)):
                    self.handle.registerTimer(-((bucket + self.width_us) // -1000))
                elif tuple(self.open.getValue((bucket,))[:2]) >= (us, tie):
                    continue
                self.open.updateValue((bucket,), (us, tie, row))
        yield pd.DataFrame({"row": pd.Series([], dtype=object)})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        end = expiredTimerInfo.getExpiryTimeInMs() * 1000
        # Each bucket has a timer. One that ends on a millisecond is named by it; listing all open ones for each would be quadratic.
        if self.width_us % 1000 == 0:
            closed = [b for b in (end - self.width_us,) if self.open.containsKey((b,))]
        else:
            closed = [k[0] for k in self.open.keys() if k[0] + self.width_us <= end]
        yield pd.DataFrame({"row": pd.Series([self.open.getValue((b,))[2] for b in closed], dtype=object)})
        for b in closed:
            self.open.removeKey((b,))

    def close(self) -> None:
        pass


class Newest(StatefulProcessor):
    """Newest row of a device, put out whenever it changes. The state ends when the watermark is ``idle`` past the row: a row that is
    not late then is newer in any case."""

    def __init__(self, idle_ms: int) -> None:
        self.idle_ms = idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("newest", "us LONG, tie LONG, row STRING")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        held = self.state.get() if self.state.exists() else None
        best = tuple(held) if held is not None else None
        for pdf in rows:
            best = max([*([best] if best else []), *zip(pdf.us.tolist(), pdf.tie.tolist(), pdf.row, strict=True)], key=lambda r: r[:2], default=best)
        changed = best is not None and (held is None or tuple(held)[:2] != best[:2])
        if changed:
            if held is not None:
                self.handle.deleteTimer(held[0] // 1000 + self.idle_ms)
            self.handle.registerTimer(best[0] // 1000 + self.idle_ms)
            self.state.update(best)
        yield pd.DataFrame({"row": pd.Series([best[2]] if changed else [], dtype=object)})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.state.clear()
        yield pd.DataFrame({"row": pd.Series([], dtype=object)})

    def close(self) -> None:
        pass


def _newest_of_batch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        yield pdf.sort_values(["us", "tie"]).drop_duplicates(["device", "bucket"], keep="last")


def _run(stream: DataFrame, device: str, ts: str, late: str, bucket, processor: StatefulProcessor) -> DataFrame:
    rows = stream.filter(F.col(device).isNotNull() & F.col(ts).isNotNull()).select(
        F.col(device).cast("string").alias("device"), bucket.alias("bucket"), F.col(ts).cast("timestamp").alias("at"), micros(F.col(ts)).alias("us"),
        F.xxhash64(*stream.columns).alias("tie"), F.to_json(F.struct(*stream.columns), STAMPS).alias("row"),
    )
    few = rows.mapInPandas(_newest_of_batch, PACKED).withWatermark("at", late)
    out = few.groupBy("device").transformWithStateInPandas(processor, "row STRING", "Append", "EventTime")
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in stream.schema.fields])
    return out.select(F.from_json("row", schema, STAMPS).alias("r")).select("r.*")


def last_per_bucket(stream: DataFrame, device: str, ts: str = "timestamp", late: str = "10 minutes", width_us: int = QUARTER_US) -> DataFrame:
    """Last reading of each (bucket, device) with its ``bucket``, once the bucket can't change any more. Readings without device or time are left out.

    State is the newest row of each open bucket. An aggregation keeps it, not a processor: that one is called for every bucket that opens or
    closes and asks the store over a socket, in Python. A reading counts as long as its bucket is open, however late it is.
    """
    rows = stream.filter(F.col(device).isNotNull() & F.col(ts).isNotNull()).select(
        F.col(device).cast("string").alias("device"), F.col(ts).cast("timestamp").alias("at"),
        F.struct(micros(F.col(ts)), F.xxhash64(*stream.columns)).alias("place"), F.struct(*stream.columns).alias("r"),
    )
    open_buckets = rows.withWatermark("at", late).groupBy(F.window("at", f"{width_us} microseconds"), "device")
    out = open_buckets.agg(F.max_by("r", "place").alias("r")).select("r.*")
    return out.select(bucket_start(F.col(ts), width_us).alias("bucket"), *stream.columns)


def latest_state(stream: DataFrame, device: str, ts: str = "timestamp", late: str = "10 minutes", idle: str = "1 day") -> DataFrame:
    """Newest reading of each device whenever it changes; of all rows put out for a device the newest one is its state. The state of a device
    that is silent for ``idle`` is given up."""
    idle_ms = int(pd.Timedelta(idle).total_seconds() * 1000)
    return _run(stream, device, ts, late, F.lit(0).cast("long"), Newest(idle_ms))
