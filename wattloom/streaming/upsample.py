"""Linear upsampling as a stream: the last sample of each series is state, a segment comes out when its next sample is sure."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from wattloom.functions.timebucket import micros
from wattloom.operators.resample import BLOCK_STEPS
from wattloom.streaming.state import STAMPS

# Spark also starts a processor in a Python process beside the driver, which files added to the job don't reach, so its code goes with it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class Segments(StatefulProcessor):
    """Slots of a series wait for the watermark, as samples may come out of order; from each slot that is sure to the next one goes a segment."""

    def __init__(self, step_us: int, width: int) -> None:
        self.step_us, self.width = step_us, width

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        sums = ", ".join(f"s{i} DOUBLE" for i in range(self.width))
        self.open = handle.getMapState("open", "slot LONG", f"n LONG, {sums}")
        self.last = handle.getValueState("last", f"slot LONG, {sums}")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        names = [f"s{i}" for i in range(self.width)]
        for pdf in rows:
            for slot, n, *sums in zip(pdf.slot.tolist(), pdf.n.tolist(), *(pdf[c].tolist() for c in names), strict=True):
                if self.open.containsKey((slot,)):
                    n0, *sums0 = self.open.getValue((slot,))
                    n, sums = n + n0, [a + b for a, b in zip(sums, sums0, strict=True)]
                else:
                    self.handle.registerTimer(-((slot + self.step_us) // -1000))
                self.open.updateValue((slot,), (n, *sums))
        yield self._frame([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        end = expiredTimerInfo.getExpiryTimeInMs() * 1000
        out, last = [], tuple(self.last.get()) if self.last.exists() else None
        for slot in sorted(k[0] for k in self.open.keys() if k[0] + self.step_us <= end):
            n, *sums = self.open.getValue((slot,))
            self.open.removeKey((slot,))
            now = (slot, *(s / n for s in sums))
            if last is not None:
                out.append((key[0], last[0], slot, *last[1:], *now[1:]))
            last = now
        if last is not None:
            self.last.update(last)
        yield self._frame(out)

    def _frame(self, rows: list) -> pd.DataFrame:
        w = range(self.width)
        cols = {"series": object, "a": "int64", "b": "int64", **{f"a{i}": "float64" for i in w}, **{f"b{i}": "float64" for i in w}}
        return pd.DataFrame(rows, columns=list(cols)).astype(cols)

    def close(self) -> None:
        pass


def upsample(stream: DataFrame, ts: str, cols: list[str], step_us: int, part_by: list[str], late: str = "10 minutes") -> DataFrame:
    """Rows of :func:`wattloom.operators.resample.upsample_linear` for every series, up to the newest sample that the watermark has passed; that one comes
    out with its successor. Samples that lack time or a column are left out; those of one slot are averaged.

    The dense rows come from segments, outside the state; a task adds up the samples of a slot before the shuffle.
    """
    us = micros(F.col(ts))
    slot = us - F.pmod(us, F.lit(step_us))
    sums = [F.col(c).cast("double").alias(f"s{i}") for i, c in enumerate(cols)]
    series = F.to_json(F.struct(*part_by), STAMPS) if part_by else F.lit("{}")
    rows = stream.dropna(subset=[ts, *cols]).select(series.alias("series"), slot.alias("slot"), F.col(ts).cast("timestamp").alias("at"), F.lit(1).cast("long").alias("n"), *sums)
    names = [f"s{i}" for i in range(len(cols))]

    def add_up(batches):
        for pdf in batches:
            yield pdf.groupby(["series", "slot"], as_index=False).agg({"at": "max", "n": "sum", **dict.fromkeys(names, "sum")})

    few = rows.mapInPandas(add_up, rows.schema).withWatermark("at", late)
    values = ", ".join(f"{side}{i} DOUBLE" for side in "ab" for i in range(len(cols)))
    segments = few.groupBy("series").transformWithStateInPandas(Segments(step_us, len(cols)), f"series STRING, a LONG, b LONG, {values}", "Append", "EventTime")

    stop = F.col("b") - F.lit(step_us)
    blocks = segments.withColumn("_block", F.explode(F.sequence(F.col("a"), stop, F.lit(step_us * BLOCK_STEPS))))
    dense = blocks.withColumn("_g", F.explode(F.sequence(F.col("_block"), F.least(F.col("_block") + F.lit(step_us * (BLOCK_STEPS - 1)), stop), F.lit(step_us))))
    share = (F.col("_g") - F.col("a")) / (F.col("b") - F.col("a"))
    key = T.StructType([T.StructField(c, stream.schema[c].dataType) for c in part_by])
    named = dense.withColumn("_key", F.from_json("series", key, STAMPS)) if part_by else dense
    return named.select(
        *(F.col("_key")[c].alias(c) for c in part_by), F.timestamp_micros("_g").alias(ts),
        *((F.col(f"a{i}") + (F.col(f"b{i}") - F.col(f"a{i}")) * share).alias(c) for i, c in enumerate(cols)),
    )
