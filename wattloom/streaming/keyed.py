"""Streamed facts with the surrogate key of a type-2 dimension that changes while the stream runs.

A fact takes the version valid at its own time. One without a version waits and is tried again with each batch; when a new dimension version
gives facts that are already written another key, the parts that hold them are taken in again. So the facts are those of one batch run
over all input with the newest dimension, whatever the order in which facts and versions came.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from wattloom.operators.scd2 import END, START
from wattloom.operators.timeline import as_of
from wattloom.schemas import no_rows
from wattloom.sinks.loads import exists, hadoop, names_in, remove


@dataclass(frozen=True)
class KeyedFacts:
    """Facts below ``root``, a folder that all executors reach: a part for each step, and a marker that names the parts that count.

    ``schema``: columns of the facts without the key. ``on``: fact column to business key column. ``version`` tells the number of the
    dimension's newest version and ``at`` reads one; the version of the last step must still be there. One writer at a time. Rows that
    repeat stay as often as they come; facts without device or time wait for ever. A key's first version holds from the beginning.
    """

    spark: SparkSession
    root: str
    schema: T.StructType
    on: dict[str, str]
    key: str
    ts: str
    version: Callable[[], int]
    at: Callable[[int], DataFrame]

    def _last(self) -> dict:
        steps = [int(n[1:]) for n in names_in(self.spark, f"{self.root}/commits") if n.startswith("v")]
        if not steps:
            return {"step": 0, "batch": -1, "version": None, "parts": []}
        fs, marker = hadoop(self.spark, f"{self.root}/commits/v{max(steps)}")
        stream = fs.open(marker)
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def _part(self, keyed: bool, steps: list[int]) -> DataFrame:
        """Rows with ``_step``; a part without rows has no folder."""
        stored = T.StructType([*self.schema.fields, T.StructField(self.key, T.LongType()), T.StructField("_step", T.IntegerType())])
        paths = [p for p in (f"{self.root}/data/_keyed={str(keyed).lower()}/_step={n}" for n in steps) if exists(self.spark, p)]
        if not paths:
            return no_rows(self.spark, stored)
        return self.spark.read.schema(stored).option("basePath", f"{self.root}/data/_keyed={str(keyed).lower()}").parquet(*paths)

    def read(self) -> DataFrame:
        """The facts with their key."""
        return self._part(True, self._last()["parts"]).drop("_step")

    def waiting(self) -> DataFrame:
        """Facts that have no version yet."""
        return self._part(False, [self._last()["step"]]).drop("_step", self.key)

    def _keyed(self, rows: DataFrame, dim: DataFrame, name: str) -> DataFrame:
        versions = dim.select(*self.on.values(), START, END, F.col(self.key).cast("long").alias(name))
        return as_of(rows, versions, self.on, self.ts, START, END, [name], from_start=True)

    def _outdated(self, last: dict, dim: DataFrame) -> list[int]:
        """Parts with a fact that needs another key now. Only facts of devices whose versions changed are looked at."""
        cols = [*self.on.values(), START, END, self.key]
        before, after = self.at(last["version"]).select(*cols), dim.select(*cols)
        changed = before.exceptAll(after).union(after.exceptAll(before)).select(*(F.col(d).alias(f) for f, d in self.on.items())).distinct()
        facts = self._part(True, last["parts"]).join(changed, [*self.on], "left_semi")
        moved = self._keyed(facts, dim, "_now").filter(~F.col("_now").eqNullSafe(F.col(self.key)))
        return [r["_step"] for r in moved.select("_step").distinct().collect()]

    def take(self, batch: DataFrame, n: int) -> None:
        """One step: new facts, those that wait and those of outdated parts get their keys. A batch that has been taken is not taken again;
        what a step that died has written has no marker, and the next one removes it."""
        last = self._last()
        if n <= last["batch"]:
            return
        self._step(batch, n, last)

    def settle(self) -> None:
        """A step without new facts, for a dimension that has changed since the last one."""
        last = self._last()
        if last["version"] is not None:
            self._step(no_rows(self.spark, self.schema), last["batch"], last)

    def _step(self, batch: DataFrame, n: int, last: dict) -> None:
        version, step = self.version(), last["step"] + 1
        dim = self.at(version)
        again = self._outdated(last, dim) if last["parts"] and version != last["version"] else []
        for keyed in ("true", "false"):  # what a step that died has left
            remove(self.spark, f"{self.root}/data/_keyed={keyed}/_step={step}")
        cols = self.schema.names
        rows = batch.select(*cols).union(self._part(False, [last["step"]]).select(*cols)).union(self._part(True, again).select(*cols))
        found = self._keyed(rows, dim, self.key).withColumn("_keyed", F.col(self.key).isNotNull()).withColumn("_step", F.lit(step))
        writer = found.sortWithinPartitions("_keyed", *self.on, self.ts).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("_keyed", "_step").parquet(f"{self.root}/data")
        parts = [p for p in last["parts"] if p not in again]
        here = [step] if exists(self.spark, f"{self.root}/data/_keyed=true/_step={step}") else []
        fs, marker = hadoop(self.spark, f"{self.root}/commits/v{step}")
        stream = fs.create(marker, False)
        stream.write(bytearray(json.dumps({"step": step, "batch": n, "version": version, "parts": [*parts, *here]}).encode()))
        stream.close()

    def start(self, stream: DataFrame, checkpoint: str) -> StreamingQuery:
        """Take all that the stream has. Batch numbers begin again with a new checkpoint: give that a new ``root``."""
        return stream.writeStream.foreachBatch(self.take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
