"""Raw, fact and dimension tables as parquet folders below one root."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattloom.functions.energy import watts_to_wh
from wattloom.functions.timebucket import month_start
from wattloom.operators.quality import CORRUPT
from wattloom.schemas import TABLES, as_table, empty_table, no_rows
from wattloom.session import scratch
from wattloom.sinks.loads import LoadStore, exists, hadoop, names_in, remove
from wattloom.sources.catalogues import LOG_PANEL_ID


@dataclass(frozen=True)
class Lake:
    """Where the tables are. ``root`` is a folder that all executors reach."""

    spark: SparkSession
    root: str

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{TABLES[table].layer}/{table}"

    def read(self, table: str) -> DataFrame:
        """A raw or fact table; empty when nothing was written yet."""
        if "load" in TABLES[table].partitions:
            return self.loads(table).read()
        return open_table(self.spark, self.path(table), TABLES[table].schema)

    def loads(self, table: str) -> LoadStore:
        """The loads that a raw table is made of."""
        return LoadStore(self.spark, self.path(table), TABLES[table].schema)

    def dim(self, table: str) -> DataFrame:
        """Last committed version of a dimension."""
        n = self._version(table)
        return empty_table(self.spark, table) if n == 0 else self.dim_at(table, n)

    def dim_at(self, table: str, version: int) -> DataFrame:
        parts = self._parts(table, version)
        return self._read_parts(table, [f"v{parts['live']}/part=live", *(f"v{k}/part=past" for k in parts["past"])])

    def current(self, table: str) -> DataFrame:
        """The current rows of a type-2 dimension; closed history is not read."""
        n = self._version(table)
        return empty_table(self.spark, table) if n == 0 else self._read_parts(table, [f"v{self._parts(table, n)['live']}/part=live"])

    def versions(self, table: str) -> int:
        return self._version(table)

    def write_dim(self, df: DataFrame, table: str) -> int:
        """Write a whole dimension as a new version and make it the current one.

        The folder being read is never overwritten. A version counts once its marker file is there, so a job that dies
        half-way leaves the old version in place and its own folder is replaced by the next run. One writer at a
        time: a second one fails when it makes the same marker.
        """
        return self._commit(df, table, [])

    def write_changes(self, df: DataFrame, table: str) -> int:
        """Write the next version of a type-2 dimension from its current rows and those that a load has closed.

        Closed history is append-only: a version names the parts that it is made of, so a load writes the current rows and
        what it closes, however much history there is. :meth:`compact` puts the parts together.
        """
        n = self._version(table)
        return self._commit(df, table, self._parts(table, n)["past"] if n else [])

    def compact(self, table: str, most: int = 16) -> bool:
        """Put the parts of a dimension's history together once there are more than ``most``; whether it did."""
        n = self._version(table)
        if n == 0 or len(self._parts(table, n)["past"]) <= most:
            return False
        self.write_dim(self.dim(table), table)
        return True

    def _commit(self, df: DataFrame, table: str, past: list[int]) -> int:
        n = self._version(table) + 1
        folder = f"{self.path(table)}/data/v{n}"
        rows = as_table(df, table)
        live = F.when(F.col("current_flag"), "live").otherwise("past") if "current_flag" in rows.columns else F.lit("live")
        rows.withColumn("part", live).write.mode("overwrite").partitionBy("part").parquet(folder)
        closed = [n] if exists(self.spark, f"{folder}/part=past") else []
        fs, marker = hadoop(self.spark, f"{self.path(table)}/commits/v{n}")
        stream = fs.create(marker, False)
        stream.write(bytearray(json.dumps({"live": n, "past": [*past, *closed]}).encode()))
        stream.close()
        return n

    def _parts(self, table: str, version: int) -> dict:
        fs, marker = hadoop(self.spark, f"{self.path(table)}/commits/v{version}")
        stream = fs.open(marker)
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def _read_parts(self, table: str, parts: list[str]) -> DataFrame:
        """A part without rows has no folder."""
        data = f"{self.path(table)}/data"
        there = [f"{data}/{p}" for p in parts if exists(self.spark, f"{data}/{p}")]
        return self.spark.read.schema(TABLES[table].schema).parquet(*there) if there else empty_table(self.spark, table)

    def append_fact(self, new: DataFrame, table: str) -> None:
        """Append fact rows, split by month and ordered by key in each file.

        The rebalance hint lets adaptive execution cut a big month and gather small ones.
        """
        placed = as_table(new.withColumn("month", month_start(F.col("date_key"))), table)
        keys = [k for k in TABLES[table].keys]
        write_partitioned(placed.hint("rebalance", "month"), self.path(table), ["month"], keys, "append")

    def replace_fact(self, rows: DataFrame, table: str, gone: DataFrame | None = None) -> None:
        """Fact rows in place of those of the same key, or of all keys in ``gone``; only the months of these keys are written again.

        The new months are written beside the table first, as a folder can't be read and replaced at once. A month that is left without rows goes.
        """
        keys = [*TABLES[table].keys]
        rows = as_table(rows.withColumn("month", month_start(F.col("date_key"))), table)
        out = rows.select(*keys, "month")
        if gone is not None:
            stamp = "date_key" if "date_key" in keys else keys[0]
            out = out.union(gone.select(*keys, month_start(F.col(stamp)).alias("month"))).distinct()
        months = [r["month"] for r in out.select("month").distinct().collect()]
        if not months:
            return
        kept = self.read(table).filter(F.col("month").isin(months))
        staged = scratch(self.spark, table)
        kept.join(out.select(*keys), keys, "left_anti").select(*rows.columns).unionByName(rows).write.parquet(staged)
        fresh = self.spark.read.schema(rows.schema).parquet(staged)
        write_partitioned(fresh.hint("rebalance", "month"), self.path(table), ["month"], keys, "overwrite")
        left = {r["month"] for r in fresh.select("month").distinct().collect()}
        for month in set(months) - left:
            remove(self.spark, f"{self.path(table)}/month={month}")

    def _version(self, table: str) -> int:
        names = names_in(self.spark, f"{self.path(table)}/commits")
        return max((int(n[1:]) for n in names if n.startswith("v")), default=0)

    def expire(self, table: str, keep: int = 7) -> int:
        """Remove all but the newest versions of a dimension; how many went. Parts that a kept version is made of stay."""
        newest = self._version(table)
        kept = [self._parts(table, n) for n in range(max(1, newest - keep + 1), newest + 1)]
        used = {f"v{p['live']}/part=live" for p in kept} | {f"v{k}/part=past" for p in kept for k in p["past"]}
        gone, data = 0, f"{self.path(table)}/data"
        for n in range(1, newest - keep + 1):
            parts = {f"v{n}/{name}" for name in names_in(self.spark, f"{data}/v{n}") if name.startswith("part=")}
            gone += any(p.endswith("=live") for p in parts - used)
            for p in parts - used:
                remove(self.spark, f"{data}/{p}")
        return gone


def open_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A parquet folder; no rows when it is not there."""
    return spark.read.schema(schema).parquet(path) if exists(spark, path) else no_rows(spark, schema)


def write_partitioned(df: DataFrame, path: str, by: list[str], order: list[str], mode: str) -> None:
    """Parquet folders by ``by``. Rows are ordered inside each task, which also groups equal values for
    the encoder; in ``overwrite`` mode only the folders that the rows touch are replaced."""
    writer = df.sortWithinPartitions(*by, *order).write.mode(mode).partitionBy(*by)
    if mode == "overwrite":
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def _load_raw(lake: Lake, df: DataFrame, table: str, source: str, order: list[str], loads: list[str] | None) -> None:
    """Put readings in place of what the same loads brought before.

    A load is what comes in one file. Its rows may be of any days; a second run replaces the load as a whole, also by nothing, and
    touches no other. Rows name their load in ``load``; without it all of them are one load, named by the first of ``loads``
    or the source. No shuffle: a file of one day stays in its tasks. The new rows are written beside the old ones and count once all are there.
    """
    loads = loads or [source]
    placed = df.withColumn("day", F.to_date("timestamp")).withColumn("source", F.lit(source))
    if "load" not in df.columns:
        placed = placed.withColumn("load", F.lit(loads[0]))
    store = lake.loads(table)
    version = store.next_version()
    made = dict.fromkeys(loads, version)
    store.write(as_table(placed, table).withColumn("version", F.lit(version)), made, order)
    store.commit(made)


def drop_days(lake: Lake, table: str, before: str) -> int:
    """Remove the raw day folders before a date; how many there were. Facts and dimensions stay."""
    return lake.loads(table).drop_parts(before)


def _carried(df: DataFrame) -> list[str]:
    return [c for c in (CORRUPT, "load") if c in df.columns]


def home_rows(df: DataFrame, kind: str, sample_seconds: float | None = None) -> DataFrame:
    """Raw home columns. The log's one watt column is both minimum and maximum, stored as it is
    unless ``sample_seconds`` asks for watt-hours."""
    if kind == "file":
        return df.select("timestamp", "interval_15m", "min_consumption_wh", "max_consumption_wh", *_carried(df))
    wh = watts_to_wh(F.col("current_consumption_w"), sample_seconds)
    return df.select(
        F.col("time_stamp").alias("timestamp"), "interval_15m",
        wh.alias("min_consumption_wh"), wh.alias("max_consumption_wh"), *_carried(df),
    )


def solar_rows(df: DataFrame, kind: str, panel_id: int = LOG_PANEL_ID, sample_seconds: float | None = None) -> DataFrame:
    """Raw solar columns; the log source is all of one panel, and the panel is part of its load's name."""
    if kind == "file":
        return df.select("timestamp", "interval_15m", "panel_id", "generation_power_wh", *_carried(df))
    wh = watts_to_wh(F.col("current_consumption_w"), sample_seconds)
    if "load" in df.columns:
        df = df.withColumn("load", F.concat(F.lit(panel_load("", panel_id)), "load"))
    return df.select(
        F.col("time_stamp").alias("timestamp"), "interval_15m",
        F.lit(panel_id).alias("panel_id"), wh.alias("generation_power_wh"), *_carried(df),
    )


def panel_load(load: str, panel_id: int = LOG_PANEL_ID) -> str:
    return f"panel{panel_id}-{load}"


def battery_rows(df: DataFrame) -> DataFrame:
    return df.withColumnRenamed("time_stamp", "timestamp")


def append_home(lake: Lake, rows: DataFrame, kind: str, loads: list[str] | None = None) -> None:
    _load_raw(lake, rows, "home_power_readings", kind, ["timestamp"], loads)


def append_solar(lake: Lake, rows: DataFrame, kind: str, loads: list[str] | None = None) -> None:
    _load_raw(lake, rows, "solar_panel_readings", kind, ["panel_id", "timestamp"], loads)


def append_battery(lake: Lake, rows: DataFrame, loads: list[str] | None = None) -> None:
    _load_raw(lake, rows, "battery_readings", "log", ["battery_name", "timestamp"], loads)


def write_csv_by_interval(df: DataFrame, path: str, interval: str = "interval_15m") -> None:
    """CSV with a header, one folder per quarter-hour index. Times are written as the text they are cast to, which takes a third of a
    formatter's time and which the readers take."""
    texts = {f.name: F.col(f"`{f.name}`").cast("string") for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)}
    df = df.withColumns(texts) if texts else df
    df.write.mode("overwrite").option("header", True).partitionBy(interval).csv(path)


def file_stats(spark: SparkSession, path: str) -> DataFrame:
    """Rows and bytes of each parquet file of a table."""
    meta = spark.read.parquet(path).select("_metadata.file_path", "_metadata.file_size")
    return meta.groupBy("file_path").agg(F.count("*").alias("record_count"), F.first("file_size").alias("file_size"))


def retain_days(df: DataFrame, n: int, as_of: str, day: str = "day") -> DataFrame:
    """Readings of the last ``n`` days up to ``as_of``, a filter on the partition column."""
    last = F.lit(as_of).cast("date")
    return df.filter((F.col(day) > F.date_sub(last, n)) & (F.col(day) <= last))
