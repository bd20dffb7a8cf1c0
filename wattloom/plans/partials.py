"""Facts as a merge of partial facts, one set per load.

A partial fact is what one load says of one device and bucket: sums, or the last state. The fact is the merge of all loads'
partials, so a load that is replaced takes its own share back and no other load's readings are read again. The partials of a load carry the
version of the raw load that they come from; loads with another version, or none, are pending.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattloom.functions.keys import device_id_from_name
from wattloom.functions.timebucket import month_start
from wattloom.operators.bucketing import newest_in, sum_per_bucket
from wattloom.plans.facts import STATE
from wattloom.session import scratch
from wattloom.sinks.loads import LoadStore
from wattloom.sinks.tables import Lake


@dataclass(frozen=True)
class Kind:
    """How a fact's partials are made from readings and merged; ``keys`` gives the fact's key columns from a partial's."""

    raw: str
    by: tuple[str, ...]
    schema: str
    partial: Callable[[DataFrame, list[str]], DataFrame]
    merge: Callable[[DataFrame, list[str]], DataFrame]
    keys: dict[str, str]


def _sums(inputs: dict[str, str]) -> tuple[Callable, Callable]:
    def partial(readings: DataFrame, by: list[str]) -> DataFrame:
        return sum_per_bucket(readings, by, inputs, "timestamp")

    def merge(partials: DataFrame, by: list[str]) -> DataFrame:
        return partials.groupBy(*by, "bucket").agg(*(F.sum(c).alias(c) for c in inputs))

    return partial, merge


def _last(readings: DataFrame, by: list[str]) -> DataFrame:
    rows = readings.select(*(c for c in by if c not in STATE), *STATE, "day")
    return newest_in(rows, by, "timestamp", [*STATE, "day"])


def _last_of(partials: DataFrame, by: list[str]) -> DataFrame:
    """The same rule for ties as over all readings: the rows compared are the same."""
    return newest_in(partials.select(*STATE, "day"), by, "timestamp", [*STATE, "day"])


HOME_SUMS = {"min_consumption_power_wh": "min_consumption_wh", "max_consumption_power_wh": "max_consumption_wh"}
SOLAR_SUMS = {"generation_power_wh": "generation_power_wh"}
KINDS = {
    "fact_home_power_readings": Kind(
        "home_power_readings", (), "bucket TIMESTAMP, min_consumption_power_wh DOUBLE, max_consumption_power_wh DOUBLE, load STRING, month DATE",
        *_sums(HOME_SUMS), {"home_power_reading_key": "bucket"}),
    "fact_solar_panel_power_readings": Kind(
        "solar_panel_readings", ("panel_id",), "panel_id INT, bucket TIMESTAMP, generation_power_wh DOUBLE, load STRING, month DATE",
        *_sums(SOLAR_SUMS), {"solar_panel_id": "panel_id", "date_key": "bucket"}),
    "fact_battery_power_readings": Kind(
        "battery_readings", ("battery_name",),
        "battery_name STRING, bucket TIMESTAMP, timestamp TIMESTAMP, current_energy_wh FLOAT, is_charging SMALLINT, status STRING, day DATE, load STRING, month DATE",
        _last, _last_of, {"battery_id": "battery_name", "date_key": "bucket"}),
}


def store(lake: Lake, fact: str) -> LoadStore:
    return LoadStore(lake.spark, f"{lake.root.rstrip('/')}/partial/{fact}", T.StructType.fromDDL(KINDS[fact].schema), "month")


@dataclass(frozen=True)
class Change:
    """``merged``: staged facts of the buckets that pending loads touch; ``touched``: the fact keys of all these buckets, with or without readings left."""

    merged: DataFrame
    touched: DataFrame


@contextmanager
def pending(lake: Lake, fact: str) -> Iterator[Change]:
    """What new and replaced loads change in a fact. Leaving the block without an error makes their partials count.

    Only readings of pending loads are read. Their partials are written first and count last, so a run that dies in between is simply run
    again; buckets that it has touched are found by the partials it left.
    """
    kind, own = KINDS[fact], store(lake, fact)
    raw, have = lake.loads(kind.raw).versions(), own.versions()
    todo = {load: n for load, n in raw.items() if have.get(load) != n}
    gone = [load for load in have if load not in raw]
    by = list(kind.by)

    if todo:
        rows = kind.partial(lake.loads(kind.raw).read(todo, version=True), ["load", "version", *by])
        own.write(rows.withColumn("month", month_start(F.col("bucket"))).select(*own.schema.names, "version"), todo, ["bucket"])

    touched = _stored(lake, own.any_version([*todo, *gone]).select(*by, "bucket", "month").distinct(), "touched")
    months = [r["month"] for r in touched.select("month").distinct().collect()]
    now = own.read({**{load: n for load, n in have.items() if load in raw}, **todo}).filter(F.col("month").isin(months)) if months else own.read({})
    # A home's buckets have no device; the bucket alone is the key then.
    merged = kind.merge(now.join(touched.select(*by, "bucket"), [*by, "bucket"], "left_semi"), by)
    names = {"battery_id": device_id_from_name(F.col("battery_name"))} if "battery_name" in by else {}
    keys = touched.select(*(names.get(new, F.col(old)).alias(new) for new, old in kind.keys.items())).distinct()
    yield Change(merged, keys)
    own.commit(todo)


def _stored(lake: Lake, df: DataFrame, name: str) -> DataFrame:
    path = scratch(lake.spark, name)
    df.write.parquet(path)
    return lake.spark.read.schema(df.schema).parquet(path)
