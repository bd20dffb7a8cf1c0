"""Versions of loads, their register, and facts that follow replaced loads."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from wattloom.plans import facts, partials
from wattloom.plans.flows import touched_days
from wattloom.sinks import tables as sinks

T0 = datetime(2025, 2, 1)


def home(spark, hours, wh=1.0):
    rows = [(T0 + timedelta(hours=h), 0, wh, wh) for h in hours]
    return spark.createDataFrame(rows, "timestamp TIMESTAMP, interval_15m INT, min_consumption_wh DOUBLE, max_consumption_wh DOUBLE")


def put(lake, load, hours, wh=1.0):
    sinks.append_home(lake, home(lake.spark, hours, wh), "log", [load])


FACT = "fact_home_power_readings"


def follow(lake):
    """Reload of the home fact with a fixed key; the facts afterwards."""
    with partials.pending(lake, FACT) as change:
        rows = change.merged.select(F.col("bucket").alias("home_power_reading_key"), F.lit(1).alias("home_key"), F.col("bucket").alias("date_key"), *partials.HOME_SUMS)
        lake.replace_fact(rows, FACT, change.touched)
    return {r.date_key: r.min_consumption_power_wh for r in lake.read(FACT).collect()}


def whole(lake):
    rows = facts.staged_home(lake.read("home_power_readings"))
    return {r.bucket: r.min_consumption_power_wh for r in rows.collect()}


def test_facts_follow_every_replacement(lake):
    put(lake, "a", [0, 1, 2, 800])
    put(lake, "b", [1, 2, 3], wh=10.0)
    assert follow(lake) == whole(lake) and len(whole(lake)) == 5
    put(lake, "a", [1])  # loses buckets, one of them its month
    assert follow(lake) == whole(lake) == {T0 + timedelta(hours=h): w for h, w in ((1, 11.0), (2, 10.0), (3, 10.0))}
    assert not sinks.exists(lake.spark, f"{lake.path(FACT)}/month=2025-03-01")
    put(lake, "b", [])
    assert follow(lake) == whole(lake) == {T0 + timedelta(hours=1): 1.0}
    put(lake, "a", [])
    assert follow(lake) == {} and follow(lake) == {}
    put(lake, "c", [5])
    assert follow(lake) == whole(lake) == {T0 + timedelta(hours=5): 1.0}


def test_only_pending_loads_are_read(lake, monkeypatch):
    put(lake, "a", [0, 1])
    follow(lake)
    put(lake, "b", [1, 2])
    read = []
    kind = partials.KINDS[FACT]
    spy = lambda rows, by: read.extend(rows.inputFiles()) or kind.partial(rows, by)
    monkeypatch.setitem(partials.KINDS, FACT, partials.Kind(kind.raw, kind.by, kind.schema, spy, kind.merge, kind.keys))
    assert follow(lake) == whole(lake)
    assert read and all("load=b" in f for f in read)
    read.clear()
    assert follow(lake) == whole(lake) and not read


def test_a_run_that_dies_is_run_again(lake):
    put(lake, "a", [0, 1])
    follow(lake)
    put(lake, "a", [1, 2])
    with pytest.raises(RuntimeError), partials.pending(lake, FACT) as change:
        rows = change.merged.select(F.col("bucket").alias("home_power_reading_key"), F.lit(1).alias("home_key"), F.col("bucket").alias("date_key"), *partials.HOME_SUMS)
        lake.replace_fact(rows, FACT, change.touched)
        raise RuntimeError("lost")
    put(lake, "a", [3])  # replaced again before the rerun: buckets 1 and 2 are known from what the dead run left
    assert follow(lake) == whole(lake) == {T0 + timedelta(hours=3): 1.0}


def test_battery_states_merge_with_the_same_ties(lake):
    schema = "timestamp TIMESTAMP, interval_15m INT, battery_name STRING, capacity_kwh DOUBLE, max_charge_speed_w DOUBLE, current_energy_wh DOUBLE, is_charging INT, status STRING, max_output_w DOUBLE"
    for load in ("a", "b", "c"):
        rows = [(T0 + timedelta(minutes=m), 0, f"battery_{b}", 1.0, 1.0, float(ord(load) * 100 + m + b), 0, load, 1.0) for m in (0, 5, 20) for b in (1, 2)]
        sinks.append_battery(lake, lake.spark.createDataFrame(rows, schema), [load])
    want = {(r.bucket, r.battery_name): r.status for r in facts.staged_battery(lake.read("battery_readings")).collect()}
    with partials.pending(lake, "fact_battery_power_readings") as change:
        assert {(r.bucket, r.battery_name): r.status for r in change.merged.collect()} == want and len(want) == 4


def test_a_load_counts_when_all_is_written(lake):
    put(lake, "a", [0, 1])
    store = lake.loads("home_power_readings")
    before = store.read().collect()
    dead = store.read().withColumn("version", F.lit(store.next_version())).limit(1)
    store.write(dead, {"a": store.next_version()}, ["timestamp"])
    assert sorted(store.read().collect()) == sorted(before)
    put(lake, "a", [7])
    assert [r.timestamp for r in store.read().collect()] == [T0 + timedelta(hours=7)]


def test_the_version_before_stays_for_readers(lake):
    put(lake, "a", [0])
    old = lake.read("home_power_readings")
    put(lake, "a", [1, 2])
    assert old.count() == 1 and lake.read("home_power_readings").count() == 2
    for n in range(3):
        put(lake, "a", [n])
    assert lake.spark.read.parquet(lake.path("home_power_readings")).select("version").distinct().count() == 2


def test_the_register_knows_former_and_streamed_days(lake):
    put(lake, "log-2025-02-03", [0, 48])
    put(lake, "log-2025-02-03", [48])
    put(lake, "home-stream-0", [24, 72, 96])
    put(lake, "log-2025-02-09", [1])
    assert touched_days(lake, "2025-02-03") == ["2025-02-01", "2025-02-03"]
    assert touched_days(lake, "2025-02-05") == ["2025-02-02", "2025-02-04", "2025-02-05"]
    assert touched_days(lake, "2025-02-20") == ["2025-02-20"]
    assert sinks.drop_days(lake, "home_power_readings", "2025-02-03") == 2
    assert {r.day for r in lake.read("home_power_readings").select("day").distinct().collect()} == {date(2025, 2, d) for d in (3, 4, 5)}
