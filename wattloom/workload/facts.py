"""Fact loads, last and latest states, look-ups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattloom.functions.predicates import current, select_as
from wattloom.operators import bucketing, joins, merge, scd2
from wattloom.plans import dims, facts
from wattloom.schemas import no_rows
from wattloom.sinks.tables import Lake
from wattloom.workload.base import APPLIANCES, DEVICES, LOADED_UNTIL, NOW, READINGS, Tables, query


def at(text: str) -> Column:
    return F.lit(text).cast("timestamp")


def loaded(readings: DataFrame) -> DataFrame:
    return readings.filter(F.col("timestamp") < F.lit(LOADED_UNTIL).cast("timestamp"))


def panel_dim(t: Tables) -> DataFrame:
    return select_as(t.devices(), {
        "solar_panel_key": "device_key", "solar_panel_id": "device_id",
        "start_date": "start_date", "end_date": "end_date", "current_flag": "current_flag",
    })


def battery_dim(t: Tables) -> DataFrame:
    return panel_dim(t).withColumnsRenamed({"solar_panel_key": "battery_key", "solar_panel_id": "battery_id"})


def one_home(t: Tables) -> DataFrame:
    """All appliances in one household, as a stored dimension."""
    lake = Lake(t.spark, t.scratch("lake"))
    all_in_one = t.appliances().withColumn("home_key", F.lit(1))
    lake.write_dim(dims.dim_home(lake.dim("dim_home"), all_in_one, at(NOW)), "dim_home")
    return lake.dim("dim_home")


def rounded(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 4) for c in cols})


def known(df: DataFrame, key: str) -> DataFrame:
    """-1 for a missing key, so that whole numbers stay whole in any comparison."""
    return df.withColumn(key, F.coalesce(key, F.lit(-1)))


@query("home_fact_15m", f"""WITH {READINGS},
staged AS (SELECT bucket, sum(min_consumption_wh) AS lo, sum(max_consumption_wh) AS hi FROM readings GROUP BY bucket),
target AS (SELECT bucket, sum(min_consumption_wh) AS lo, sum(max_consumption_wh) AS hi FROM readings
  WHERE timestamp < TIMESTAMP '{LOADED_UNTIL}' GROUP BY bucket),
merged AS (SELECT * FROM target UNION ALL
  SELECT * FROM staged s WHERE NOT EXISTS (SELECT 1 FROM target x WHERE x.bucket = s.bucket))
SELECT bucket AS home_power_reading_key, CAST(1 AS BIGINT) AS home_key, bucket AS date_key,
  round(lo, 4) AS min_consumption_power_wh, round(hi, 4) AS max_consumption_power_wh FROM merged""")
def home_fact_15m(t: Tables) -> DataFrame:
    readings, dim = t.readings(), one_home(t)
    target = facts.home_rows(loaded(readings), dim)
    rows = target.unionByName(facts.fact_home(target, readings, dim))
    return rounded(rows, "min_consumption_power_wh", "max_consumption_power_wh")


SOLAR_STAGED = """staged AS (SELECT panel_id, bucket, sum(generation_power_wh) AS wh FROM readings GROUP BY panel_id, bucket)"""


@query("solar_fact_15m", f"""WITH {READINGS}, {DEVICES}, {SOLAR_STAGED},
target AS (SELECT panel_id, bucket, sum(generation_power_wh) AS wh FROM readings
  WHERE timestamp < TIMESTAMP '{LOADED_UNTIL}' GROUP BY panel_id, bucket),
merged AS (SELECT * FROM target UNION ALL SELECT * FROM staged s
  WHERE NOT EXISTS (SELECT 1 FROM target x WHERE x.panel_id = s.panel_id AND x.bucket = s.bucket))
SELECT coalesce(d.device_key, -1) AS solar_panel_key, m.bucket AS date_key, m.panel_id AS solar_panel_id, round(m.wh, 4) AS generation_power_wh
FROM merged m LEFT JOIN devices d ON d.device_id = m.panel_id AND d.current_flag""")
def solar_fact_15m(t: Tables) -> DataFrame:
    readings, dim = t.readings(), panel_dim(t)
    target = facts.solar_rows(loaded(readings), dim)
    rows = target.unionByName(facts.fact_solar(target, readings, dim))
    return rounded(known(rows, "solar_panel_key"), "generation_power_wh")


@query("solar_fact_as_of", f"""WITH {READINGS}, {DEVICES}, {SOLAR_STAGED}
SELECT coalesce(d.device_key, -1) AS solar_panel_key, s.bucket AS date_key, s.panel_id AS solar_panel_id, round(s.wh, 4) AS generation_power_wh
FROM staged s LEFT JOIN devices d ON d.device_id = s.panel_id AND s.bucket >= d.start_date AND (d.end_date IS NULL OR s.bucket < d.end_date)""")
def solar_fact_as_of(t: Tables) -> DataFrame:
    rows = facts.solar_rows(t.readings(), panel_dim(t), as_of=True)
    return rounded(known(rows, "solar_panel_key"), "generation_power_wh")


@query("fact_reload", f"""WITH {READINGS}, {DEVICES}, {SOLAR_STAGED}
SELECT coalesce(d.device_key, -1) AS solar_panel_key, s.bucket AS date_key, s.panel_id AS solar_panel_id, round(s.wh, 4) AS generation_power_wh
FROM staged s LEFT JOIN devices d ON d.device_id = s.panel_id AND d.current_flag""")
def fact_reload(t: Tables) -> DataFrame:
    """The half-full bucket of the first load is put right."""
    readings, dim = t.readings(), panel_dim(t)
    target = facts.solar_rows(loaded(readings), dim)
    rows = facts.reloaded(target, facts.solar_rows(readings, dim), ["solar_panel_id", "date_key"])
    return rounded(known(rows, "solar_panel_key"), "generation_power_wh")


LAST = """ranked AS (SELECT *, row_number() OVER (PARTITION BY bucket, battery_name ORDER BY timestamp DESC, event_id DESC) AS rn FROM readings),
last_rows AS (SELECT * FROM ranked WHERE rn = 1)"""


@query("battery_fact_15m", f"""WITH {READINGS}, {DEVICES}, {LAST},
early AS (SELECT *, row_number() OVER (PARTITION BY bucket, battery_name ORDER BY timestamp DESC, event_id DESC) AS rn2
  FROM readings WHERE timestamp < TIMESTAMP '{LOADED_UNTIL}'),
target AS (SELECT * FROM early WHERE rn2 = 1),
merged AS (
  SELECT panel_id, bucket, current_energy_wh, is_charging, status FROM target UNION ALL
  SELECT panel_id, bucket, current_energy_wh, is_charging, status FROM last_rows s
  WHERE NOT EXISTS (SELECT 1 FROM target x WHERE x.panel_id = s.panel_id AND x.bucket = s.bucket))
SELECT coalesce(d.device_key, -1) AS battery_key, m.bucket AS date_key, m.panel_id AS battery_id, m.current_energy_wh, m.is_charging, m.status
FROM merged m LEFT JOIN devices d ON d.device_id = m.panel_id AND d.current_flag""")
def battery_fact_15m(t: Tables) -> DataFrame:
    """Two loads into a stored table; the second finds the keys of the first."""
    readings, dim, tie, name = t.readings(), battery_dim(t), ["event_id"], "fact_battery_power_readings"
    lake = Lake(t.spark, t.scratch("lake"))
    lake.append_fact(facts.battery_rows(loaded(readings), dim, tie_break=tie), name)
    lake.append_fact(facts.fact_battery(lake.read(name), readings, dim, tie_break=tie), name)
    return known(lake.read(name).drop("month"), "battery_key")


@query("last_per_bucket", f"""WITH {READINGS}, {LAST}
SELECT bucket, battery_name, event_id, timestamp, current_energy_wh, status FROM last_rows""")
def last_per_bucket(t: Tables) -> DataFrame:
    cols = t.readings().select("battery_name", "event_id", "timestamp", "current_energy_wh", "status")
    return bucketing.last_per_bucket(cols, "battery_name", tie_break=["event_id"])


@query("latest_state", f"""WITH {READINGS},
ranked AS (SELECT *, row_number() OVER (PARTITION BY battery_name ORDER BY timestamp DESC, event_id DESC) AS rn FROM readings)
SELECT battery_name, event_id, timestamp, capacity_kwh, max_charge_speed_w, max_output_w FROM ranked WHERE rn = 1""")
def latest_state(t: Tables) -> DataFrame:
    cols = t.readings().select("battery_name", "event_id", "timestamp", "capacity_kwh", "max_charge_speed_w", "max_output_w")
    return bucketing.latest_state(cols, "battery_name", tie_break=["event_id"])


@query("latest_samples", f"""WITH {READINGS}
SELECT event_id, timestamp, battery_name, current_energy_wh FROM readings ORDER BY timestamp DESC, event_id DESC LIMIT 3""")
def latest_samples(t: Tables) -> DataFrame:
    cols = t.readings().select("event_id", "timestamp", "battery_name", "current_energy_wh")
    return bucketing.latest_n(cols, 3, tie_break=["event_id"])


@query("as_of_join", f"""WITH {READINGS}, {DEVICES}
SELECT r.event_id, r.timestamp, r.panel_id, coalesce(d.device_key, -1) AS device_key, d.balance FROM readings r
LEFT JOIN devices d ON d.device_id = r.panel_id AND r.timestamp >= d.start_date AND (d.end_date IS NULL OR r.timestamp < d.end_date)""")
def as_of_join(t: Tables) -> DataFrame:
    readings = t.readings().select("event_id", "timestamp", "panel_id")
    rows = scd2.scd2_as_of_join(readings, t.devices(), {"panel_id": "device_id"}, "timestamp", ["device_key", "balance"])
    return known(rows, "device_key")


@query("current_key_join", f"""WITH {READINGS}, {DEVICES}, {SOLAR_STAGED}
SELECT s.panel_id, s.bucket, round(s.wh, 4) AS generation_power_wh, coalesce(d.device_key, -1) AS device_key
FROM staged s LEFT JOIN (SELECT * FROM devices WHERE current_flag) d ON d.device_id = s.panel_id""")
def current_key_join(t: Tables) -> DataFrame:
    staged = bucketing.solar_15m(t.readings())
    rows = joins.attach_current_key(staged, t.devices(), {"panel_id": "device_id"}, "device_key")
    return rounded(known(rows, "device_key"), "generation_power_wh")


@query("left_join_current", f"""WITH {READINGS}, {DEVICES}, {LAST}
SELECT l.bucket, l.panel_id AS device_id, l.current_energy_wh, coalesce(d.device_key, -1) AS device_key, d.name, d.balance, d.start_date
FROM last_rows l LEFT JOIN devices d ON l.panel_id = d.device_id AND d.current_flag""")
def left_join_current(t: Tables) -> DataFrame:
    cols = t.readings().select("panel_id", "event_id", "timestamp", "current_energy_wh")
    last = bucketing.last_per_bucket(cols, "panel_id", tie_break=["event_id"])
    last = last.select("bucket", F.col("panel_id").alias("device_id"), "current_energy_wh")
    rows = joins.left_join_current(last, t.devices(), ["device_id"])
    return known(rows, "device_key").drop("end_date", "current_flag")


@query("home_key_lookup", f"""WITH {READINGS}, {APPLIANCES},
home AS (SELECT CAST(count(*) * 0 + 1 AS BIGINT) AS home_key FROM appliances)
SELECT bucket, count(*) AS n, (SELECT home_key FROM home) AS home_key FROM readings GROUP BY bucket""")
def home_key_lookup(t: Tables) -> DataFrame:
    rows = bucketing.sum_per_bucket(t.readings().withColumn("one", F.lit(1)), [], {"n": "one"}, "timestamp")
    rows = rows.select("bucket", F.col("n").cast("bigint").alias("n"))
    return joins.attach_scalar(rows, current(one_home(t)).select("home_key"), "home_key")


@query("insert_new_idempotent", f"""WITH {READINGS}, {SOLAR_STAGED}
SELECT panel_id, bucket, round(wh, 4) AS generation_power_wh FROM staged""")
def insert_new_idempotent(t: Tables) -> DataFrame:
    """A second run of the same load adds nothing."""
    rows, keys = rounded(bucketing.solar_15m(t.readings()), "generation_power_wh"), ["panel_id", "bucket"]
    once = merge.insert_new(no_rows(t.spark, rows.schema), rows, keys)
    return once.unionByName(merge.insert_new(once, rows, keys))


@query("insert_new_orders", """WITH target AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '1997-01-01')
SELECT s.o_orderkey, s.o_custkey, s.o_totalprice FROM orders s
WHERE NOT EXISTS (SELECT 1 FROM target x WHERE x.o_orderkey = s.o_orderkey)""")
def insert_new_orders(t: Tables) -> DataFrame:
    orders = t["orders"]
    target = orders.filter(F.col("o_orderdate") < F.lit("1997-01-01").cast("timestamp_ntz"))
    return merge.insert_new(target, orders.select("o_orderkey", "o_custkey", "o_totalprice"), ["o_orderkey"])
