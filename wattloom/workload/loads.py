"""Loads that come late, in parts, twice or before their dimension, through the stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.operators import bucketing, scd2
from wattloom.operators.merge import changelog
from wattloom.plans.flows import load_calendar, load_panels, retain, run_raw, run_warehouse
from wattloom.sinks import tables as sinks
from wattloom.sinks.tables import Lake
from wattloom.sources import readings as src
from wattloom.workload.base import DEVICES, INCOMING, NOW, READINGS, Tables, query
from wattloom.workload.dims import CLOSED, KEY, OPENED
from wattloom.workload.facts import at
from wattloom.workload.files import F4, FLOW_SQL, battery_log, doubled, fact_rows, power_log, write_json

MIDDLE = "2024-01-16"


def files_of(t: Tables, readings: DataFrame, date: str, inputs: str) -> None:
    for topic, rows in (("home", power_log(readings)), ("solar", power_log(readings)), ("battery", battery_log(readings))):
        write_json(rows, src.source_path(inputs, topic, "log", date))


def in_two_files(t: Tables) -> tuple[Lake, str]:
    """A file of the days up to the middle without every seventh reading, and one of the rest: late samples and later days."""
    inputs, rows = t.scratch("inputs"), t.readings()
    late = (F.col("timestamp") >= at(MIDDLE)) | (F.col("event_id") % 7 == 0)
    files_of(t, rows.filter(~late), "2024-01-15", inputs)
    files_of(t, rows.filter(late), "2024-01-31", inputs)
    return Lake(t.spark, t.scratch("lake")), inputs


@query("raw_late_samples", f"""WITH {READINGS} SELECT timestamp, interval_15m, {F4.format('min_consumption_wh')} AS min_consumption_wh, {F4.format('min_consumption_wh')} AS max_consumption_wh,
  'log' AS source, CASE WHEN timestamp >= TIMESTAMP '{MIDDLE}' OR event_id % 7 = 0 THEN 'log-2024-01-31' ELSE 'log-2024-01-15' END AS load, CAST(timestamp AS DATE) AS day FROM readings""")
def raw_late_samples(t: Tables) -> DataFrame:
    """The second load holds rows of the first one's days, and comes twice."""
    lake, inputs = in_two_files(t)
    for date in ("2024-01-15", "2024-01-31", "2024-01-31"):
        run_raw(lake, inputs, date, "log")
    return doubled(lake.read("home_power_readings"))


@query("raw_two_files_of_a_day", f"""WITH {READINGS} SELECT battery_name, timestamp, {F4.format('current_energy_wh')} AS current_energy_wh, CAST(timestamp AS DATE) AS day FROM readings""")
def raw_two_files_of_a_day(t: Tables) -> DataFrame:
    """Both files in one load by a glob, then one of them again."""
    lake, inputs = in_two_files(t)
    run_raw(lake, inputs, "2024-01-*", "log")
    run_raw(lake, inputs, "2024-01-15", "log")
    return doubled(lake.read("battery_readings").select("battery_name", "timestamp", "current_energy_wh", "day"))


@query("raw_two_log_panels", f"""WITH {READINGS} SELECT timestamp, p AS panel_id, {F4.format('min_consumption_wh')} AS generation_power_wh, CAST(timestamp AS DATE) AS day
FROM readings, (SELECT unnest([4, 5]) AS p)""")
def raw_two_log_panels(t: Tables) -> DataFrame:
    """The same log file as that of panel 4, then as that of panel 5."""
    lake, inputs = Lake(t.spark, t.scratch("lake")), t.scratch("inputs")
    files_of(t, t.readings(), "all", inputs)
    for panel in (4, 5):
        run_raw(lake, inputs, "all", "log", panel)
    return doubled(lake.read("solar_panel_readings").select("timestamp", "panel_id", "generation_power_wh", "day"))


def one_home(t: Tables) -> DataFrame:
    return t.appliances().withColumn("home_key", F.lit(1))


@query("daily_flows_as_of", FLOW_SQL)
def daily_flows_as_of(t: Tables) -> DataFrame:
    """First load with keys as of the readings: the first versions hold from the beginning, so no key is missing."""
    lake, inputs = Lake(t.spark, t.scratch("lake")), t.scratch("inputs")
    files_of(t, t.readings(), "all", inputs)
    run_raw(lake, inputs, "all", "log")
    run_warehouse(lake, one_home(t), None, NOW, as_of=True)
    return fact_rows(lake)


@query("fact_late_bucket", FLOW_SQL)
def fact_late_bucket(t: Tables) -> DataFrame:
    """Buckets loaded without their late samples are completed by a reload of the days that the second file touches."""
    lake, inputs = in_two_files(t)
    run_raw(lake, inputs, "2024-01-15", "log")
    run_warehouse(lake, one_home(t), "2024-01-15", NOW)
    run_raw(lake, inputs, "2024-01-31", "log")
    run_warehouse(lake, one_home(t), "2024-01-31", NOW, reload=True)
    return fact_rows(lake)


# What is left of the readings after the second file came again with every other reading of it and without its last days.
SHRUNK = """(SELECT * FROM readings WHERE NOT (timestamp >= TIMESTAMP '2024-01-16' OR event_id % 7 = 0)
  OR (event_id % 2 = 0 AND timestamp < TIMESTAMP '2024-01-25'))"""


@query("fact_shrunk_load", FLOW_SQL.replace("FROM readings", f"FROM {SHRUNK} AS readings"))
def fact_shrunk_load(t: Tables) -> DataFrame:
    """A load is replaced by a smaller one: buckets lose a share, or vanish with all their readings."""
    lake, inputs = in_two_files(t)
    for date in ("2024-01-15", "2024-01-31"):
        run_raw(lake, inputs, date, "log")
    run_warehouse(lake, one_home(t), None, NOW, reload=True)
    late = (F.col("timestamp") >= at(MIDDLE)) | (F.col("event_id") % 7 == 0)
    again = t.scratch("inputs")
    files_of(t, t.readings().filter(late & (F.col("event_id") % 2 == 0) & (F.col("timestamp") < at("2024-01-25"))), "2024-01-31", again)
    run_raw(lake, again, "2024-01-31", "log")
    run_warehouse(lake, one_home(t), "2024-01-31", NOW, reload=True)
    return fact_rows(lake)


@query("fact_late_dimension", f"""WITH {READINGS} SELECT p AS panel_id, bucket, round(sum({F4.format('min_consumption_wh')}), 3) AS wh, CAST(p AS BIGINT) * 100000000 + 20240201 AS solar_panel_key
FROM readings, (SELECT unnest([4, 5]) AS p) GROUP BY p, bucket""")
def fact_late_dimension(t: Tables) -> DataFrame:
    """Facts of a panel that the catalogue lacks wait in quarantine until it is there."""
    lake, inputs = Lake(t.spark, t.scratch("lake")), t.scratch("inputs")
    files_of(t, t.readings(), "all", inputs)
    for panel in (4, 5):
        run_raw(lake, inputs, "all", "log", panel)
    run_warehouse(lake, one_home(t), None, NOW)
    new = lake.dim("solar_panel").filter("id = 4").withColumns({"id": F.lit(5), "name": F.lit("late panel")})
    lake.write_dim(lake.dim("solar_panel").unionByName(new), "solar_panel")
    run_warehouse(lake, one_home(t), None, NOW)
    facts = lake.read("fact_solar_panel_power_readings")
    return facts.select(F.col("solar_panel_id").alias("panel_id"), F.col("date_key").alias("bucket"), F.round("generation_power_wh", 3).alias("wh"), "solar_panel_key")


@query("changelog_by_business_id", f"""WITH {DEVICES}, {INCOMING}, {CLOSED}, {OPENED.format(dim='closed')},
after AS (SELECT * FROM closed UNION ALL SELECT * FROM opened),
gone AS (SELECT * FROM devices EXCEPT ALL SELECT * FROM after), come AS (SELECT * FROM after EXCEPT ALL SELECT * FROM devices),
n AS (SELECT device_id, count(*) FILTER (side = 'g') AS g, count(*) FILTER (side = 'c') AS c
  FROM (SELECT device_id, 'g' AS side FROM gone UNION ALL SELECT device_id, 'c' FROM come) GROUP BY device_id)
SELECT x.*, CASE WHEN g = 1 AND c = 1 THEN 'UPDATE_BEFORE' ELSE 'DELETE' END AS _change_type, 0 AS _change_ordinal FROM gone x JOIN n USING (device_id)
UNION ALL BY NAME
SELECT x.*, CASE WHEN g = 1 AND c = 1 THEN 'UPDATE_AFTER' ELSE 'INSERT' END AS _change_type, 0 AS _change_ordinal FROM come x JOIN n USING (device_id)""")
def changelog_by_business_id(t: Tables) -> DataFrame:
    """Ids with several versions: an untouched version gives no row."""
    before = t.devices()
    after = scd2.scd2_apply(before, t.incoming(), ["device_id"], ["balance"], at(NOW), KEY)
    return changelog(before, after, ["device_id"])


@query("latest_state_ties", f"""WITH {READINGS} SELECT panel_id, max(date_trunc('hour', timestamp)) AS timestamp, 1 AS results FROM readings GROUP BY panel_id""")
def latest_state_ties(t: Tables) -> DataFrame:
    """Times cut to the hour, so readings tie; two orders of arrival give the same reading."""
    rows = t.readings().select("panel_id", F.date_trunc("hour", "timestamp").alias("timestamp"), "event_id", "capacity_kwh")
    one = bucketing.latest_state(rows, "panel_id")
    other = bucketing.latest_state(rows.orderBy(F.desc("event_id")), "panel_id")
    both = one.union(other).distinct()
    return both.groupBy("panel_id").agg(F.max("timestamp").alias("timestamp"), F.count("*").cast("int").alias("results"))


@query("calendar_table", """SELECT unnest(generate_series(TIMESTAMP '2024-01-01', max(date_trunc('day', ts)) + INTERVAL '23 hours 45 minutes', INTERVAL '15 minutes')) AS date_key FROM events""")
def calendar_table(t: Tables) -> DataFrame:
    """Stored twice; the second version is longer."""
    lake = Lake(t.spark, t.scratch("lake"))
    last = t["events"].agg(F.max(F.to_date("ts")).cast("string")).first()[0]
    load_calendar(lake, "2024-01-01 00:00:00", "2024-01-02 23:45:00")
    load_calendar(lake, "2024-01-01 00:00:00", f"{last} 23:45:00")
    return lake.dim("dim_date").select("date_key")


@query("retained_table", f"""WITH {READINGS} SELECT panel_id, timestamp, {F4.format('generation_power_wh')} AS generation_power_wh FROM readings WHERE CAST(timestamp AS DATE) >= DATE '2024-01-14'""")
def retained_table(t: Tables) -> DataFrame:
    """What is left on disk after old day folders are removed."""
    lake = Lake(t.spark, t.scratch("lake"))
    load_panels(lake)
    sinks.append_solar(lake, sinks.solar_rows(t.readings(), "file"), "file")
    retain(lake, "2024-01-14")
    return doubled(lake.read("solar_panel_readings").select("panel_id", "timestamp", "generation_power_wh"))
