"""Streaming forms, run to the end of their input."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from wattloom.plans.flows import load_panels, run_warehouse
from wattloom.sinks import tables as sinks
from wattloom.sinks.tables import Lake, open_table
from wattloom.operators import bucketing
from wattloom.streaming import jobs, keyed, state, upsample, weather
from wattloom.workload.base import DEVICES, NOW, READINGS, Tables, query
from wattloom.workload.files import F4, FLOW_SQL, STAMP, battery_log, doubled, fact_rows, power_log, write_json


def event_stream(t: Tables, copies: int = 1) -> DataFrame:
    """The events file, or folder of files, as a stream."""
    schema = t["events"].schema
    stream = t.spark.readStream.schema(schema).parquet(f"{t.folder}/events*.parquet")
    rows = stream.select(
        "event_id", F.col("ts").cast("timestamp").alias("timestamp"), F.col("user_id").cast("int").alias("panel_id"),
        F.col("value").alias("generation_power_wh"),
    )
    return rows if copies == 1 else rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(copies)))).drop("copy")


@query("stream_tumbling_15m", f"""WITH {READINGS}, mark AS (SELECT max(timestamp) - INTERVAL '10 minutes' AS w FROM readings)
SELECT bucket, panel_id, round(sum(generation_power_wh), 4) AS generation_power_wh FROM readings, mark
WHERE bucket + INTERVAL '15 minutes' <= date_trunc('millisecond', w) GROUP BY bucket, panel_id""")
def stream_tumbling_15m(t: Tables) -> DataFrame:
    """Closed windows only: the last ones stay open behind the watermark."""
    out = t.scratch("stream-out")
    summed = jobs.tumbling_sum(event_stream(t), "panel_id", "generation_power_wh")
    jobs.write_stream(summed, out, t.scratch("stream-state")).awaitTermination()
    rows = t.spark.read.schema("bucket TIMESTAMP, panel_id INT, generation_power_wh DOUBLE").parquet(out)
    return rows.withColumn("generation_power_wh", F.round("generation_power_wh", 4))


@query("stream_drop_repeats", "SELECT event_id, ts AS timestamp, CAST(user_id AS INTEGER) AS panel_id, value AS generation_power_wh FROM events")
def stream_drop_repeats(t: Tables) -> DataFrame:
    """Every event comes three times."""
    out = t.scratch("stream-out")
    jobs.write_stream(jobs.drop_repeats(event_stream(t, 3), ["event_id"]), out, t.scratch("stream-state")).awaitTermination()
    return t.spark.read.schema("event_id BIGINT, timestamp TIMESTAMP, panel_id INT, generation_power_wh DOUBLE").parquet(out)


@query("stream_ingest_logs", f"""WITH {READINGS} SELECT timestamp, {F4.format('min_consumption_wh')} AS wh, CAST(timestamp AS DATE) AS day FROM readings""")
def stream_ingest_logs(t: Tables) -> DataFrame:
    """Log files come in two deliveries; the second run takes up the new files only."""
    logs, state, lake = t.scratch("logs"), t.scratch("stream-state"), Lake(t.spark, t.scratch("lake"))
    log = power_log(t.readings())
    half = F.col("time_stamp") < F.lit("2024-01-16").cast("timestamp")
    for name, part in (("a", log.filter(half)), ("b", log.filter(~half))):
        write_json(part, f"{logs}/{name}")
        stream = jobs.stream_power_log(t.spark, f"{logs}/*")
        ingest_home(lake, stream, state)
    return doubled(lake.read("home_power_readings").select("timestamp", F.col("min_consumption_wh").alias("wh"), "day"))


def ingest_home(lake: Lake, stream: DataFrame, state: str) -> None:
    append = lambda rows, loads: sinks.append_home(lake, rows, "log", loads)
    jobs.start_ingest(lake, stream, lambda df: sinks.home_rows(df, "log"), "home_power_readings", append, "home-stream", state).awaitTermination()


def ingest_solar(lake: Lake, stream: DataFrame, state: str) -> None:
    append = lambda rows, loads: sinks.append_solar(lake, rows, "log", loads)
    jobs.start_ingest(lake, stream, lambda df: sinks.solar_rows(df, "log"), "solar_panel_readings", append, "solar-stream", state).awaitTermination()


def ingest_batteries(lake: Lake, stream: DataFrame, state: str) -> None:
    append = lambda rows, loads: sinks.append_battery(lake, rows, loads)
    jobs.start_ingest(lake, stream, sinks.battery_rows, "battery_readings", append, "battery-stream", state).awaitTermination()


@query("stream_ingest_batteries", f"""WITH {READINGS} SELECT timestamp, battery_name, {F4.format('current_energy_wh')} AS current_energy_wh, CAST(timestamp AS DATE) AS day FROM readings""")
def stream_ingest_batteries(t: Tables) -> DataFrame:
    logs, lake = t.scratch("logs"), Lake(t.spark, t.scratch("lake"))
    write_json(battery_log(t.readings()), logs)
    ingest_batteries(lake, jobs.stream_battery_log(t.spark, logs), t.scratch("stream-state"))
    return doubled(lake.read("battery_readings").select("timestamp", "battery_name", "current_energy_wh", "day"))


@query("stream_ingest_then_warehouse", FLOW_SQL)
def stream_ingest_then_warehouse(t: Tables) -> DataFrame:
    """Logs with torn lines through streams into the raw tables, and from there into the facts."""
    lake, readings = Lake(t.spark, t.scratch("lake")), t.readings()
    logs = {n: t.scratch(n) for n in ("power", "battery")}
    for name, rows in (("power", power_log(readings)), ("battery", battery_log(readings))):
        line = F.to_json(F.struct(*rows.columns), {"timestampFormat": STAMP})
        torn = F.explode(F.when(F.rand(7) < 0.01, F.array(line, F.substring(line, 1, 40))).otherwise(F.array(line)))
        rows.select(torn.alias("value")).write.text(logs[name])
    ingest_home(lake, jobs.stream_power_log(t.spark, logs["power"]), t.scratch("stream-state"))
    ingest_solar(lake, jobs.stream_power_log(t.spark, logs["power"]), t.scratch("stream-state"))
    ingest_batteries(lake, jobs.stream_battery_log(t.spark, logs["battery"]), t.scratch("stream-state"))
    load_panels(lake)
    run_warehouse(lake, t.appliances().withColumn("home_key", F.lit(1)), None, NOW)
    return fact_rows(lake)


STATES = "event_id BIGINT, timestamp TIMESTAMP, panel_id INT, value DOUBLE, props STRING"
SLICES = 5


def in_slices(t: Tables) -> DataFrame:
    """Events as a stream of files that overlap: every other event comes one slice of six days late."""
    folder = t.scratch("slices")
    events = t["events"].select("event_id", F.col("ts").cast("timestamp").alias("timestamp"), F.col("user_id").cast("int").alias("panel_id"), "value", "props")
    late = F.least(F.lit(SLICES - 1), F.floor((F.dayofmonth("timestamp") - 1) / 6) + F.col("event_id") % 2)
    for n in range(SLICES):
        events.filter(late == n).coalesce(1).write.mode("append").parquet(folder)
    return t.spark.readStream.schema(STATES).option("maxFilesPerTrigger", 1).parquet(folder)


def out_of(t: Tables, stream: DataFrame, write: Callable[[DataFrame, str, str], StreamingQuery] = jobs.write_stream) -> DataFrame:
    out = t.scratch("stream-out")
    write(stream, out, t.scratch("stream-state")).awaitTermination()
    return t.spark.read.schema(stream.schema).parquet(out)


@query("stream_last_per_bucket", f"""WITH {READINGS}, mark AS (SELECT max(timestamp) - INTERVAL '13 days' AS w FROM readings),
ranked AS (SELECT *, row_number() OVER (PARTITION BY bucket, panel_id ORDER BY timestamp DESC) AS rn FROM readings)
SELECT bucket, panel_id, event_id, timestamp, current_energy_wh AS value FROM ranked, mark WHERE rn = 1 AND bucket + INTERVAL '15 minutes' <= date_trunc('millisecond', w)""")
def stream_last_per_bucket(t: Tables) -> DataFrame:
    """Buckets that the watermark has closed, from files out of order."""
    rows = out_of(t, state.last_per_bucket(in_slices(t), "panel_id", late="13 days"), jobs.write_processed)
    return rows.select("bucket", "panel_id", "event_id", "timestamp", "value")


@query("stream_latest_state", f"""WITH {READINGS} SELECT panel_id, arg_max(event_id, timestamp) AS event_id, max(timestamp) AS timestamp, arg_max(current_energy_wh, timestamp) AS value FROM readings GROUP BY panel_id""")
def stream_latest_state(t: Tables) -> DataFrame:
    """The last word on each device; states are given up after a silent day and begun anew."""
    rows = out_of(t, state.latest_state(in_slices(t), "panel_id", late="13 days", idle="1 day"), jobs.write_processed)
    return bucketing.latest_state(rows, "panel_id").select("panel_id", "event_id", "timestamp", "value")


@query("stream_upsample", """WITH s AS (SELECT CAST(user_id % 3 AS INTEGER) AS site, epoch_us(ts) // 3600000000 * 3600000000 AS slot, avg(value) AS v FROM events GROUP BY ALL),
sure AS (SELECT s.*, lead(slot) OVER w AS nslot, lead(v) OVER w AS nv FROM s WHERE slot + 3600000000 <= (SELECT epoch_us(date_trunc('millisecond', max(ts) - INTERVAL '13 days')) FROM events) WINDOW w AS (PARTITION BY site ORDER BY slot)),
steps AS (SELECT *, unnest(generate_series(slot, nslot - 3600000000, 3600000000)) AS g FROM sure WHERE nslot IS NOT NULL)
SELECT site, make_timestamp(g) AS timestamp, round(v + (nv - v) * ((g - slot)::DOUBLE / (nslot - slot)), 6) AS value FROM steps""")
def stream_upsample(t: Tables) -> DataFrame:
    """Events of three sites on a grid of hours, from files out of order."""
    rows = in_slices(t).withColumn("site", F.col("panel_id") % 3)
    dense = out_of(t, upsample.upsample(rows, "timestamp", ["value"], 3_600_000_000, ["site"], late="13 days"), jobs.write_processed)
    return dense.withColumn("value", F.round("value", 6))


@query("stream_weather_join", """WITH readings AS (SELECT event_id, ts, CAST(user_id % 3 AS INTEGER) AS site, value FROM events),
hours AS (SELECT site, date_trunc('hour', ts) + INTERVAL '20 minutes' AS h, round(avg(value), 4) AS temp FROM readings WHERE event_id % 4 = 0 GROUP BY ALL),
mark AS (SELECT date_trunc('millisecond', least((SELECT max(ts) FROM readings), (SELECT max(h) FROM hours)) - INTERVAL '13 days') AS w)
SELECT r.event_id, r.ts AS timestamp, r.site, r.value, h.temp FROM readings r LEFT JOIN hours h ON r.site = h.site AND r.ts >= h.h AND r.ts < h.h + INTERVAL '1 hour', mark
WHERE h.h IS NOT NULL OR r.ts < w""")
def stream_weather_join(t: Tables) -> DataFrame:
    """Events of three sites with samples that hold for an hour; some hours have none, and both streams come out of order."""
    site = (F.col("panel_id") % 3).alias("site")
    folder = t.scratch("weather")
    samples = t["events"].filter("event_id % 4 = 0").select((F.col("user_id").cast("int") % 3).alias("site"), F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("hour"), "value")
    hours = samples.groupBy("site", "hour").agg(F.round(F.avg("value"), 4).alias("temp")).withColumn("timestamp", F.col("hour") + F.expr("INTERVAL 20 MINUTES")).drop("hour")
    # The other way round than the readings: odd hours are late.
    late = F.least(F.lit(SLICES - 1), F.floor((F.dayofmonth("timestamp") - 1) / 6) + F.hour("timestamp") % 2)
    hours = t.stored(hours, "hours")
    for n in range(SLICES):
        hours.filter(late == n).coalesce(1).write.mode("append").parquet(folder)
    sky = t.spark.readStream.schema(hours.schema).option("maxFilesPerTrigger", 1).parquet(folder)
    readings = in_slices(t).select("event_id", "timestamp", site, "value")
    return out_of(t, weather.with_weather(readings, sky, "site", late="13 days", weather_late="13 days"))


@query("stream_keyed_facts", f"""WITH {DEVICES}, d AS (SELECT *, min(start_date) OVER (PARTITION BY device_id) AS first_start FROM devices)
SELECT e.event_id, CAST(e.user_id AS INTEGER) AS panel_id, e.ts AS timestamp, e.value, d.device_key FROM events e JOIN d ON d.device_id = e.user_id
AND (e.ts >= d.start_date OR d.start_date = d.first_start) AND (d.end_date IS NULL OR e.ts < d.end_date)""")
def stream_keyed_facts(t: Tables) -> DataFrame:
    """The dimension grows while the stream runs: half of the devices, all first versions open; then two thirds with all versions; then all."""
    devices, opened = t.devices(), F.lit("2024-01-10").cast("timestamp")
    first = devices.filter((F.col("device_id") % 2 == 0) & (F.col("start_date") < opened))
    dims = [first.withColumn("end_date", F.lit(None).cast("timestamp")), devices.filter("device_id % 3 <> 0"), devices]
    tries = iter([1, 1, 2, 2])
    schema = T.StructType.fromDDL("event_id BIGINT, panel_id INT, timestamp TIMESTAMP, value DOUBLE")
    facts = keyed.KeyedFacts(t.spark, t.scratch("keyed"), schema, {"panel_id": "device_id"}, "device_key", "timestamp", lambda: next(tries, 3), lambda n: dims[n - 1])
    facts.start(in_slices(t), t.scratch("stream-state")).awaitTermination()
    return facts.read()


@query("stream_late_days", FLOW_SQL)
def stream_late_days(t: Tables) -> DataFrame:
    """Streamed loads bring late samples of days before their newest; the dated run of that day finds them in the register, and facts follow."""
    lake, readings = Lake(t.spark, t.scratch("lake")), t.readings()
    load_panels(lake)
    logs = {n: t.scratch(n) for n in ("power", "battery")}
    state = {n: t.scratch("stream-state") for n in ("home", "solar", "battery")}
    late = (F.col("timestamp") >= F.lit("2024-01-16").cast("timestamp")) | (F.col("event_id") % 7 == 0)
    for name, rows in (("a", readings.filter(~late)), ("b", readings.filter(late))):
        write_json(power_log(rows), f"{logs['power']}/{name}")
        write_json(battery_log(rows), f"{logs['battery']}/{name}")
        ingest_home(lake, jobs.stream_power_log(t.spark, f"{logs['power']}/*"), state["home"])
        ingest_solar(lake, jobs.stream_power_log(t.spark, f"{logs['power']}/*"), state["solar"])
        ingest_batteries(lake, jobs.stream_battery_log(t.spark, f"{logs['battery']}/*"), state["battery"])
        newest = max(lake.loads("home_power_readings").entry(*max(lake.loads("home_power_readings").versions().items(), key=lambda v: v[1]))["parts"])
        run_warehouse(lake, t.appliances().withColumn("home_key", F.lit(1)), newest, NOW, reload=name == "b")
    return fact_rows(lake)


@query("stream_insert_new", "SELECT event_id, ts AS date_key, value AS generation_power_wh, CAST(date_trunc('month', ts) AS DATE) AS month FROM events")
def stream_insert_new(t: Tables) -> DataFrame:
    """The same stream from its start twice, as after a lost checkpoint: the second run adds nothing."""
    out = t.scratch("facts")
    schema = T.StructType.fromDDL("event_id BIGINT, date_key TIMESTAMP, generation_power_wh DOUBLE, month DATE")
    target = lambda: open_table(t.spark, out, schema)
    rows = event_stream(t).select("event_id", F.col("timestamp").alias("date_key"), "generation_power_wh")
    for _ in range(2):
        jobs.start_insert_new(rows, target, ["event_id"], out, t.scratch("stream-state")).awaitTermination()
    return target()
