"""Derivations: panel output, upsampling, schedules, climate text, nested records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.functions.energy import to_sample_energy, watts_to_wh
from wattloom.functions.predicates import flatten
from wattloom.operators import generation, resample
from wattloom.operators.bucketing import sum_per_bucket
from wattloom.plans import prepare
from wattloom.sources import clm
from wattloom.sources.climate import parse_clm
from wattloom.workload.base import APPLIANCES, READINGS, Tables, query

HOUR_US = 3_600_000_000

# Each customer is a site with three panels: capacity (kWh) and rated intensity.
PANEL_KINDS = [(1, 3.0, 1000.0), (2, 5.0, 1300.0), (3, 10.0, 1500.0)]


def site_panels(t: Tables) -> DataFrame:
    kinds = F.explode(F.array(*(
        F.struct(F.lit(k).alias("kind"), F.lit(c).alias("capacity_kwh"), F.lit(i).alias("intensity_power_rating"))
        for k, c, i in PANEL_KINDS
    ))).alias("kind")
    rows = t["customer"].select(F.col("c_custkey").alias("site_id"), kinds)
    return rows.select(
        "site_id", (F.col("site_id") * 10 + F.col("kind.kind")).alias("id"), "kind.capacity_kwh",
        "kind.intensity_power_rating", F.lit(25.0).alias("temperature_power_rating"),
    )


def weather(t: Tables) -> DataFrame:
    """Event value as light, the number in the properties as temperature (0 among them)."""
    return t.readings().select(
        F.col("panel_id").cast("bigint").alias("site_id"), "timestamp", "event_id",
        F.col("generation_power_wh").alias("solar_intensity"), F.col("capacity_kwh").alias("temp"),
    )


GENERATION = f"""kinds AS (SELECT * FROM (VALUES (1, 3.0::DOUBLE, 1000.0::DOUBLE), (2, 5.0::DOUBLE, 1300.0::DOUBLE), (3, 10.0::DOUBLE, 1500.0::DOUBLE)) AS k(kind, cap, light)),
panels AS (SELECT c_custkey AS site_id, c_custkey * 10 + kind AS panel_id, cap, light FROM customer, kinds),
generated AS (SELECT CAST(r.panel_id AS BIGINT) AS site_id, r.timestamp, r.event_id, p.panel_id,
  p.cap * 1000 / 720000.0::DOUBLE * (25.0::DOUBLE / nullif(r.capacity_kwh, 0)) * (r.generation_power_wh / p.light) AS generation_power_wh
  FROM readings r JOIN panels p ON p.site_id = r.panel_id)"""


@query("solar_generation", f"WITH {READINGS}, {GENERATION} SELECT * FROM generated")
def solar_generation(t: Tables) -> DataFrame:
    return generation.solar_generation(weather(t), site_panels(t))


@query("solar_generation_15m", f"""WITH {READINGS}, {GENERATION}
SELECT panel_id, time_bucket(INTERVAL '15 minutes', timestamp) AS bucket, round(sum(generation_power_wh), 15) AS generation_power_wh FROM generated GROUP BY ALL""")
def solar_generation_15m(t: Tables) -> DataFrame:
    rows = sum_per_bucket(
        generation.solar_generation(weather(t), site_panels(t)), ["panel_id"],
        {"generation_power_wh": "generation_power_wh"}, "timestamp",
    )
    return rows.withColumn("generation_power_wh", F.round("generation_power_wh", 15))


@query("sample_energy", """SELECT event_id, value / 720000.0::DOUBLE AS wh_5ms, value / 3600.0::DOUBLE AS wh_1s, value AS as_is FROM events""")
def sample_energy(t: Tables) -> DataFrame:
    v = F.col("value")
    return t["events"].select(
        "event_id", to_sample_energy(v).alias("wh_5ms"), watts_to_wh(v, 1).alias("wh_1s"), watts_to_wh(v, None).alias("as_is")
    )


def hourly_max(t: Tables, by: str) -> DataFrame:
    r = t.readings()
    return r.groupBy(by, F.date_trunc("hour", "timestamp").alias("timestamp")).agg(
        F.max("generation_power_wh").alias("v"), F.max("capacity_kwh").alias("k")
    )


UPSAMPLE = """hourly AS (SELECT panel_id, date_trunc('hour', timestamp) AS ts, max(generation_power_wh) AS v FROM readings GROUP BY ALL),
pairs AS (SELECT panel_id, epoch_us(ts) AS a, v, epoch_us(lead(ts) OVER w) AS b, lead(v) OVER w AS nv FROM hourly WINDOW w AS (PARTITION BY panel_id ORDER BY ts)),
grid AS (SELECT panel_id, a, b, v, nv, unnest(generate_series(a, coalesce(b - 900000000, a), 900000000)) AS g FROM pairs)"""


@query("upsample_linear", f"""WITH {READINGS}, {UPSAMPLE}
SELECT panel_id, make_timestamp(g) AS timestamp, CASE WHEN b IS NULL THEN v ELSE v + (nv - v) * ((g - a)::DOUBLE / (b - a)::DOUBLE) END AS v FROM grid""")
def upsample_linear(t: Tables) -> DataFrame:
    """Quarter hours between the hourly values of each device; windows of a day each."""
    rows = hourly_max(t, "panel_id").select("panel_id", "timestamp", "v")
    return resample.upsample_linear(rows, "timestamp", ["v"], HOUR_US // 4, ["panel_id"], chunk_us=24 * HOUR_US)


@query("upsample_with_gaps", f"""WITH {READINGS},
hourly AS (SELECT status, epoch_us(date_trunc('hour', timestamp)) AS g, max(generation_power_wh) AS v FROM readings GROUP BY ALL),
known AS (SELECT status, g, CASE WHEN v < 60 THEN v END AS v FROM hourly),
span AS (SELECT status, min(g) AS lo, max(g) AS hi FROM known GROUP BY status),
grid AS (SELECT status, unnest(generate_series(lo, hi, 3600000000)) AS g FROM span),
points AS (SELECT status, g, v FROM known WHERE v IS NOT NULL)
SELECT x.status, make_timestamp(x.g) AS timestamp,
  CASE WHEN n.v IS NULL THEN p.v ELSE p.v + (n.v - p.v) * ((x.g - p.g)::DOUBLE / (n.g - p.g)::DOUBLE) END AS v
FROM grid x ASOF LEFT JOIN points p ON p.status = x.status AND p.g <= x.g ASOF LEFT JOIN points n ON n.status = x.status AND n.g > x.g""")
def upsample_with_gaps(t: Tables) -> DataFrame:
    """Large values are unknown: the line runs across them."""
    rows = hourly_max(t, "status").select("status", "timestamp", F.when(F.col("v") < 60, F.col("v")).alias("v"))
    return resample.upsample_linear(rows, "timestamp", ["v"], HOUR_US, ["status"], chunk_us=12 * HOUR_US)


@query("align_to_grid", f"""WITH {READINGS}
SELECT panel_id, epoch_us(date_trunc('hour', timestamp)) AS slot, round(avg(generation_power_wh), 6) AS generation_power_wh FROM readings GROUP BY ALL""")
def align_to_grid(t: Tables) -> DataFrame:
    rows = resample.align_to_grid(t.readings(), "timestamp", ["generation_power_wh"], HOUR_US, ["panel_id"])
    return rows.withColumn("generation_power_wh", F.round("generation_power_wh", 6))


@query("minute_expand", f"""WITH {READINGS},
hourly AS (SELECT status, CAST(timestamp AS DATE) AS date, CAST(hour(timestamp) AS INTEGER) AS hour, max(generation_power_wh) AS v, max(capacity_kwh) AS k FROM readings GROUP BY ALL),
pairs AS (SELECT *, lead(v) OVER w AS nv, lead(k) OVER w AS nk, lead(hour) OVER w AS nh FROM hourly WINDOW w AS (PARTITION BY status, date ORDER BY hour))
SELECT status, date, hour, CAST(m AS INTEGER) AS minute, v + (nv - v) * (m / 60.0::DOUBLE) AS v, k + (nk - k) * (m / 60.0::DOUBLE) AS k
FROM pairs, unnest(generate_series(1, 59)) AS g(m) WHERE nh IS NOT NULL""")
def minute_expand(t: Tables) -> DataFrame:
    hourly = hourly_max(t, "status").select("status", F.to_date("timestamp").alias("date"), F.hour("timestamp").alias("hour"), "v", "k")
    return resample.expand_minutes(hourly, ["v", "k"], ["status", "date"])


@query("hourly_load", f"""WITH {APPLIANCES},
ranges AS (SELECT home_key, min_consumption_power_wh AS lo, max_consumption_power_wh AS hi, unnest(string_split(usage_time, ',')) AS r FROM appliances),
spans AS (SELECT home_key, lo, hi, CAST(r[1:2] AS INTEGER) AS a, CAST(r[7:8] AS INTEGER) + CASE WHEN CAST(r[10:11] AS INTEGER) > 0 THEN 1 ELSE 0 END AS b FROM ranges),
hours AS (SELECT home_key, lo, hi, unnest(generate_series(a, b - 1)) AS h FROM spans)
SELECT home_key, CAST(h AS INTEGER) AS hour, round(sum(lo * 0.75::DOUBLE), 4) AS min_consumption_wh, round(sum(hi * 0.75::DOUBLE), 4) AS max_consumption_wh,
  round(sum((lo * 0.75::DOUBLE + hi * 0.75::DOUBLE) / 2), 4) AS avg_consumption_wh, CASE WHEN h = 23 THEN 59 ELSE 0 END AS minute FROM hours WHERE h > 0 GROUP BY home_key, h""")
def hourly_load(t: Tables) -> DataFrame:
    load = generation.appliance_hourly_load(t.appliances(), ["home_key"], load_factor=0.75)
    sums = ("min_consumption_wh", "max_consumption_wh", "avg_consumption_wh")
    return load.withColumns({c: F.round(c, 4) for c in sums})


@query("repartition_by_interval", f"WITH {READINGS} SELECT event_id, interval_15m, current_energy_wh FROM readings")
def repartition_by_interval(t: Tables) -> DataFrame:
    return generation.repartition_by_interval(t.readings().select("event_id", "interval_15m", "current_energy_wh"))


@query("json_props", "SELECT event_id, CAST(props->>'k' AS INTEGER) AS k FROM events")
def json_props(t: Tables) -> DataFrame:
    parsed = t["events"].select("event_id", F.from_json("props", "k INT").alias("record"))
    return flatten(parsed, "record")


@query("map_explode", """SELECT event_id, 'battery_' || user_id AS battery_name, value AS current_energy_wh, event_type AS status FROM events
UNION ALL SELECT event_id, 'spare_' || user_id, value / 2, 'idle' FROM events""")
def map_explode(t: Tables) -> DataFrame:
    reading = lambda v, s: F.struct(v.alias("current_energy_wh"), s.alias("status"))
    name = lambda kind: F.concat(F.lit(kind), F.col("user_id").cast("string"))
    batteries = F.map_from_entries(F.array(
        F.struct(name("battery_"), reading(F.col("value"), F.col("event_type"))),
        F.struct(name("spare_"), reading(F.col("value") / 2, F.lit("idle"))),
    ))
    rows = t["events"].select("event_id", F.explode(batteries).alias("battery_name", "reading"))
    return flatten(rows, "reading")


CLIMATE = """hourly AS (SELECT status AS station, CAST(timestamp AS DATE) AS date, CAST(hour(timestamp) AS INTEGER) + 1 AS hour, CAST(floor(max(generation_power_wh)) AS INTEGER) AS light, CAST(max(capacity_kwh) AS INTEGER) AS t FROM readings GROUP BY ALL),
days AS (SELECT DISTINCT station, date FROM hourly),
climate AS (SELECT d.station, d.date, CAST(h AS INTEGER) AS hour, CAST(coalesce(light, 0) AS DOUBLE) AS solar_intensity, coalesce(t, 0) / 10.0::DOUBLE AS temp
FROM days d CROSS JOIN unnest(generate_series(1, 24)) AS g(h) LEFT JOIN hourly x ON x.station = d.station AND x.date = d.date AND x.hour = h)"""


@query("climate_hours", f"WITH {READINGS}, {CLIMATE} SELECT * FROM climate")
def climate_hours(t: Tables) -> DataFrame:
    """Readings as one climate text per event type and year, and back."""
    return parse_clm(climate_texts(t))


SERIES = """pairs AS (SELECT *, lead(light) OVER w AS nl, lead(temp) OVER w AS nt, epoch_us(lead(timestamp) OVER w) AS b, epoch_us(timestamp) AS a FROM minutes
  WINDOW w AS (PARTITION BY station, date ORDER BY timestamp)),
grid AS (SELECT *, unnest(generate_series(a, coalesce(b - 20000000, a), 20000000)) AS g FROM pairs)"""


@query("weather_series", f"""WITH {READINGS}, {CLIMATE},
next AS (SELECT *, lead(solar_intensity) OVER w AS nl, lead(temp) OVER w AS nt, lead(hour) OVER w AS nh FROM climate WINDOW w AS (PARTITION BY station, date ORDER BY hour)),
minutes AS (SELECT station, date, date + (hour * 60 + m) * INTERVAL '1 minute' AS timestamp, solar_intensity + (nl - solar_intensity) * (m / 60.0::DOUBLE) AS light,
  temp + (nt - temp) * (m / 60.0::DOUBLE) AS temp FROM next, unnest(generate_series(1, 59)) AS x(m) WHERE nh IS NOT NULL),
{SERIES}
SELECT station, date, make_timestamp(g) AS timestamp, CASE WHEN b IS NULL THEN light ELSE light + (nl - light) * ((g - a)::DOUBLE / (b - a)::DOUBLE) END AS solar_intensity,
  CASE WHEN b IS NULL THEN temp ELSE temp + (nt - temp) * ((g - a)::DOUBLE / (b - a)::DOUBLE) END AS temp FROM grid""")
def weather_series(t: Tables) -> DataFrame:
    """Climate texts to minutes, and to a value every 20 seconds."""
    return prepare.weather_series(parse_clm(climate_texts(t)), step_us=20_000_000)


@query("home_series", f"""WITH {APPLIANCES},
ranges AS (SELECT home_key, min_consumption_power_wh AS lo, unnest(string_split(usage_time, ',')) AS r FROM appliances),
spans AS (SELECT home_key, lo, CAST(r[1:2] AS INTEGER) AS a, CAST(r[7:8] AS INTEGER) + CASE WHEN CAST(r[10:11] AS INTEGER) > 0 THEN 1 ELSE 0 END AS b FROM ranges),
hours AS (SELECT home_key, lo, unnest(generate_series(a, b - 1)) AS h FROM spans),
load AS (SELECT home_key, h, sum(floor(lo)) / 60.0::DOUBLE AS v FROM hours WHERE h > 0 GROUP BY home_key, h),
stamped AS (SELECT home_key, v, epoch_us(d + (h * 60 + CASE WHEN h = 23 THEN 59 ELSE 0 END) * INTERVAL '1 minute') AS a, CAST(d AS DATE) AS date
  FROM load, (VALUES (TIMESTAMP '2024-01-01'), (TIMESTAMP '2024-01-02')) AS days(d)),
pairs AS (SELECT *, lead(a) OVER w AS b, lead(v) OVER w AS nv FROM stamped WINDOW w AS (PARTITION BY home_key, date ORDER BY a)),
grid AS (SELECT *, unnest(generate_series(a, coalesce(b - 60000000, a), 60000000)) AS g FROM pairs)
SELECT home_key, date, make_timestamp(g) AS timestamp, CASE WHEN b IS NULL THEN v ELSE v + (nv - v) * ((g - a)::DOUBLE / (b - a)::DOUBLE) END AS min_consumption_wh FROM grid""")
def home_series(t: Tables) -> DataFrame:
    """Two days of load by minute in every home; whole ratings, so that sums are exact."""
    whole = t.appliances().withColumn("min_consumption_power_wh", F.floor("min_consumption_power_wh").cast("double"))
    series = prepare.home_series(whole, "2024-01-01", "2024-01-02", ["home_key"], step_us=60_000_000)
    return series.select("home_key", "date", "timestamp", "min_consumption_wh")


def climate_texts(t: Tables) -> DataFrame:
    hourly = hourly_max(t, "status").select(
        F.col("status").alias("station"), F.to_date("timestamp").alias("date"), (F.hour("timestamp") + 1).alias("hour"),
        F.format_string(" 0,%d,%d,0,0,0", F.col("k").cast("int"), F.floor("v").cast("int")).alias("line"),
    )
    filled = F.transform(F.sequence(F.lit(1), F.lit(24)), lambda h: F.coalesce(F.col("by_hour")[h], F.lit(" 0,0,0,0,0,0")))
    head = F.format_string("* day %2d month %2d", F.dayofmonth("date"), F.month("date"))
    days = hourly.groupBy("station", "date").agg(F.map_from_entries(F.collect_list(F.struct("hour", "line"))).alias("by_hour")).select(
        "station", "date", F.year("date").alias("year"), F.concat_ws("\n", head, F.concat_ws("\n", filled)).alias("block")
    )
    header = F.concat_ws("\n", F.array_repeat(F.lit("#"), 10), F.concat(F.lit(" "), F.col("year").cast("string"), F.lit(",0,0,0")), F.lit("#"))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("date", "block"))), lambda d: d["block"])
    years = days.groupBy("station", "year").agg(ordered.alias("blocks"))
    return years.select("station", F.concat_ws("\n", header, F.concat_ws("\n", "blocks")).alias("value"))


def climate_files(t: Tables) -> str:
    """The climate texts as files, a folder per station."""
    path = t.scratch("climate")
    climate_texts(t).select(F.col("station").alias("name"), "value").write.partitionBy("name").text(path)
    return path


def station_rows(rows: DataFrame) -> DataFrame:
    return rows.withColumn("station", F.regexp_extract("station", r"/name=([^/]+)/", 1))


@query("climate_ranges", f"WITH {READINGS}, {CLIMATE} SELECT * FROM climate")
def climate_ranges(t: Tables) -> DataFrame:
    """The same hours by the data source, in ranges of 10,000 bytes."""
    return station_rows(clm.read_clm_ranges(t.spark, climate_files(t), range_bytes=10_000).drop("torn"))


@query("climate_ranges_days", f"WITH {READINGS}, {CLIMATE} SELECT * FROM climate WHERE date BETWEEN DATE '2024-01-09' AND DATE '2024-01-11'")
def climate_ranges_days(t: Tables) -> DataFrame:
    """Three days of it; ranges without them are not read."""
    rows = clm.read_clm_ranges(t.spark, climate_files(t), range_bytes=2_000)
    return station_rows(rows.filter("date BETWEEN DATE '2024-01-09' AND DATE '2024-01-11'").drop("torn"))
