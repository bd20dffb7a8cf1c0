"""Readers and writers: tables go to files of the source formats and come back through the readers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.operators.quality import CORRUPT, split_corrupt
from wattloom.plans.flows import run_raw, run_warehouse
from wattloom.schemas import as_table, ensure_tables
from wattloom.sinks import tables as sinks
from wattloom.sinks.tables import Lake
from wattloom.sources import readings as src
from wattloom.sources.catalogues import parse_appliances
from wattloom.workload.base import LOADED_UNTIL, NOW, READINGS, Tables, query

STAMP = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def power_log(readings: DataFrame) -> DataFrame:
    return readings.select(
        F.col("timestamp").alias("time_stamp"), F.col("min_consumption_wh").alias("current_consumption_w"),
        F.col("max_consumption_wh").alias("consumption_accumulated_w"),
    )


def battery_log(readings: DataFrame) -> DataFrame:
    fields = ["capacity_kwh", "max_charge_speed_w", "current_energy_wh", "is_charging", "status", "max_output_w"]
    one = F.map_from_arrays(F.array("battery_name"), F.array(F.struct(*fields)))
    return readings.select(F.col("timestamp").alias("time_stamp"), one.alias("batteries"))


def write_json(df: DataFrame, path: str) -> str:
    df.write.option("timestampFormat", STAMP).json(path)
    return path


def write_csv(df: DataFrame, path: str) -> str:
    df.write.option("header", True).option("timestampFormat", STAMP).csv(path)
    return path


F4 = "CAST(CAST({0} AS FLOAT) AS DOUBLE)"


def doubled(df: DataFrame) -> DataFrame:
    floats = [f.name for f in df.schema.fields if f.dataType.typeName() == "float"]
    return df.withColumns({c: F.col(c).cast("double") for c in floats})


@query("read_weather_csv", f"""WITH {READINGS} SELECT timestamp, {F4.format('generation_power_wh')} AS solar_intensity, {F4.format('capacity_kwh')} AS temp, interval_15m FROM readings""")
def read_weather_csv(t: Tables) -> DataFrame:
    rows = t.readings().select("timestamp", F.col("generation_power_wh").alias("solar_intensity"), F.col("capacity_kwh").alias("temp"))
    return doubled(src.read_weather_csv(t.spark, write_csv(rows, t.scratch("weather"))))


@query("read_home_csv", f"""WITH {READINGS} SELECT timestamp, {F4.format('min_consumption_wh')} AS min_consumption_wh, {F4.format('max_consumption_wh')} AS max_consumption_wh,
  {F4.format('(min_consumption_wh + max_consumption_wh) / 2')} AS avg_consumption_wh, interval_15m FROM readings""")
def read_home_csv(t: Tables) -> DataFrame:
    avg = ((F.col("min_consumption_wh") + F.col("max_consumption_wh")) / 2).alias("avg_consumption_wh")
    rows = t.readings().select("timestamp", "min_consumption_wh", "max_consumption_wh", avg)
    return doubled(src.read_home_csv(t.spark, write_csv(rows, t.scratch("home"))))


LOG_SQL = f"""WITH {READINGS} SELECT timestamp AS time_stamp, {F4.format('min_consumption_wh')} AS current_consumption_w,
  {F4.format('max_consumption_wh')} AS consumption_accumulated_w, interval_15m FROM readings"""


@query("read_home_log", LOG_SQL)
def read_home_log(t: Tables) -> DataFrame:
    return doubled(src.read_home_log(t.spark, write_json(power_log(t.readings()), t.scratch("home-log"))))


@query("read_solar_log", LOG_SQL)
def read_solar_log(t: Tables) -> DataFrame:
    return doubled(src.read_solar_log(t.spark, write_json(power_log(t.readings()), t.scratch("solar-log"))))


@query("read_battery_log", f"""WITH {READINGS} SELECT timestamp AS time_stamp, battery_name, {F4.format('capacity_kwh')} AS capacity_kwh, max_charge_speed_w,
  {F4.format('current_energy_wh')} AS current_energy_wh, CAST(is_charging AS INTEGER) AS is_charging, status, max_output_w, interval_15m FROM readings""")
def read_battery_log(t: Tables) -> DataFrame:
    return doubled(src.read_battery_log(t.spark, write_json(battery_log(t.readings()), t.scratch("battery-log"))))


@query("corrupt_lines", """SELECT '{"time_stamp": "' || strftime(ts, '%Y-%m-%d %H:%M:%S') || '", "n": ' || event_id AS _corrupt_record,
  CAST(NULL AS TIMESTAMP) AS time_stamp FROM events WHERE event_type = 'error'""")
def corrupt_lines(t: Tables) -> DataFrame:
    """Lines of one event type are torn before their last brace."""
    head = F.format_string('{"time_stamp": "%s", "n": %d', F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.col("event_id"))
    line = F.when(F.col("event_type") == "error", head).otherwise(F.concat(head, F.lit("}")))
    path = t.scratch("torn")
    t["events"].select(line.alias("value")).write.text(path)
    return split_corrupt(src.read_home_log(t.spark, path, keep_corrupt=True))[1].select(CORRUPT, "time_stamp")


@query("appliance_documents", """SELECT CAST(floor(p_partkey / 10.0) AS BIGINT) AS home_key, CAST(row_number() OVER (PARTITION BY floor(p_partkey / 10.0) ORDER BY p_partkey) AS INTEGER) AS home_appliance_key,
  'part ' || p_partkey AS appliance, p_retailprice AS min_consumption_power_wh, p_retailprice * 2 AS max_consumption_power_wh, '00:00-24:00' AS usage_time FROM part""")
def appliance_documents(t: Tables) -> DataFrame:
    """One JSON document per ten part keys, with an entry per part in key order."""
    entry = F.struct(
        F.concat(F.lit("part "), F.col("p_partkey").cast("string")).alias("key"),
        F.struct(F.array("p_retailprice", F.col("p_retailprice") * 2).alias("consumption"), F.lit("00:00-24:00").alias("time")).alias("value"),
    )
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("p_partkey", entry.alias("e")))), lambda x: x["e"])
    home = F.floor(F.col("p_partkey") / 10).alias("home_key")
    documents = t["part"].groupBy(home).agg(F.to_json(F.map_from_entries(ordered)).alias("value"))
    return parse_appliances(documents, home_key="home_key")


@query("csv_by_interval", f"""WITH {READINGS} SELECT event_id, generation_power_wh, CAST(interval_15m AS INTEGER) AS interval_15m FROM readings""")
def csv_by_interval(t: Tables) -> DataFrame:
    path = t.scratch("by-interval")
    sinks.write_csv_by_interval(t.readings().select("event_id", "generation_power_wh", "interval_15m"), path)
    schema = "event_id BIGINT, generation_power_wh DOUBLE, interval_15m INT"
    return t.spark.read.schema(schema).option("header", True).csv(path)


@query("raw_home_reload", f"""WITH {READINGS} SELECT timestamp, interval_15m, {F4.format('min_consumption_wh')} AS min_consumption_wh,
  {F4.format('min_consumption_wh')} AS max_consumption_wh, CAST(timestamp AS DATE) AS day, 'log' AS source FROM readings""")
def raw_home_reload(t: Tables) -> DataFrame:
    """A part of the days is loaded first, then all of them; nothing doubles."""
    lake = Lake(t.spark, t.scratch("lake"))
    log = power_log(t.readings()).withColumn("interval_15m", src.interval_15m(F.col("time_stamp")))
    rows = sinks.home_rows(log, "log")
    early = rows.filter(F.col("timestamp") < F.lit(LOADED_UNTIL).cast("timestamp"))
    sinks.append_home(lake, early, "log")
    sinks.append_home(lake, rows, "log")
    return doubled(lake.read("home_power_readings").drop("load"))


@query("raw_solar_two_sources", f"""WITH {READINGS} SELECT timestamp, interval_15m, panel_id, {F4.format('generation_power_wh')} AS generation_power_wh,
  CAST(timestamp AS DATE) AS day, 'file' AS source FROM readings
UNION ALL SELECT timestamp, interval_15m, 4, {F4.format('min_consumption_wh / 3600.0::DOUBLE')}, CAST(timestamp AS DATE), 'log' FROM readings""")
def raw_solar_two_sources(t: Tables) -> DataFrame:
    """Derived panels and the log panel; the log's watts as watt-hours of one-second samples."""
    lake, readings = Lake(t.spark, t.scratch("lake")), t.readings()
    sinks.append_solar(lake, sinks.solar_rows(readings, "file"), "file")
    log = power_log(readings).withColumn("interval_15m", src.interval_15m(F.col("time_stamp")))
    sinks.append_solar(lake, sinks.solar_rows(log, "log", sample_seconds=1), "log")
    return doubled(lake.read("solar_panel_readings").drop("load"))


@query("raw_battery_append", f"""WITH {READINGS} SELECT timestamp, interval_15m, battery_name, {F4.format('capacity_kwh')} AS capacity_kwh, max_charge_speed_w,
  {F4.format('current_energy_wh')} AS current_energy_wh, is_charging, status, max_output_w, CAST(timestamp AS DATE) AS day, 'log' AS source FROM readings""")
def raw_battery_append(t: Tables) -> DataFrame:
    lake = Lake(t.spark, t.scratch("lake"))
    sinks.append_battery(lake, t.readings())
    return doubled(lake.read("battery_readings").drop("load"))


@query("retain_7_days", f"""WITH {READINGS} SELECT panel_id, timestamp, {F4.format('generation_power_wh')} AS generation_power_wh FROM readings
WHERE CAST(timestamp AS DATE) > DATE '2024-01-20' - 7 AND CAST(timestamp AS DATE) <= DATE '2024-01-20'""")
def retain_7_days(t: Tables) -> DataFrame:
    lake = Lake(t.spark, t.scratch("lake"))
    sinks.append_solar(lake, sinks.solar_rows(t.readings(), "file"), "file")
    kept = sinks.retain_days(lake.read("solar_panel_readings"), 7, "2024-01-20")
    return doubled(kept.select("panel_id", "timestamp", "generation_power_wh"))


@query("file_stats", f"""WITH {READINGS} SELECT CAST(timestamp AS DATE) AS day, count(*) AS record_count, TRUE AS has_bytes FROM readings GROUP BY 1""")
def file_stats(t: Tables) -> DataFrame:
    """File list of a table, added up by the day in the path."""
    lake = Lake(t.spark, t.scratch("lake"))
    sinks.append_solar(lake, sinks.solar_rows(t.readings(), "file"), "file")
    files = sinks.file_stats(t.spark, lake.path("solar_panel_readings"))
    day = F.regexp_extract("file_path", r"day=(\d{4}-\d{2}-\d{2})", 1).cast("date").alias("day")
    return files.groupBy(day).agg(F.sum("record_count").alias("record_count"), (F.min("file_size") > 0).alias("has_bytes"))


@query("dim_versions", """SELECT CAST(p_size AS INTEGER) AS home_key, CAST(1 AS INTEGER) AS version, count(*) AS n FROM part WHERE p_size < 40 GROUP BY p_size
UNION ALL SELECT CAST(p_size AS INTEGER), 2, count(*) FROM part GROUP BY p_size""")
def dim_versions(t: Tables) -> DataFrame:
    """Two committed versions of a dimension, both still readable."""
    lake, listed = Lake(t.spark, t.scratch("lake")), t.appliances()
    lake.write_dim(listed.filter("home_key < 40"), "dim_home_appliances")
    lake.write_dim(listed, "dim_home_appliances")
    count = lambda df, v: df.groupBy("home_key").agg(F.count("*").alias("n")).withColumn("version", F.lit(v))
    return count(lake.dim_at("dim_home_appliances", 1), 1).unionByName(count(lake.dim("dim_home_appliances"), 2))


@query("catalog_tables", f"""WITH {READINGS} SELECT interval_15m, count(*) AS n, round(sum({F4.format('min_consumption_wh')}), 2) AS min_consumption_wh FROM readings GROUP BY interval_15m""")
def catalog_tables(t: Tables) -> DataFrame:
    """Create the namespaces and typed tables, insert readings, and read them through SQL."""
    root = t.scratch("catalog")
    tag = root.rsplit("-", 1)[-1]
    raw, wh = f"raw_{tag}", f"wh_{tag}"
    ensure_tables(t.spark, raw, wh, root)
    rows = t.readings().withColumns({"day": F.to_date("timestamp"), "source": F.lit("log"), "load": F.lit("log")})
    as_table(rows, "home_power_readings").write.insertInto(f"{raw}.home_power_readings")
    return t.spark.sql(
        f"SELECT interval_15m, count(*) AS n, round(sum(CAST(min_consumption_wh AS DOUBLE)), 2) AS min_consumption_wh "
        f"FROM {raw}.home_power_readings GROUP BY interval_15m"
    )


FLOW_SQL = f"""WITH {READINGS},
last_rows AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY bucket, panel_id ORDER BY timestamp DESC) AS rn FROM readings) WHERE rn = 1)
SELECT 'home' AS fact, CAST(1 AS BIGINT) AS dim_key, bucket AS date_key, 1 AS device_id, round(sum({F4.format('min_consumption_wh')}), 3) AS wh FROM readings GROUP BY bucket
UNION ALL
SELECT 'solar', CAST(420240201 AS BIGINT), bucket, 4, round(sum({F4.format('min_consumption_wh')}), 3) FROM readings GROUP BY bucket
UNION ALL
SELECT 'battery', CAST(panel_id AS BIGINT) * 100000000 + 20240201, bucket, panel_id, round({F4.format('current_energy_wh')}, 3) FROM last_rows"""


@query("daily_flows", FLOW_SQL)
def daily_flows(t: Tables) -> DataFrame:
    """Logs of all days through the raw and the warehouse flow, the latter twice."""
    inputs, readings = t.scratch("inputs"), t.readings()
    for topic, rows in (("home", power_log(readings)), ("solar", power_log(readings)), ("battery", battery_log(readings))):
        write_json(rows, src.source_path(inputs, topic, "log", "all"))
    lake = Lake(t.spark, t.scratch("lake"))
    run_raw(lake, inputs, "all", "log")
    one_home = t.appliances().withColumn("home_key", F.lit(1))
    run_warehouse(lake, one_home, None, NOW)
    run_warehouse(lake, one_home, None, "2024-02-02 00:00:00")
    return fact_rows(lake)


def fact_rows(lake: Lake) -> DataFrame:
    """The three facts one below the other."""
    out = None
    for fact, name, key, device, value in (
        ("home", "fact_home_power_readings", "home_key", F.lit(1), "min_consumption_power_wh"),
        ("solar", "fact_solar_panel_power_readings", "solar_panel_key", F.col("solar_panel_id"), "generation_power_wh"),
        ("battery", "fact_battery_power_readings", "battery_key", F.col("battery_id"), "current_energy_wh"),
    ):
        rows = lake.read(name).select(
            F.lit(fact).alias("fact"), F.col(key).alias("dim_key"), "date_key", device.alias("device_id"), F.round(value, 3).alias("wh")
        )
        out = rows if out is None else out.unionByName(rows)
    return out
