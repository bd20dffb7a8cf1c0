"""Logs and documents whose fields change between loads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.operators.quality import CORRUPT
from wattloom.sources import drift
from wattloom.sources.readings import POWER_LOG
from wattloom.workload.base import Tables, query
from wattloom.workload.files import F4, doubled

ORIGIN = r"/day=([^/]+)/"

# Purchases bring a new field, signups a text for a number, errors are torn.
HEAD = "'{\"time_stamp\": \"' || strftime(ts, '%Y-%m-%d %H:%M:%S') || '\", \"current_consumption_w\": '"
KINDS = """kinds AS (SELECT *, strftime(ts, '%Y-%m-%d') AS load, event_type = 'purchase' AS wide, event_type = 'signup' AS text, event_type = 'error' AS torn FROM events)"""


def drifting_log(t: Tables) -> str:
    """A log of lines as ``HEAD`` says, in one folder per day."""
    stamp = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    kind = F.col("event_type")
    number = F.when(kind == "signup", F.lit('"n/a"')).otherwise(F.format_string("%.2f", "value"))
    more = F.when(kind == "purchase", F.format_string(', "meter": {"serial": %d}', "event_id")).otherwise("")
    end = F.when(kind == "error", "").otherwise("}")
    line = F.concat(F.format_string('{"time_stamp": "%s", "current_consumption_w": %s, "consumption_accumulated_w": %d', stamp, number, "event_id"), more, end)
    path = t.scratch("drifting-log")
    t["events"].select(F.to_date("ts").alias("day"), line.alias("value")).write.partitionBy("day").text(path)
    return path


@query("drifting_log", f"""WITH {KINDS} SELECT load,
  CASE WHEN NOT torn THEN date_trunc('second', ts) END AS time_stamp,
  CASE WHEN NOT torn AND NOT text THEN {F4.format('value')} END AS current_consumption_w,
  CASE WHEN NOT torn THEN {F4.format('event_id')} END AS consumption_accumulated_w,
  CASE WHEN wide THEN '{{"meter":{{"serial":' || event_id || '}}}}' WHEN text THEN '{{"current_consumption_w":"n/a"}}' END AS _rescued,
  CASE WHEN torn THEN {HEAD} || printf('%.2f', value) || ', "consumption_accumulated_w": ' || event_id END AS _corrupt_record
FROM kinds""")
def drifting_log_rows(t: Tables) -> DataFrame:
    """Old and new shape side by side: nothing of a line is lost."""
    return doubled(drift.read_power_log(t.spark, drifting_log(t), origin=ORIGIN)).drop("interval_15m", "day")


@query("drift_report", f"""WITH {KINDS}, seen AS (
  SELECT load, unnest(['time_stamp', 'current_consumption_w', 'consumption_accumulated_w', CASE WHEN wide THEN 'meter' END]) AS field,
    unnest(['STRING', CASE WHEN text THEN 'STRING' ELSE 'NUMBER' END, 'NUMBER', 'OBJECT']) AS kind FROM kinds WHERE NOT torn),
counted AS (SELECT load, field, kind, count(*) AS n FROM seen WHERE field IS NOT NULL GROUP BY ALL)
SELECT load, field, kind, n, CAST(CASE WHEN field = 'meter' OR (field = 'current_consumption_w' AND kind = 'STRING') THEN n ELSE 0 END AS BIGINT) AS unfit,
  CASE WHEN field = 'meter' THEN 'new' WHEN field = 'current_consumption_w' AND kind = 'STRING' THEN 'changed' ELSE 'known' END AS status,
  min(load) OVER (PARTITION BY field, kind) AS first_load FROM counted""")
def drift_report(t: Tables) -> DataFrame:
    return drift.drift_report(drift._lines(t.spark, drifting_log(t), ORIGIN), POWER_LOG)


@query("drifting_battery_log", """SELECT date_trunc('second', ts) AS time_stamp,
  CASE WHEN event_type <> 'error' THEN 'battery_' || user_id END AS battery_name,
  CASE WHEN event_type NOT IN ('error', 'signup') THEN CAST(event_id AS VARCHAR) END AS is_charging,
  CASE WHEN event_type <> 'error' THEN event_type END AS status,
  CASE WHEN event_type = 'signup' THEN '{"is_charging":' || event_id || '.5}' WHEN event_type = 'purchase' THEN '{"cells":[1,null,"x"]}' END AS _rescued,
  CASE WHEN event_type = 'error' THEN '{"batteries":[' || event_id || ']}' END AS _rescued_line FROM events""")
def drifting_battery_log(t: Tables) -> DataFrame:
    """Batteries with a fraction for a whole number and with a list of cells; batteries that are a list."""
    kind, n = F.col("event_type"), F.col("event_id")
    charging = F.when(kind == "signup", F.format_string("%d.5", n)).otherwise(n.cast("string"))
    more = F.when(kind == "purchase", ', "cells": [1, null, "x"]').otherwise("")
    one = F.format_string('{"battery_%d": {"is_charging": %s, "status": "%s"%s}}', "user_id", charging, kind, more)
    batteries = F.when(kind == "error", F.format_string("[%d]", n)).otherwise(one)
    path = t.scratch("drifting-battery-log")
    line = F.format_string('{"time_stamp": "%s", "batteries": %s}', F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), batteries)
    t["events"].select(line.alias("value")).write.text(path)
    rows = drift.read_battery_log(t.spark, path)
    return rows.select("time_stamp", "battery_name", F.col("is_charging").cast("string").alias("is_charging"), "status", drift.RESCUED, f"{drift.RESCUED}_line").filter(rows[CORRUPT].isNull())
