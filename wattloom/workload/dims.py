"""Dimension loads, type 2 operators, keys, calendar."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.functions.keys import composite_key, device_id_from_name, next_key
from wattloom.functions.predicates import current, select_as
from wattloom.operators import analytics, quality, scd2
from wattloom.operators.merge import changelog, changelog_of_versions
from wattloom.plans import dims
from wattloom.schemas import as_table, empty_table, no_rows
from wattloom.workload.base import APPLIANCES, DEVICES, INCOMING, NOW, READINGS, Tables, query
from wattloom.workload.facts import at

EARLIER = "2024-01-20 00:00:00"
KEY = scd2.CompositeKey("device_key", "device_id")

CLOSED = f"""closed AS (
  SELECT d.device_key, d.device_id, d.name, d.balance, d.start_date,
    CASE WHEN d.current_flag AND d.balance <> s.balance THEN TIMESTAMP '{NOW}' ELSE d.end_date END AS end_date,
    CASE WHEN d.current_flag AND d.balance <> s.balance THEN FALSE ELSE d.current_flag END AS current_flag
  FROM devices d LEFT JOIN incoming s ON s.device_id = d.device_id AND d.current_flag)"""
OPENED = f"""opened AS (
  SELECT s.device_id * 100000000 + 20240201 AS device_key, s.device_id, s.name, s.balance,
    TIMESTAMP '{NOW}' AS start_date, CAST(NULL AS TIMESTAMP) AS end_date, TRUE AS current_flag
  FROM incoming s WHERE NOT EXISTS (SELECT 1 FROM {{dim}} c WHERE c.device_id = s.device_id AND c.current_flag))"""


@query("scd2_close", f"WITH {DEVICES}, {INCOMING}, {CLOSED} SELECT * FROM closed")
def scd2_close(t: Tables) -> DataFrame:
    return scd2.scd2_close(t.devices(), t.incoming(), ["device_id"], ["balance"], at(NOW))


@query("scd2_open", f"""WITH {DEVICES}, {INCOMING}, {OPENED.format(dim='devices')}
SELECT * FROM devices UNION ALL SELECT * FROM opened""")
def scd2_open(t: Tables) -> DataFrame:
    return scd2.scd2_open(t.devices(), t.incoming(), ["device_id"], at(NOW), KEY)


@query("scd2_apply", f"""WITH {DEVICES}, {INCOMING}, {CLOSED}, {OPENED.format(dim='closed')}
SELECT * FROM closed UNION ALL SELECT * FROM opened""")
def scd2_apply(t: Tables) -> DataFrame:
    return scd2.scd2_apply(t.devices(), t.incoming(), ["device_id"], ["balance"], at(NOW), KEY)


@query("scd2_apply_null_safe", f"""WITH {DEVICES}, {INCOMING},
{CLOSED.replace('d.balance <> s.balance', 's.device_id IS NOT NULL AND d.balance IS DISTINCT FROM s.balance')},
{OPENED.format(dim='closed')}
SELECT * FROM closed UNION ALL SELECT * FROM opened""")
def scd2_apply_null_safe(t: Tables) -> DataFrame:
    return scd2.scd2_apply(t.devices(), t.incoming(), ["device_id"], ["balance"], at(NOW), KEY, null_safe=True)


@query("changelog", f"""WITH {DEVICES}, {INCOMING}, {CLOSED}, {OPENED.format(dim='closed')},
after AS (SELECT * FROM closed UNION ALL SELECT * FROM opened)
SELECT b.*, 'UPDATE_BEFORE' AS _change_type, 0 AS _change_ordinal FROM devices b JOIN after a USING (device_key) WHERE a.current_flag <> b.current_flag
UNION ALL
SELECT a.*, 'UPDATE_AFTER', 0 FROM devices b JOIN after a USING (device_key) WHERE a.current_flag <> b.current_flag
UNION ALL
SELECT a.*, 'INSERT', 0 FROM after a WHERE NOT EXISTS (SELECT 1 FROM devices b WHERE b.device_key = a.device_key)""")
def changelog_query(t: Tables) -> DataFrame:
    before = t.devices()
    after = scd2.scd2_apply(before, t.incoming(), ["device_id"], ["balance"], at(NOW), KEY)
    return changelog(before, after, ["device_key"])


@query("changelog_versions", f"""WITH {DEVICES}, {INCOMING}, {CLOSED}
SELECT device_key, name, current_flag, 'INSERT' AS _change_type, 0 AS _change_ordinal FROM devices
UNION ALL
SELECT b.device_key, b.name, b.current_flag, 'UPDATE_BEFORE', 1 FROM devices b JOIN closed a USING (device_key) WHERE a.current_flag <> b.current_flag
UNION ALL
SELECT a.device_key, a.name, a.current_flag, 'UPDATE_AFTER', 1 FROM devices b JOIN closed a USING (device_key) WHERE a.current_flag <> b.current_flag
UNION ALL
SELECT device_key, name, current_flag, 'DELETE', 2 FROM closed WHERE NOT current_flag""")
def changelog_versions(t: Tables) -> DataFrame:
    """Empty, loaded, closed, and without the closed versions."""
    v1 = t.devices()
    v2 = scd2.scd2_close(v1, t.incoming(), ["device_id"], ["balance"], at(NOW))
    cols = ["device_key", "name", "current_flag"]
    empty = no_rows(t.spark, v1.schema).select(*cols)
    return changelog_of_versions([empty, v1.select(*cols), v2.select(*cols), current(v2).select(*cols)], ["device_key"])


@query("surrogate_dense", f"""WITH {DEVICES}, {INCOMING},
opened AS (SELECT * FROM incoming s WHERE NOT EXISTS (SELECT 1 FROM devices c WHERE c.device_id = s.device_id AND c.current_flag))
SELECT device_id, name, (SELECT max(device_key) FROM devices) + row_number() OVER (ORDER BY device_id % 64, device_id) AS device_key FROM opened""")
def surrogate_dense(t: Tables) -> DataFrame:
    dim = t.devices()
    new = t.incoming().join(current(dim).select("device_id"), "device_id", "left_anti").select("device_id", "name")
    return next_key(dim, new, ["device_id"], "device_key", bucket=F.pmod("device_id", F.lit(64)))


@query("surrogate_composite", """SELECT event_id, user_id * 100000000 + CAST(strftime(ts, '%Y%m%d') AS BIGINT) AS day_key,
  user_id * 100000000000000 + CAST(strftime(ts, '%Y%m%d%H%M%S') AS BIGINT) AS second_key FROM events""")
def surrogate_composite(t: Tables) -> DataFrame:
    return t["events"].select(
        "event_id", composite_key(F.col("user_id"), F.col("ts")).alias("day_key"),
        composite_key(F.col("user_id"), F.col("ts"), "second").alias("second_key"),
    )


@query("device_id_from_name", """SELECT event_id, CAST(user_id AS INTEGER) AS device_id, CAST(-1 AS INTEGER) AS no_id FROM events""")
def device_ids(t: Tables) -> DataFrame:
    return t.readings().select(
        "event_id", device_id_from_name(F.col("battery_name")).alias("device_id"),
        F.coalesce(device_id_from_name(F.col("status")), F.lit(-1)).alias("no_id"),
    )


@query("dim_appliances", f"""WITH {APPLIANCES}
SELECT home_appliance_key, home_key, appliance,
  CASE WHEN home_key > 25 THEN min_consumption_power_wh + 100 ELSE min_consumption_power_wh END AS min_consumption_power_wh,
  max_consumption_power_wh, usage_time FROM appliances""")
def dim_appliances(t: Tables) -> DataFrame:
    """Half the homes are loaded; then all come with larger ratings for some and new names, which stay out."""
    listed = t.appliances()
    first = dims.dim_appliances(empty_table(t.spark, "dim_home_appliances"), listed.filter("home_key < 40"))
    more = F.when(F.col("home_key") > 25, F.col("min_consumption_power_wh") + 100).otherwise(F.col("min_consumption_power_wh"))
    renamed = F.when(F.col("home_key") < 40, F.concat("appliance", F.lit(" II"))).otherwise(F.col("appliance"))
    return dims.dim_appliances(first, listed.withColumns({"min_consumption_power_wh": more, "appliance": renamed}))


@query("dim_home", f"""WITH {APPLIANCES},
load AS (SELECT home_key AS home_id, sum(min_consumption_power_wh) AS lo, sum(max_consumption_power_wh) AS hi,
    sum(CASE WHEN home_appliance_key % 3 = 0 THEN min_consumption_power_wh + 452 ELSE min_consumption_power_wh END) AS lo2,
    max(CASE WHEN home_key > 25 THEN 1 ELSE 0 END) AS moves
  FROM appliances GROUP BY home_key)
SELECT home_id, round(CASE WHEN v = 2 AND moves = 1 THEN lo + 452 ELSE lo END, 4) AS min_consumption_power_wh,
  round(hi, 4) AS max_consumption_power_wh,
  CASE WHEN v = 1 THEN TIMESTAMP '2024-01-20 00:00:00' ELSE TIMESTAMP '{NOW}' END AS start_date,
  CASE WHEN v = 1 AND moves = 1 THEN TIMESTAMP '{NOW}' END AS end_date, NOT (v = 1 AND moves = 1) AS current_flag
FROM load, (VALUES (1), (2)) AS versions(v) WHERE v = 1 OR moves = 1""")
def dim_home(t: Tables) -> DataFrame:
    """Load twice: in the homes over size 25 one appliance more has been switched on."""
    listed = as_table(t.appliances(), "dim_home_appliances")
    first = dims.dim_home(empty_table(t.spark, "dim_home"), listed, at(EARLIER))
    extra = listed.filter("home_key > 25").groupBy("home_key").agg(F.max("home_appliance_key").alias("home_appliance_key"))
    extra = extra.withColumns({
        "appliance": F.lit("app"), "min_consumption_power_wh": F.lit(452.0), "max_consumption_power_wh": F.lit(0.0),
        "usage_time": F.lit("00:00-24:00"),
    })
    second = dims.dim_home(first, listed.unionByName(extra), at(NOW))
    return second.drop("home_key").withColumns({
        c: F.round(c, 4) for c in ("min_consumption_power_wh", "max_consumption_power_wh")
    })


@query("dim_panel", f"""WITH s AS (SELECT CAST(s_suppkey AS INTEGER) AS id, s_name AS name, CAST(s_nationkey AS DOUBLE) AS cap, s_acctbal AS light FROM supplier)
SELECT CAST(id AS BIGINT) * 100000000 + CASE WHEN v = 1 THEN 20240120 ELSE 20240201 END AS solar_panel_key, id AS solar_panel_id, name,
  CASE WHEN v = 2 AND cap < 5 THEN cap + 1 ELSE cap END AS capacity_kwh, light AS intensity_power_rating_wh,
  CAST(25 AS DOUBLE) AS temperature_power_rating_c,
  CASE WHEN v = 1 THEN TIMESTAMP '2024-01-20 00:00:00' ELSE TIMESTAMP '{NOW}' END AS start_date,
  CASE WHEN v = 1 AND cap < 5 THEN TIMESTAMP '{NOW}' END AS end_date, NOT (v = 1 AND cap < 5) AS current_flag
FROM s, (VALUES (1), (2)) AS versions(v) WHERE v = 1 OR cap < 5""")
def dim_panel(t: Tables) -> DataFrame:
    """Suppliers as panels: the small ones gain one kWh between two loads."""
    panels = select_as(t["supplier"], {
        "id": "s_suppkey", "name": "s_name", "capacity_kwh": "s_nationkey", "intensity_power_rating": "s_acctbal",
    }).withColumn("temperature_power_rating", F.lit(25.0))
    first = dims.dim_panel(empty_table(t.spark, "dim_solar_panel"), panels, at(EARLIER))
    grown = F.when(F.col("capacity_kwh") < 5, F.col("capacity_kwh") + 1).otherwise(F.col("capacity_kwh"))
    return dims.dim_panel(first, panels.withColumn("capacity_kwh", grown), at(NOW))


@query("dim_battery", f"""WITH {READINGS},
a AS (SELECT panel_id, battery_name, arg_max(capacity_kwh, timestamp) AS cap FROM readings WHERE timestamp < TIMESTAMP '2024-01-20 00:00:00' GROUP BY ALL),
b AS (SELECT panel_id, battery_name, arg_max(capacity_kwh, timestamp) AS cap FROM readings GROUP BY ALL),
v AS (
  SELECT a.panel_id, a.battery_name, a.cap, '20240120' AS d, CASE WHEN a.cap <> b.cap THEN TIMESTAMP '{NOW}' END AS end_date, a.cap = b.cap AS current_flag
  FROM a JOIN b USING (panel_id)
  UNION ALL
  SELECT b.panel_id, b.battery_name, b.cap, '20240201', NULL, TRUE FROM b LEFT JOIN a USING (panel_id) WHERE a.panel_id IS NULL OR a.cap <> b.cap)
SELECT CAST(panel_id AS BIGINT) * 100000000 + CAST(d AS BIGINT) AS battery_key, panel_id AS battery_id, battery_name AS name, cap AS capacity_kwh,
  CAST(1 AS DOUBLE) AS max_charge_speed_w, CAST(3.5 AS DOUBLE) AS max_output_w, strptime(d, '%Y%m%d') AS start_date, end_date, current_flag FROM v""")
def dim_battery(t: Tables) -> DataFrame:
    readings = t.readings()
    first = dims.dim_battery(empty_table(t.spark, "dim_battery"), readings.filter(F.col("timestamp") < at(EARLIER)), at(EARLIER))
    return dims.dim_battery(first, readings, at(NOW))


CALENDAR = """stamps AS (SELECT unnest(generate_series(date_trunc('day', lo), date_trunc('day', hi) + INTERVAL '23 hours 45 minutes', INTERVAL '15 minutes')) AS d
  FROM (SELECT min(o_orderdate) AS lo, max(o_orderdate) AS hi FROM orders)),
calendar AS (SELECT d AS date_key, CAST(year(d) AS SMALLINT) AS year, CAST(quarter(d) AS SMALLINT) AS quarter, CAST(month(d) AS SMALLINT) AS month,
  CAST(weekofyear(d) AS SMALLINT) AS week, CAST(day(d) AS SMALLINT) AS day, CAST(hour(d) AS SMALLINT) AS hour,
  CAST(floor((hour(d) * 60 + minute(d) - 60) / 15.0) AS SMALLINT) AS interval_15m, isodow(d) = 7 AS is_weekend FROM stamps)"""


@query("dim_date", f"WITH {CALENDAR} SELECT * FROM calendar")
def dim_date(t: Tables) -> DataFrame:
    return dims.dim_date_for(t["orders"], "o_orderdate")


@query("dim_date_two_day_weekend", f"""WITH {CALENDAR}
SELECT year, month, is_weekend, count(*) AS n FROM (SELECT year, month, isodow(date_key) >= 6 AS is_weekend FROM calendar) GROUP BY ALL""")
def dim_date_two_day_weekend(t: Tables) -> DataFrame:
    return dims.dim_date_for(t["orders"], "o_orderdate", (5, 6)).groupBy("year", "month", "is_weekend").agg(F.count("*").alias("n"))


@query("distinct_years", f"WITH {CALENDAR} SELECT DISTINCT year FROM calendar")
def distinct_years(t: Tables) -> DataFrame:
    return analytics.distinct_years(dims.dim_date_for(t["orders"], "o_orderdate"))


@query("calendar_parts", f"WITH {CALENDAR} SELECT date_key, week, interval_15m FROM calendar WHERE day = 1 AND month = 1")
def calendar_parts(t: Tables) -> DataFrame:
    days = dims.dim_date_for(t["orders"], "o_orderdate")
    return days.filter((F.col("day") == 1) & (F.col("month") == 1)).select("date_key", "week", "interval_15m")


@query("current_violations", f"""WITH {DEVICES}, {INCOMING}, opened AS (SELECT device_id, TRUE AS current_flag FROM incoming)
SELECT device_id, count(*) FILTER (current_flag) AS n_current FROM (
  SELECT device_id, current_flag FROM devices UNION ALL SELECT * FROM opened) GROUP BY device_id HAVING count(*) FILTER (current_flag) <> 1""")
def current_violations(t: Tables) -> DataFrame:
    """What opening versions without closing any would leave behind."""
    opened = t.incoming().select("device_id", F.lit(True).alias("current_flag"))
    return quality.current_violations(t.devices().select("device_id", "current_flag").unionByName(opened), ["device_id"])
