"""Long histories and changes that come late."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.operators import late_changes, scd2
from wattloom.operators.timeline import as_of
from wattloom.plans import dims as plans
from wattloom.schemas import no_rows
from wattloom.sinks.tables import Lake
from wattloom.workload.base import READINGS, Tables, query

# Two keys share all readings. Every third reading is a change of the key's price, the others are facts.
PRICES = """prices AS (
  SELECT panel_id % 2 AS side, timestamp AS start_date, max(event_id) AS price_key FROM readings WHERE event_id % 3 = 0 GROUP BY ALL),
versions AS (SELECT *, lead(start_date) OVER (PARTITION BY side ORDER BY start_date) AS end_date FROM prices)"""


def priced(t: Tables) -> tuple[DataFrame, DataFrame]:
    rows = t.readings().select("event_id", (F.col("panel_id") % 2).alias("side"), "timestamp")
    changes = rows.filter("event_id % 3 = 0").select("side", F.col("timestamp").alias("effective"), F.col("event_id").alias("price_key"))
    return rows.filter("event_id % 3 <> 0"), late_changes.versions_of(changes, ["side"], ["price_key"])


@query("as_of_many_versions", f"""WITH {READINGS}, {PRICES}
SELECT r.event_id, r.panel_id % 2 AS side, r.timestamp, coalesce(v.price_key, -1) AS price_key FROM readings r
ASOF LEFT JOIN versions v ON r.panel_id % 2 = v.side AND r.timestamp >= v.start_date WHERE r.event_id % 3 <> 0""")
def as_of_many_versions(t: Tables) -> DataFrame:
    """Keys with thousands of versions each."""
    facts, versions = priced(t)
    return as_of(facts, versions, {"side": "side"}, "timestamp", "start_date", "end_date", ["price_key"]).fillna(-1, ["price_key"])


@query("as_of_from_start", f"""WITH {READINGS}, {PRICES}
SELECT r.event_id, r.panel_id % 2 AS side, r.timestamp, coalesce(v.price_key, f.price_key) AS price_key FROM readings r
ASOF LEFT JOIN versions v ON r.panel_id % 2 = v.side AND r.timestamp >= v.start_date
LEFT JOIN (SELECT side, min_by(price_key, start_date) AS price_key FROM versions GROUP BY side) f ON f.side = r.panel_id % 2 WHERE r.event_id % 3 <> 0""")
def as_of_from_start(t: Tables) -> DataFrame:
    facts, versions = priced(t)
    return as_of(facts, versions, {"side": "side"}, "timestamp", "start_date", "end_date", ["price_key"], from_start=True)


# The rating of a device follows its readings by the hour; changes come in three loads, the last ones first.
CHANGES = """changes AS (
  SELECT panel_id AS device_id, date_trunc('hour', timestamp) AS effective, max(CASE WHEN capacity_kwh < 33 THEN 'low' WHEN capacity_kwh < 66 THEN 'middle' END) AS rating
  FROM readings GROUP BY ALL)"""
DERIVED = """met AS (SELECT *, lag(rating) OVER w AS was, row_number() OVER w AS n FROM changes WINDOW w AS (PARTITION BY device_id ORDER BY effective)),
opened AS (SELECT * FROM met WHERE n = 1 OR rating IS DISTINCT FROM was),
ended AS (SELECT device_id, rating, effective AS start_date, lead(effective) OVER (PARTITION BY device_id ORDER BY effective) AS end_date FROM opened)"""
DIMENSION = "device_key {}, device_id INT, rating STRING, start_date TIMESTAMP, end_date TIMESTAMP, current_flag BOOLEAN"
LATE_KEY = scd2.CompositeKey("device_key", "device_id", "second")


def rated(t: Tables) -> DataFrame:
    k = F.col("capacity_kwh")
    hour = t.readings().groupBy(F.col("panel_id").alias("device_id"), F.date_trunc("hour", "timestamp").alias("effective"))
    return hour.agg(F.max(F.when(k < 33, "low").when(k < 66, "middle")).alias("rating"))


def in_loads(t: Tables, order: list[int], key: str = "BIGINT") -> tuple[list[DataFrame], list[DataFrame]]:
    """Loads by the hour of the change, and the dimension after each. ``key``: type of the surrogate key."""
    changes = t.stored(rated(t), "changes")
    loads = [changes.filter(F.hour("effective") % 3 == n) for n in order]
    dims = [no_rows(t.spark, t.spark.createDataFrame([], DIMENSION.format(key)).schema)]
    for n, load in enumerate(loads):
        record = reduce(DataFrame.unionByName, loads[:n]) if n else no_rows(t.spark, load.schema)
        dims.append(t.stored(late(dims[-1], record, load), "dimension"))
    return loads, dims


def late(dim: DataFrame, record: DataFrame, load: DataFrame) -> DataFrame:
    return late_changes.scd2_late(dim, record, load, ["device_id"], ["rating"], LATE_KEY)


@query("scd2_late_changes", f"""WITH {READINGS}, {CHANGES}, {DERIVED}
SELECT CAST(device_id AS BIGINT) * 100000000000000 + CAST(strftime(start_date, '%Y%m%d%H%M%S') AS BIGINT) AS device_key, device_id, rating, start_date, end_date, end_date IS NULL AS current_flag FROM ended""")
def scd2_late_changes(t: Tables) -> DataFrame:
    """Every load's changes fall between those of the loads before."""
    return in_loads(t, [2, 0, 1])[1][-1]


@query("scd2_late_spans", f"""WITH {READINGS}, {CHANGES},
few AS (SELECT * FROM changes WHERE hour(effective) % 3 <> 1), {DERIVED.replace('changes', 'few').replace('ended', 'old').replace('met', 'met_old').replace('opened', 'opened_old')},
{DERIVED.replace('ended', 'new')},
hours AS (SELECT DISTINCT device_id, effective AS h FROM changes),
keyed AS (SELECT h.device_id, h.h, o.start_date AS old_start, n.start_date AS new_start FROM hours h
  ASOF LEFT JOIN old o ON o.device_id = h.device_id AND h.h >= o.start_date ASOF LEFT JOIN new n ON n.device_id = h.device_id AND h.h >= n.start_date)
SELECT device_id, count(*) AS hours FROM keyed WHERE old_start IS DISTINCT FROM new_start GROUP BY device_id""")
def scd2_late_spans(t: Tables) -> DataFrame:
    """Hours with readings whose facts need another key after the last load."""
    loads, dims = in_loads(t, [2, 0, 1], "DECIMAL(24, 0)")  # any INT and 14 digits of the start
    spans = late_changes.moved_spans(dims[2], dims[3], ["device_id"], "device_key")
    spans = t.stored(spans, "spans")
    hours = rated(t).select("device_id", F.col("effective").alias("h"))
    hit = as_of(hours, spans, {"device_id": "device_id"}, "h", "from", "to", ["new_key"]).filter("new_key IS NOT NULL")
    return hit.groupBy("device_id").count().withColumnRenamed("count", "hours")


DAYS = ["2024-02-01", "2024-02-02", "2024-02-03"]


@query("dim_history_parts", """WITH loads AS (SELECT * FROM (VALUES (0, TIMESTAMP '2024-02-01'), (1, TIMESTAMP '2024-02-02'), (2, TIMESTAMP '2024-02-03')) AS l(n, loaded)),
seen AS (SELECT c_custkey AS id, n, loaded, CAST(1 + n * (c_custkey % 2) AS DOUBLE) AS cap FROM customer, loads),
opened AS (SELECT * FROM seen s WHERE n = 0 OR cap <> (SELECT cap FROM seen p WHERE p.id = s.id AND p.n = s.n - 1))
SELECT CAST(id AS BIGINT) * 100000000 + CAST(strftime(loaded, '%Y%m%d') AS BIGINT) AS solar_panel_key, CAST(id AS INTEGER) AS solar_panel_id, cap AS capacity_kwh, loaded AS start_date,
  lead(loaded) OVER (PARTITION BY id ORDER BY loaded) AS end_date, lead(loaded) OVER (PARTITION BY id ORDER BY loaded) IS NULL AS current_flag FROM opened""")
def dim_history_parts(t: Tables) -> DataFrame:
    """Three loads into a stored dimension whose history is appended; every other panel changes each time."""
    lake = Lake(t.spark, t.scratch("lake"))
    for n, day in enumerate(DAYS):
        panels = t["customer"].select(
            F.col("c_custkey").cast("int").alias("id"), F.col("c_name").alias("name"), (F.lit(1.0) + n * (F.col("c_custkey") % 2)).alias("capacity_kwh"),
            F.lit(1.0).alias("intensity_power_rating"), F.lit(25.0).alias("temperature_power_rating"),
        )
        lake.write_changes(plans.dim_panel(lake.current("dim_solar_panel"), panels, F.lit(day).cast("timestamp")), "dim_solar_panel")
    return lake.dim("dim_solar_panel").select("solar_panel_key", "solar_panel_id", "capacity_kwh", "start_date", "end_date", "current_flag")
