"""Reports, filters and time buckets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.functions.predicates import current
from wattloom.functions.timebucket import bucket_start, bucket_start_from_text, interval_15m, on_day, on_day_of_month
from wattloom.operators import analytics
from wattloom.workload.base import DEVICES, READINGS, Tables, query

BOTH = ["min_consumption_wh", "max_consumption_wh"]


def rounded(df: DataFrame, digits: int, *cols: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in cols})


SUMS = "round(sum(min_consumption_wh), 4) AS min_consumption_wh, round(sum(max_consumption_wh), 4) AS max_consumption_wh"


@query("daily_kwh", f"""WITH {READINGS} SELECT CAST(day(timestamp) AS INTEGER) AS day, round(sum(min_consumption_wh) / 1000, 6) AS min_consumption_wh,
  round(sum(max_consumption_wh) / 1000, 6) AS max_consumption_wh FROM readings GROUP BY 1""")
def daily_kwh(t: Tables) -> DataFrame:
    return rounded(analytics.daily_kwh(t.readings(), BOTH), 6, *BOTH)


@query("hourly_wh", f"""WITH {READINGS} SELECT CAST(day(timestamp) AS INTEGER) AS day, CAST(hour(timestamp) AS INTEGER) AS hour, {SUMS}
FROM readings GROUP BY 1, 2""")
def hourly_wh(t: Tables) -> DataFrame:
    return rounded(analytics.hourly_wh(t.readings(), BOTH), 4, *BOTH)


@query("hourly_wh_one_day", f"""WITH {READINGS} SELECT CAST(day(timestamp) AS INTEGER) AS day, CAST(hour(timestamp) AS INTEGER) AS hour, {SUMS}
FROM readings WHERE day(timestamp) = 1 GROUP BY 1, 2""")
def hourly_wh_one_day(t: Tables) -> DataFrame:
    return rounded(analytics.hourly_wh(t.readings(), BOTH, day=1), 4, *BOTH)


@query("minute_wh", f"""WITH {READINGS} SELECT CAST(timestamp AS DATE) AS date, date_trunc('minute', timestamp) AS minute, {SUMS}
FROM readings GROUP BY 1, 2""")
def minute_wh(t: Tables) -> DataFrame:
    return rounded(analytics.minute_wh(t.readings(), BOTH), 4, *BOTH)


@query("date_interval_wh", f"""WITH {READINGS} SELECT CAST(timestamp AS DATE) AS date, interval_15m, {SUMS},
  CAST(CAST(timestamp AS DATE) AS VARCHAR) || '--' || interval_15m AS reading_id FROM readings GROUP BY CAST(timestamp AS DATE), interval_15m""")
def date_interval_wh(t: Tables) -> DataFrame:
    return rounded(analytics.date_interval_wh(t.readings(), BOTH), 4, *BOTH)


@query("interval_sum", f"WITH {READINGS} SELECT interval_15m, round(sum(generation_power_wh), 4) AS generation_power_wh FROM readings GROUP BY interval_15m")
def interval_sum(t: Tables) -> DataFrame:
    return rounded(analytics.interval_sum(t.readings(), "generation_power_wh"), 4, "generation_power_wh")


@query("top_intervals", f"""WITH {READINGS}, s AS (SELECT panel_id, interval_15m, round(sum(generation_power_wh), 4) AS generation_power_wh FROM readings GROUP BY ALL)
SELECT * FROM s ORDER BY generation_power_wh DESC, panel_id, interval_15m LIMIT 20""")
def top_intervals(t: Tables) -> DataFrame:
    return analytics.top_intervals(t.readings(), "panel_id", "generation_power_wh", digits=4)


@query("row_counts_by_day", f"WITH {READINGS} SELECT CAST(timestamp AS DATE) AS date, count(*) AS n FROM readings GROUP BY 1")
def row_counts_by_day(t: Tables) -> DataFrame:
    return analytics.row_counts(t.readings(), [F.to_date("timestamp").alias("date")])


@query("row_count", "SELECT count(*) AS n FROM lineitem")
def row_count(t: Tables) -> DataFrame:
    return analytics.row_counts(t["lineitem"])


@query("row_count_non_null", f"WITH {DEVICES} SELECT count(end_date) AS n FROM devices")
def row_count_non_null(t: Tables) -> DataFrame:
    return analytics.row_counts(t.devices(), non_null="end_date")


@query("on_day", "SELECT event_id, ts, value FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-03'")
def one_day(t: Tables) -> DataFrame:
    return on_day(t["events"].select("event_id", "ts", "value"), "2024-01-03")


@query("on_day_of_month", "SELECT o_orderkey, o_orderdate FROM orders WHERE day(o_orderdate) = 2")
def one_day_of_month(t: Tables) -> DataFrame:
    return on_day_of_month(t["orders"].select("o_orderkey", "o_orderdate"), 2, "o_orderdate")


@query("current_versions", f"WITH {DEVICES} SELECT * FROM devices WHERE current_flag")
def current_versions(t: Tables) -> DataFrame:
    return current(t.devices())


@query("interval_index", """SELECT CAST(floor((hour(ts) * 60 + minute(ts) - 60) / 15.0) AS SMALLINT) AS interval_15m, count(*) AS n,
  min(ts) AS first_ts FROM events GROUP BY 1""")
def interval_index(t: Tables) -> DataFrame:
    return t["events"].groupBy(interval_15m(F.col("ts")).alias("interval_15m")).agg(F.count("*").alias("n"), F.min("ts").alias("first_ts"))


@query("bucket_15m", """SELECT event_id, time_bucket(INTERVAL '15 minutes', ts) AS bucket,
  time_bucket(INTERVAL '15 minutes', ts) AS bucket_from_text, time_bucket(INTERVAL '5 minutes', ts) AS bucket_5m FROM events""")
def bucket_15m(t: Tables) -> DataFrame:
    ts = F.col("ts")
    return t["events"].select(
        "event_id", bucket_start(ts).alias("bucket"), bucket_start_from_text(ts).alias("bucket_from_text"),
        bucket_start(ts, 300_000_000).alias("bucket_5m"),
    )
