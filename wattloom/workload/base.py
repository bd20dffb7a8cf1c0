"""Registry and the stand-ins: ``events`` as readings, ``customer``, ``part`` as dimensions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattloom.functions.timebucket import interval_15m
from wattloom.session import scratch

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


class Tables:
    """Test tables of one folder, and tables derived from them."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")
        # Hours and days follow the session zone; the tables' timestamps have none.
        spark.conf.set("spark.sql.session.timeZone", "UTC")

    def __getitem__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def scratch(self, name: str) -> str:
        return scratch(self.spark, name)

    def stored(self, df: DataFrame, name: str) -> DataFrame:
        """Written and read again, as a table that one load leaves for the next."""
        path = self.scratch(name)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def readings(self) -> DataFrame:
        """Events with the columns of home, solar and battery readings."""
        ts = F.col("ts").cast("timestamp")
        k = F.regexp_extract("props", r"(\d+)", 1)
        return self["events"].select(
            "event_id", ts.alias("timestamp"), interval_15m(ts).alias("interval_15m"),
            F.col("user_id").cast("int").alias("panel_id"),
            F.concat(F.lit("battery_"), F.col("user_id").cast("string")).alias("battery_name"),
            F.col("value").alias("generation_power_wh"), F.col("value").alias("current_energy_wh"),
            F.col("value").alias("min_consumption_wh"), (F.col("value") * 2).alias("max_consumption_wh"),
            F.when(F.col("event_type") == "purchase", 1).otherwise(0).cast("smallint").alias("is_charging"),
            F.col("event_type").alias("status"),
            k.cast("double").alias("capacity_kwh"), F.lit(1.0).alias("max_charge_speed_w"), F.lit(3.5).alias("max_output_w"),
        )

    def devices(self) -> DataFrame:
        """A type-2 dimension from ``customer``: one segment has a closed and a current version,
        others one; customers of nations from 20 on are not in it yet."""
        return self.spark.sql(DEVICES_SPARK, customer=self["customer"])

    def incoming(self) -> DataFrame:
        """The next load for :meth:`devices`: one segment's balance moves, another's is unknown,
        customers with a negative balance have vanished."""
        return self.spark.sql(INCOMING_SPARK, customer=self["customer"])

    def appliances(self) -> DataFrame:
        """Parts as appliances; the size is the home, the schedule comes from size and type."""
        return self.spark.sql(APPLIANCES_SPARK, part=self["part"])


def query(name: str, sql: str | None = None):
    """Register a function of :class:`Tables`; timestamps leave it without a zone, as they came."""
    def add(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        QUERIES[name] = lambda spark, folder: zoneless(fn(Tables(spark, folder)))
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return add


def zoneless(df: DataFrame) -> DataFrame:
    stamps = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in stamps}) if stamps else df


# SQL for both engines, apart from the names of the types.

READINGS = """readings AS (
  SELECT event_id, ts AS timestamp, CAST(floor((hour(ts) * 60 + minute(ts) - 60) / 15.0) AS SMALLINT) AS interval_15m,
    CAST(user_id AS INTEGER) AS panel_id, 'battery_' || user_id AS battery_name,
    value AS generation_power_wh, value AS current_energy_wh, value AS min_consumption_wh, value * 2 AS max_consumption_wh,
    CAST(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS SMALLINT) AS is_charging, event_type AS status,
    CAST(CAST(props->>'k' AS INTEGER) AS DOUBLE) AS capacity_kwh, 1.0::DOUBLE AS max_charge_speed_w, 3.5::DOUBLE AS max_output_w,
    time_bucket(INTERVAL '15 minutes', ts) AS bucket
  FROM events)"""

_DEVICES = """
  SELECT c_custkey * 100000000 + 20230101 AS device_key, c_custkey AS device_id, c_name AS name, c_acctbal - 50 AS balance,
    {ts} '2023-01-01 00:00:00' AS start_date, {ts} '2024-01-15 00:00:00' AS end_date, FALSE AS current_flag
  FROM {customer} WHERE c_nationkey < 20 AND c_mktsegment = 'MACHINERY'
  UNION ALL
  SELECT c_custkey * 100000000 + CASE WHEN c_mktsegment = 'MACHINERY' THEN 20240115 ELSE 20230101 END, c_custkey, c_name, c_acctbal,
    CASE WHEN c_mktsegment = 'MACHINERY' THEN {ts} '2024-01-15 00:00:00' ELSE {ts} '2023-01-01 00:00:00' END,
    CAST(NULL AS {ts}), TRUE
  FROM {customer} WHERE c_nationkey < 20"""
_INCOMING = """
  SELECT c_custkey AS device_id, c_name AS name,
    CASE WHEN c_mktsegment = 'BUILDING' THEN c_acctbal + 100 WHEN c_mktsegment = 'FURNITURE' THEN NULL ELSE c_acctbal END AS balance
  FROM {customer} WHERE c_acctbal >= 0"""
_APPLIANCES = """
  SELECT CAST(p_partkey + 1 AS INT) AS home_appliance_key, p_size AS home_key, p_name AS appliance,
    p_retailprice AS min_consumption_power_wh, p_retailprice * 2 AS max_consumption_power_wh,
    concat(lpad(CAST(floor(p_size / {three}) AS STRING), 2, '0'), ':00-', lpad(CAST(floor(p_size / {three}) + 4 AS STRING), 2, '0'),
      CASE WHEN p_brand < 'Brand#2' THEN ':30' ELSE ':00' END, CASE WHEN p_type = 'ECONOMY' THEN ',22:00-24:00' ELSE '' END) AS usage_time
  FROM {part}"""

DEVICES_SPARK = _DEVICES.format(ts="TIMESTAMP", customer="{customer}")
INCOMING_SPARK = _INCOMING.format(customer="{customer}")
APPLIANCES_SPARK = _APPLIANCES.format(three="3", part="{part}")

DEVICES = f"devices AS ({_DEVICES.format(ts='TIMESTAMP', customer='customer')})"
INCOMING = f"incoming AS ({_INCOMING.format(customer='customer')})"
APPLIANCES = "appliances AS (" + _APPLIANCES.format(three="3.0", part="part").replace(
    "CAST(floor(p_size / 3.0) AS STRING)", "CAST(CAST(floor(p_size / 3.0) AS INT) AS STRING)").replace(
    "CAST(floor(p_size / 3.0) + 4 AS STRING)", "CAST(CAST(floor(p_size / 3.0) + 4 AS INT) AS STRING)") + ")"

# The load that came before, for insert-only merges: it ends inside a bucket.
LOADED_UNTIL = "2024-01-16 00:07:00"
NOW = "2024-02-01 00:00:00"
