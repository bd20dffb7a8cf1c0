"""Small catalogues: panels and appliances."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattloom.schemas import TABLES

# Id, name, capacity (kWh), rated intensity, rated temperature, site.
PANELS = [
    (1, "roof panel", 3.0, 1000.0, 25.0, 1),
    (2, "pole panel", 5.0, 1300.0, 25.0, 1),
    (3, "flush panel", 10.0, 1500.0, 25.0, 1),
    (4, "kafka panel", 10.0, 1000.0, 25.0, 1),
]
LOG_PANEL_ID = 4

APPLIANCES = "MAP<STRING, STRUCT<consumption: ARRAY<DOUBLE>, time: STRING>>"


def panel_catalogue(spark: SparkSession) -> DataFrame:
    """As literal rows, so the optimizer knows how few they are."""
    rows = ", ".join(f"({', '.join(repr(v) for v in p)})" for p in PANELS)
    fields = TABLES["solar_panel"].schema.fields
    named = spark.sql(f"SELECT * FROM VALUES {rows} AS panel({', '.join(f.name for f in fields)})")
    return named.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in fields))


def parse_appliances(documents: DataFrame, home_key: int | str = 1) -> DataFrame:
    """Rows of appliance documents (column ``value``), numbered from 1 in document order.

    ``home_key`` is the home of all documents, or the column that names it.
    """
    home = F.col(home_key) if isinstance(home_key, str) else F.lit(home_key)
    parsed = documents.select(home.alias("home_key"), F.from_json("value", APPLIANCES).alias("doc"))
    entries = parsed.select("home_key", F.posexplode(F.map_entries("doc")).alias("pos", "entry"))
    rating = F.col("entry.value.consumption")
    return entries.select(
        (F.col("pos") + 1).alias("home_appliance_key"), "home_key",
        F.col("entry.key").alias("appliance"),
        F.get(rating, F.lit(0)).alias("min_consumption_power_wh"),
        F.get(rating, F.lit(1)).alias("max_consumption_power_wh"),
        F.col("entry.value.time").alias("usage_time"),
    )


def read_appliances(spark: SparkSession, path: str, home_key: int = 1) -> DataFrame:
    """One JSON object keyed by appliance name per file (a household's list, so a file is one row)."""
    return parse_appliances(spark.read.text(path, wholetext=True), home_key)
