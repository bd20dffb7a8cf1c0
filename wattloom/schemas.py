"""The twelve tables: columns, partitions, keys; and their catalog DDL."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


TYPES = {
    "timestamp": T.TimestampType(), "date": T.DateType(), "string": T.StringType(), "boolean": T.BooleanType(),
    "smallint": T.ShortType(), "int": T.IntegerType(), "bigint": T.LongType(), "float": T.FloatType(), "double": T.DoubleType(),
}


@dataclass(frozen=True)
class Table:
    layer: str
    columns: tuple[str, ...]
    partitions: tuple[str, ...] = ()
    keys: tuple[str, ...] = ()

    def _parsed(self) -> list[tuple[str, str, bool]]:
        out = []
        for line in self.columns:
            required = line.endswith(" NOT NULL")
            name, kind = line.removesuffix(" NOT NULL").split(" ", 1)
            out.append((name, kind.lower(), not required))
        return out

    @property
    def schema(self) -> T.StructType:
        schema = T.StructType()
        for name, kind, nullable in self._parsed():
            schema = schema.add(name, TYPES["string" if kind.startswith("varchar") else kind], nullable)
        return schema

    @property
    def required(self) -> list[str]:
        return [name for name, _, nullable in self._parsed() if not nullable]

    @property
    def text_limits(self) -> dict[str, int]:
        found = ((name, re.fullmatch(r"varchar\((\d+)\)", kind)) for name, kind, _ in self._parsed())
        return {name: int(m.group(1)) for name, m in found if m}

    def ddl(self, qualified: str, location: str | None = None) -> str:
        by = f" PARTITIONED BY ({', '.join(self.partitions)})" if self.partitions else ""
        at = f" LOCATION '{location}'" if location else ""
        return f"CREATE TABLE IF NOT EXISTS {qualified} ({', '.join(self.columns)}) USING parquet{by}{at}"


# Table and column names and types of the two layers. Surrogate keys are BIGINT
# and sums DOUBLE, so that keys of id and date do not overflow and sums keep their digits.
# Raw tables are split by load (what came in one file) and day, facts by month; `load`, `day`, `month` are stored columns.
TABLES: dict[str, Table] = {
    "home_power_readings": Table("raw", (
        "timestamp TIMESTAMP NOT NULL", "interval_15m SMALLINT NOT NULL",
        "min_consumption_wh FLOAT NOT NULL", "max_consumption_wh FLOAT NOT NULL",
        "source STRING NOT NULL", "load STRING NOT NULL", "day DATE NOT NULL",
    ), ("load", "day")),
    "solar_panel": Table("raw", (
        "id INT NOT NULL", "name VARCHAR(25) NOT NULL", "capacity_kwh FLOAT NOT NULL",
        "intensity_power_rating FLOAT NOT NULL", "temperature_power_rating FLOAT NOT NULL",
        "site_id INT NOT NULL",
    ), (), ("id",)),
    "solar_panel_readings": Table("raw", (
        "timestamp TIMESTAMP NOT NULL", "interval_15m SMALLINT NOT NULL", "panel_id INT NOT NULL",
        "generation_power_wh FLOAT NOT NULL", "source STRING NOT NULL", "load STRING NOT NULL", "day DATE NOT NULL",
    ), ("load", "day")),
    "battery_readings": Table("raw", (
        "timestamp TIMESTAMP NOT NULL", "interval_15m SMALLINT NOT NULL", "battery_name VARCHAR(15) NOT NULL",
        "capacity_kwh FLOAT NOT NULL", "max_charge_speed_w FLOAT NOT NULL", "current_energy_wh FLOAT NOT NULL",
        "is_charging SMALLINT NOT NULL", "status VARCHAR(15) NOT NULL", "max_output_w FLOAT NOT NULL",
        "source STRING NOT NULL", "load STRING NOT NULL", "day DATE NOT NULL",
    ), ("load", "day")),
    "dim_home": Table("wh", (
        "home_key BIGINT NOT NULL", "home_id INT NOT NULL", "min_consumption_power_wh DOUBLE NOT NULL",
        "max_consumption_power_wh DOUBLE NOT NULL", "start_date TIMESTAMP NOT NULL", "end_date TIMESTAMP",
        "current_flag BOOLEAN NOT NULL",
    ), (), ("home_key",)),
    "dim_home_appliances": Table("wh", (
        "home_appliance_key INT NOT NULL", "home_key INT NOT NULL", "appliance VARCHAR(25) NOT NULL",
        "min_consumption_power_wh DOUBLE NOT NULL", "max_consumption_power_wh DOUBLE NOT NULL",
        "usage_time VARCHAR(50) NOT NULL",
    ), (), ("home_appliance_key",)),
    "fact_home_power_readings": Table("wh", (
        "home_power_reading_key TIMESTAMP NOT NULL", "home_key BIGINT NOT NULL", "date_key TIMESTAMP NOT NULL",
        "min_consumption_power_wh DOUBLE NOT NULL", "max_consumption_power_wh DOUBLE NOT NULL",
        "month DATE NOT NULL",
    ), ("month",), ("home_power_reading_key",)),
    "dim_solar_panel": Table("wh", (
        "solar_panel_key BIGINT NOT NULL", "solar_panel_id INT NOT NULL", "name VARCHAR(25) NOT NULL",
        "capacity_kwh DOUBLE NOT NULL", "intensity_power_rating_wh DOUBLE NOT NULL",
        "temperature_power_rating_c DOUBLE NOT NULL", "start_date TIMESTAMP NOT NULL", "end_date TIMESTAMP",
        "current_flag BOOLEAN NOT NULL",
    ), (), ("solar_panel_key",)),
    "fact_solar_panel_power_readings": Table("wh", (
        "solar_panel_key BIGINT NOT NULL", "date_key TIMESTAMP NOT NULL", "solar_panel_id INT NOT NULL",
        "generation_power_wh DOUBLE NOT NULL", "month DATE NOT NULL",
    ), ("month",), ("solar_panel_id", "date_key")),
    "dim_battery": Table("wh", (
        "battery_key BIGINT NOT NULL", "battery_id INT NOT NULL", "name VARCHAR(15) NOT NULL",
        "capacity_kwh DOUBLE NOT NULL", "max_charge_speed_w DOUBLE NOT NULL", "max_output_w DOUBLE NOT NULL",
        "start_date TIMESTAMP NOT NULL", "end_date TIMESTAMP", "current_flag BOOLEAN NOT NULL",
    ), (), ("battery_key",)),
    "fact_battery_power_readings": Table("wh", (
        "battery_key BIGINT NOT NULL", "date_key TIMESTAMP NOT NULL", "battery_id INT NOT NULL",
        "current_energy_wh DOUBLE NOT NULL", "is_charging SMALLINT NOT NULL", "status VARCHAR(15) NOT NULL",
        "month DATE NOT NULL",
    ), ("month",), ("battery_id", "date_key")),
    "dim_date": Table("wh", (
        "date_key TIMESTAMP NOT NULL", "year SMALLINT NOT NULL", "quarter SMALLINT NOT NULL",
        "month SMALLINT NOT NULL", "week SMALLINT NOT NULL", "day SMALLINT NOT NULL", "hour SMALLINT NOT NULL",
        "interval_15m SMALLINT NOT NULL", "is_weekend BOOLEAN NOT NULL",
    ), (), ("date_key",)),
}


def as_table(df: DataFrame, table: str) -> DataFrame:
    """Columns in table order and type. A value that does not fit its type fails the job."""
    return df.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in TABLES[table].schema.fields))


def no_rows(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """An empty frame that the optimizer knows to be empty, so joins with it fold away."""
    columns = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
    return spark.range(1).filter(F.lit(False)).select(*columns)


def empty_table(spark: SparkSession, table: str) -> DataFrame:
    return no_rows(spark, TABLES[table].schema)


def namespace_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.databaseExists(name)


def ensure_tables(spark: SparkSession, raw: str, wh: str, location: str | None = None) -> list[str]:
    """Create both namespaces and all tables where absent; the qualified names."""
    names = []
    for layer, namespace in (("raw", raw), ("wh", wh)):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {namespace}")
        for name, table in TABLES.items():
            if table.layer == layer:
                qualified = f"{namespace}.{name}"
                spark.sql(table.ddl(qualified, f"{location}/{namespace}/{name}" if location else None))
                names.append(qualified)
    return names


def drop_tables(spark: SparkSession, names: list[str], purge: bool = True) -> None:
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS {name}" + (" PURGE" if purge else ""))


def describe(spark: SparkSession, table: str) -> DataFrame:
    return spark.sql(f"DESCRIBE {table}")


def list_tables(spark: SparkSession, namespace: str) -> DataFrame:
    return spark.sql(f"SHOW TABLES IN {namespace}")


def list_namespaces(spark: SparkSession) -> DataFrame:
    return spark.sql("SHOW DATABASES")


def list_catalogs(spark: SparkSession) -> DataFrame:
    return spark.sql("SHOW CATALOGS")
