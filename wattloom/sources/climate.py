"""Hourly climate files: one typical year of one station per file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Layout of the format.
HEADER_LINES = 12
SITE_LINE = 10
LINES_PER_DAY = 25


def parse_clm(files: DataFrame, year: int | None = None) -> DataFrame:
    """Hourly rows of climate files given as (``station``, ``value`` = whole text).

    After the header each day is a line ``* day d month m`` and 24 lines of comma-separated numbers:
    diffuse, temperature in tenths of a degree, direct normal irradiance, and others. Hours count from 1.
    A file is a year of hours (under 200 KB), so it is one row until it is split here.
    """
    lines = files.select("station", F.split("value", "\r?\n").alias("lines"))
    site = F.split(F.get("lines", F.lit(SITE_LINE)), ",")
    in_year = F.lit(year) if year is not None else F.trim(F.get(site, F.lit(0))).try_cast("int")
    placed = lines.select("station", "lines", in_year.alias("year"), F.posexplode("lines").alias("pos", "line"))

    body = F.col("pos") - HEADER_LINES
    day_line = F.get("lines", F.col("pos") - F.pmod(body, F.lit(LINES_PER_DAY)))
    rows = placed.filter((body >= 0) & (F.pmod(body, F.lit(LINES_PER_DAY)) > 0)).select(
        "station", "year", F.pmod(body, F.lit(LINES_PER_DAY)).alias("hour"),
        F.regexp_extract(day_line, r"day\s+(\d+)", 1).try_cast("int").alias("day"),
        F.regexp_extract(day_line, r"month\s+(\d+)", 1).try_cast("int").alias("month"),
        F.split("line", ",").alias("f"),
    )
    number = lambda i: F.trim(F.get("f", F.lit(i))).try_cast("double")
    return rows.filter(F.size("f") == 6).select(
        "station", F.make_date("year", "month", "day").alias("date"), "hour",
        number(2).alias("solar_intensity"), (number(1) / 10).alias("temp"),
    )


def rejected_clm_lines(files: DataFrame) -> DataFrame:
    """``station``, ``pos``, ``line`` of hour lines that :func:`parse_clm` leaves out because they lack six fields."""
    lines = files.select("station", F.posexplode(F.split("value", "\r?\n")).alias("pos", "line"))
    body = F.col("pos") - HEADER_LINES
    return lines.filter((body >= 0) & (F.pmod(body, F.lit(LINES_PER_DAY)) > 0) & (F.size(F.split("line", ",")) != 6) & (F.trim("line") != ""))


def read_clm(spark: SparkSession, path: str | list[str], year: int | None = None) -> DataFrame:
    files = spark.read.text(path, wholetext=True)
    return parse_clm(files.select(F.col("_metadata.file_path").alias("station"), "value"), year)
