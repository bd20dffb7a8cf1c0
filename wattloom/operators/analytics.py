"""Reports on readings and facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattloom.functions.timebucket import interval_15m, on_day_of_month


def _sums(cols: list[str], scale: float | None = None) -> list[Column]:
    def total(c: str) -> Column:
        s = F.sum(F.col(c).cast("double"))
        return (s if scale is None else s / F.lit(scale)).alias(c)

    return [total(c) for c in cols]


def daily_kwh(readings: DataFrame, cols: list[str], ts: str = "timestamp") -> DataFrame:
    """kWh by day of month."""
    return readings.groupBy(F.dayofmonth(ts).alias("day")).agg(*_sums(cols, 1000.0))


def hourly_wh(readings: DataFrame, cols: list[str], day: int | None = None, ts: str = "timestamp") -> DataFrame:
    """Wh by day of month and hour, for one day of month or all."""
    rows = readings if day is None else on_day_of_month(readings, day, ts)
    return rows.groupBy(F.dayofmonth(ts).alias("day"), F.hour(ts).alias("hour")).agg(*_sums(cols))


def minute_wh(readings: DataFrame, cols: list[str], day: int | None = None, ts: str = "timestamp") -> DataFrame:
    """Wh by date and minute."""
    rows = readings if day is None else on_day_of_month(readings, day, ts)
    return rows.groupBy(F.to_date(ts).alias("date"), F.date_trunc("minute", ts).alias("minute")).agg(*_sums(cols))


def date_interval_wh(readings: DataFrame, cols: list[str], day: int | None = None, ts: str = "timestamp") -> DataFrame:
    """Wh by date and quarter-hour index, with the text id ``date--index``."""
    rows = readings if day is None else on_day_of_month(readings, day, ts)
    summed = rows.groupBy(F.to_date(ts).alias("date"), interval_15m(F.col(ts)).alias("interval_15m")).agg(*_sums(cols))
    text_id = F.concat(F.col("date").cast("string"), F.lit("--"), F.col("interval_15m").cast("string"))
    return summed.withColumn("reading_id", text_id)


def interval_sum(df: DataFrame, col: str, interval: str = "interval_15m") -> DataFrame:
    return df.groupBy(interval).agg(*_sums([col]))


def top_k(df: DataFrame, order: list[Column], k: int) -> DataFrame:
    """First ``k`` rows of a global order; the order should end in a tie-break."""
    return df.orderBy(*order).limit(k)


def top_intervals(
    readings: DataFrame, device: str, col: str, n: int = 20, interval: str = "interval_15m", digits: int = 6,
) -> DataFrame:
    """The ``n`` (device, quarter-hour index) pairs with the largest sums.

    Sums are rounded before they are ranked, so that the order of adding up does not decide a tie.
    """
    summed = readings.groupBy(device, interval).agg(F.round(F.sum(F.col(col).cast("double")), digits).alias(col))
    return top_k(summed, [F.col(col).desc(), F.col(device), F.col(interval)], n)


def row_counts(df: DataFrame, by: list[Column] | None = None, non_null: str | None = None) -> DataFrame:
    """Row count of a table, by group, or of the rows where a column is set."""
    n = F.count(non_null if non_null else F.lit(1)).alias("n")
    return df.groupBy(*by).agg(n) if by else df.agg(n)


def distinct_years(dim_date: DataFrame) -> DataFrame:
    return dim_date.select("year").distinct()
