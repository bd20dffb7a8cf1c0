"""15-minute time buckets and calendar predicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MINUTE_US = 60 * 1_000_000
QUARTER_US = 15 * MINUTE_US


def interval_15m(ts: Column, origin_minute: int = 60) -> Column:
    """Index of the quarter hour within the day, counted from 01:00.

    The hour before the origin gives -4 .. -1, because derived days start at hour 1.
    """
    minute_of_day = F.hour(ts) * 60 + F.minute(ts)
    return F.floor((minute_of_day - F.lit(origin_minute)) / F.lit(15)).cast("smallint")


def micros(ts: Column) -> Column:
    """Microseconds since the epoch, for TIMESTAMP and TIMESTAMP_NTZ alike."""
    return F.unix_micros(ts.cast("timestamp"))


def bucket_start(ts: Column, width_us: int = QUARTER_US) -> Column:
    """Start of the epoch-aligned bucket holding ``ts``; exact integer arithmetic, also before 1970."""
    us = micros(ts)
    return F.timestamp_micros(us - F.pmod(us, F.lit(width_us)))


def bucket_start_from_text(ts: Column) -> Column:
    """The same instant as :func:`bucket_start` (UTC), put together from calendar fields as text."""
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    quarter = F.floor(F.minute(ts) / 15) * 15
    text = F.concat(
        F.lpad(F.year(ts).cast("string"), 4, "0"), F.lit("-"), two(F.month(ts)), F.lit("-"), two(F.dayofmonth(ts)),
        F.lit(" "), two(F.hour(ts)), F.lit(":"), two(quarter), F.lit(":00"),
    )
    return text.try_cast("timestamp")


def on_day(df: DataFrame, date: str | list[str] | None, ts: str = "ts", day: str = "day") -> DataFrame:
    """Rows of one calendar day, or of any of several; all rows when ``date`` is None.

    The date comparison becomes a range on ``ts`` and reaches the parquet reader. It does not
    prune a materialised ``day`` partition column, so that column is compared as well when present.
    """
    if date is None:
        return df
    if not isinstance(date, str):
        wanted = [F.lit(d).cast("date") for d in date]
        keep = F.to_date(F.col(ts)).isin(*wanted)
        return df.filter(F.col(day).isin(*wanted) & keep if day in df.columns else keep)
    wanted = F.lit(date).cast("date")
    keep = F.to_date(F.col(ts)) == wanted
    if day in df.columns:
        keep = (F.col(day) == wanted) & keep
    return df.filter(keep)


def on_day_of_month(df: DataFrame, n: int, ts: str = "ts") -> DataFrame:
    """Rows whose day of month is ``n``, in any month (a full scan by nature)."""
    return df.filter(F.dayofmonth(F.col(ts)) == F.lit(n))


def is_weekend(ts: Column, weekend_days: tuple[int, ...] = (6,)) -> Column:
    """Weekday test with Monday = 0. The default knows Sunday only, as the stored calendar does."""
    return F.when(F.weekday(ts).isin(*weekend_days), True).otherwise(False)


def month_start(ts: Column) -> Column:
    """Partition value for month-partitioned facts."""
    return F.trunc(F.to_date(ts), "month")
