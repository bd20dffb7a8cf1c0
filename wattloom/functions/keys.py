"""Surrogate keys and device ids."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Resolution of a composite key: date pattern and the factor that makes room for its digits.
# In a BIGINT seconds leave 5 digits for the id (up to 92,232), days leave 11; a wide key has room for every BIGINT id.
RESOLUTIONS = {"day": ("yyyyMMdd", 10**8), "second": ("yyyyMMddHHmmss", 10**14)}


def composite_key(entity_id: Column, at: Column, resolution: str = "day", wide: bool = False) -> Column:
    """Id followed by the digits of a date, as BIGINT (an INT overflows from id 22 on), or ``wide`` as a DECIMAL that no BIGINT id overflows."""
    pattern, factor = RESOLUTIONS[resolution]
    digits = F.date_format(at, pattern).cast("bigint")
    if wide:
        return entity_id.cast("bigint").cast("decimal(19,0)") * F.lit(Decimal(factor)) + digits
    return entity_id.cast("bigint") * F.lit(factor) + digits


def device_id_from_name(name: Column) -> Column:
    """Number after the first underscore (``battery_7`` gives 7); NULL when there is none."""
    return F.split_part(name, F.lit("_"), F.lit(2)).try_cast("int")


def dense_keys(
    rows: DataFrame, business_key: list[str], key: str, start: Column | None = None,
    buckets: int = 1024, bucket: Column | None = None,
) -> DataFrame:
    """Number rows without gaps from ``start`` + 1, with no global sort and no single-task window.

    Rows are numbered inside hash buckets of the business key and shifted by the row counts of
    the buckets before. Only the counts, at most one row per bucket, meet in one task. Order is
    (bucket, business key), a function of the data alone, so a recomputed task gives the same keys.
    """
    spot = bucket if bucket is not None else F.pmod(F.xxhash64(*business_key), F.lit(buckets))
    placed = rows.withColumn("_bucket", spot)
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("_bucket").agg(F.count("*").alias("_n")).select(
        "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")
    )
    inside = Window.partitionBy("_bucket").orderBy(*business_key)
    numbered = placed.withColumn("_rn", F.row_number().over(inside)).join(offsets, "_bucket")
    first = F.coalesce(start, F.lit(0)) if start is not None else F.lit(0)
    return numbered.withColumn(key, (first + F.col("_before") + F.col("_rn")).cast("bigint")).drop(
        "_bucket", "_rn", "_before"
    )


def max_key(dim: DataFrame, key: str) -> Column:
    """Largest key in use, as an uncorrelated scalar subquery; 0 for an empty dimension."""
    return dim.agg(F.coalesce(F.max(key), F.lit(0)).alias("k")).scalar()


def next_key(dim: DataFrame, new: DataFrame, business_key: list[str], key: str, **kw) -> DataFrame:
    """Give every row of ``new`` the next free keys of ``dim``."""
    return dense_keys(new, business_key, key, start=max_key(dim, key), **kw)
