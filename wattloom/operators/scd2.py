"""Type-2 slowly changing dimensions.

A dimension has a surrogate key, business key columns, attributes, and ``start_date``,
``end_date``, ``current_flag``. Only current versions meet the source in a join; closed history is
carried over by a union and never shuffled, however many versions a business key has gathered.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattloom.functions.keys import composite_key, next_key
from wattloom.functions.predicates import changed
from wattloom.operators.quality import require_unique
from wattloom.operators.timeline import as_of
from wattloom.session import scratch

START, END, FLAG = "start_date", "end_date", "current_flag"
OPENED = "_opened"


@dataclass(frozen=True)
class CompositeKey:
    """Business id followed by the digits of the start date. A column expression: no shuffle. A dimension whose key is a DECIMAL gets wide keys,
    for business ids that leave a BIGINT no room for the date."""

    key: str
    business_id: str
    resolution: str = "day"

    def fill(self, dim: DataFrame, rows: DataFrame) -> DataFrame:
        kind = dim.schema[self.key].dataType
        wide = isinstance(kind, T.DecimalType)
        made = composite_key(F.col(self.business_id), F.col(START), self.resolution, wide)
        made = made.cast(kind) if wide else made
        return rows.withColumn(self.key, F.when(F.col(OPENED), made).otherwise(F.col(self.key)))


@dataclass(frozen=True)
class DenseKey:
    """Largest key in use plus 1, 2, … over the new versions.

    The joined rows (current and new versions) are needed three times: as they are, numbered, and counted by bucket. They are
    written below the shared folder once instead of being joined three times, and again for every load built on this one.
    """

    key: str
    business_key: tuple[str, ...]
    buckets: int = 1024
    bucket: Column | None = None

    def fill(self, dim: DataFrame, rows: DataFrame) -> DataFrame:
        path = scratch(rows.sparkSession, "versions")
        rows.write.parquet(path)
        rows = rows.sparkSession.read.schema(rows.schema).parquet(path)
        opened = rows.filter(OPENED)
        numbered = next_key(
            dim, opened, list(self.business_key), self.key, buckets=self.buckets, bucket=self.bucket
        )
        return rows.filter(~F.col(OPENED)).unionByName(numbered)


def _live(dim: DataFrame) -> DataFrame:
    return dim.filter(F.coalesce(F.col(FLAG), F.lit(False)))


def _past(dim: DataFrame) -> DataFrame:
    return dim.filter(~F.coalesce(F.col(FLAG), F.lit(False)))


def _on(business_key: list[str]) -> list[Column]:
    return [F.col(f"t.{k}") == F.col(f"s.{k}") for k in business_key]


def _opened_columns(dim: DataFrame, source: DataFrame, now: Column, side: str) -> list[Column]:
    """One new version in the dimension's column order and types; the surrogate key is still NULL."""
    fixed = {START: now, END: F.lit(None), FLAG: F.lit(True)}

    def value(name: str) -> Column:
        if name in fixed:
            return fixed[name]
        return F.col(f"{side}.{name}") if name in source.columns else F.lit(None)

    return [value(f.name).cast(f.dataType).alias(f.name) for f in dim.schema.fields]


def scd2_close(
    dim: DataFrame, source: DataFrame, business_key: list[str], tracked: list[str],
    now: Column, null_safe: bool = False,
) -> DataFrame:
    """End the current versions whose tracked columns differ from the source."""
    incoming = require_unique(source, business_key).withColumn("_s", F.lit(True)).alias("s")
    joined = _live(dim).alias("t").join(incoming, _on(business_key), "left")
    ends = F.col("_s").isNotNull() & changed("t", "s", tracked, null_safe)
    set_cols = {END: F.when(ends, now).otherwise(F.col(f"t.{END}")), FLAG: ~ends}
    closed = joined.select(*(
        set_cols.get(f.name, F.col(f"t.{f.name}")).cast(f.dataType).alias(f.name) for f in dim.schema.fields
    ))
    return _past(dim).unionByName(closed)


def scd2_open(
    dim: DataFrame, source: DataFrame, business_key: list[str], now: Column, key: CompositeKey | DenseKey,
) -> DataFrame:
    """Add a version for each source row whose business key has no current version."""
    missing = source.join(_live(dim).select(*business_key), business_key, "left_anti").alias("s")
    opened = missing.select(*_opened_columns(dim, source, now, "s"), F.lit(True).alias(OPENED))
    return dim.unionByName(key.fill(dim, opened).drop(OPENED))


def scd2_apply(
    dim: DataFrame, source: DataFrame, business_key: list[str], tracked: list[str],
    now: Column, key: CompositeKey | DenseKey, null_safe: bool = False, known: DataFrame | None = None,
) -> DataFrame:
    """Close and open in one pass: the whole dimension afterwards. Given the current rows alone, it is the current rows and the newly
    closed ones; ``known`` then is the whole dimension, for the largest key in use.

    One full outer join of current versions and source; a changed pair gives two rows, the closed
    version and its successor. Keys missing from the source stay current.
    """
    t = _live(dim).withColumn("_t", F.lit(True)).alias("t")
    s = require_unique(source, business_key).withColumn("_s", F.lit(True)).alias("s")
    joined = t.join(s, _on(business_key), "full_outer")

    in_t, in_s = F.col("_t").isNotNull(), F.col("_s").isNotNull()
    ends = in_t & in_s & changed("t", "s", tracked, null_safe)
    set_cols = {END: F.when(ends, now).otherwise(F.col(f"t.{END}")), FLAG: ~ends}
    kept = F.struct(
        *(set_cols.get(f.name, F.col(f"t.{f.name}")).cast(f.dataType).alias(f.name) for f in dim.schema.fields),
        F.lit(False).alias(OPENED),
    )
    opened = F.struct(*_opened_columns(dim, source, now, "s"), F.lit(True).alias(OPENED))
    versions = F.array_compact(F.array(F.when(in_t, kept), F.when(in_s & (~in_t | ends), opened)))
    rows = key.fill(dim if known is None else known, joined.select(F.inline(versions))).drop(OPENED)
    return _past(dim).unionByName(rows)


def scd2_as_of_join(
    facts: DataFrame, dim: DataFrame, on: dict[str, str], ts: str, cols: list[str], from_start: bool = False,
) -> DataFrame:
    """Facts with ``cols`` of the version valid at ``ts`` (start included, end excluded).

    ``from_start``: the first version of a business key is valid at any time before its end. ``on`` maps fact column to
    dimension column. See :func:`wattloom.operators.timeline.as_of`.
    """
    return as_of(facts, dim, on, ts, START, END, cols, from_start)
