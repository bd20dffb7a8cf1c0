"""Data-quality checks that stand in for table-format guarantees."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CORRUPT = "_corrupt_record"


def null_report(cols: list[str]) -> Column:
    """Names of the columns that are NULL in a row, comma separated; NULL when all are set."""
    names = F.concat_ws(",", *(F.when(F.col(c).isNull(), F.lit(c)) for c in cols))
    return F.when(names != "", names)


def length_report(limits: dict[str, int]) -> list[Column]:
    """Per limited text column, its name when the text is too long, else NULL."""
    return [F.when(F.length(c) > n, F.lit(f"{c} too long")) for c, n in limits.items()]


def split_not_null(df: DataFrame, cols: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows with every column set, quarantined rows with the missing names in ``missing``)."""
    tagged = df.withColumn("missing", null_report(cols))
    return tagged.filter("missing IS NULL").drop("missing"), tagged.filter("missing IS NOT NULL")


def split_corrupt(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(parsed rows, rows of lines that did not parse) of a reader with a corrupt-record column, which
    holds the text of the torn line in the second part."""
    torn = F.col(CORRUPT).isNotNull()
    return df.filter(~torn).drop(CORRUPT), df.filter(torn)


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys held by more than one row, with their row count."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def require_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """The same rows; running the plan fails when a merge key repeats or is NULL.

    A merge must not see two source rows for one target row, and key columns are NOT NULL. The check
    is a partially aggregated group-by on the merge key: its shuffle also serves the join that
    follows, and a key with many copies shrinks before it is shuffled.
    """
    rest = [c for c in df.columns if c not in keys]
    grouped = df.groupBy(*keys).agg(F.count("*").alias("_copies"), *(F.first(c).alias(c) for c in rest))
    broken = reduce(lambda a, b: a | b, (F.col(k).isNull() for k in keys), F.col("_copies") > 1)
    shown = F.concat_ws(", ", *(F.coalesce(F.col(k).cast("string"), F.lit("NULL")) for k in keys))
    message = F.concat(F.lit(f"merge key {', '.join(keys)} repeats or is NULL: "), shown)
    passed = F.when(broken, F.raise_error(message).cast("boolean")).otherwise(True)
    return grouped.filter(passed).select(*df.columns)


def current_violations(dim: DataFrame, business_key: list[str], flag: str = "current_flag") -> DataFrame:
    """Business keys that do not have exactly one current version."""
    n = F.count_if(F.coalesce(F.col(flag), F.lit(False)))
    return dim.groupBy(*business_key).agg(n.alias("n_current")).filter("n_current <> 1")


def orphan_keys(facts: DataFrame, dim: DataFrame, fact_key: str, dim_key: str) -> DataFrame:
    """Fact keys without a dimension row, with their fact count.

    Counting first leaves one row per key, so a key that holds much of the facts does not skew the join.
    """
    counted = facts.groupBy(fact_key).agg(F.count("*").alias("n"))
    known = dim.select(F.col(dim_key).alias(fact_key))
    return counted.join(known, fact_key, "left_anti")
