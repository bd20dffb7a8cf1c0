"""Row predicates and projections shared by the merge operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def changed(
    target: str, source: str, cols: list[str], null_safe: bool = False,
) -> Column:
    """True when any of ``cols`` differs between two aliased sides.

    Plain ``!=`` never sees a change from or to NULL; ``null_safe`` does.
    """
    def differs(name: str) -> Column:
        a, b = F.col(f"{target}.{name}"), F.col(f"{source}.{name}")
        return ~a.eqNullSafe(b) if null_safe else a != b

    return F.coalesce(reduce(lambda x, y: x | y, (differs(c) for c in cols)), F.lit(False))


def current(dim: DataFrame, flag: str = "current_flag") -> DataFrame:
    return dim.filter(F.col(flag))


def select_as(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Projection with new names: ``{new: old}``."""
    return df.select(*(F.col(old).alias(new) for new, old in mapping.items()))


def flatten(df: DataFrame, struct_col: str) -> DataFrame:
    """Replace a struct column by its fields."""
    rest = [F.col(c) for c in df.columns if c != struct_col]
    return df.select(*rest, F.col(f"{struct_col}.*"))
