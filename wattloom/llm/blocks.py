"""Rows of a query set in blocks of bounded size, for searches that read all other rows once per block."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F


def blocks(rows: DataFrame, size: Column, limit: int) -> Iterator[list[Row]]:
    """``rows`` (a stored table) in lists of about ``limit`` bytes by ``size``; a list goes to the driver at a time.

    Rows are dealt out by a hash of all their columns; a list is empty only if the table is. A single row may be larger than the limit.
    """
    n = int((rows.agg(F.sum(size)).first()[0] or 0) // limit) + 1
    part = F.pmod(F.xxhash64(*(F.col(f"`{c}`") for c in rows.columns)), F.lit(n))
    for k in range(n):
        found = rows.filter(part == k).collect()
        if found:
            yield found
