"""Look-ups of facts in dimensions.

No join here forces a broadcast. Catalyst broadcasts a side whose statistics are below
``spark.sql.autoBroadcastJoinThreshold`` and adaptive execution does so once it has measured one;
beyond that size both sides are shuffled on the key, and adaptive execution cuts skewed partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattloom.functions.predicates import current


def estimated_bytes(df: DataFrame) -> int:
    """Size of a frame as the optimizer estimates it from statistics; no job runs."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def will_broadcast(df: DataFrame) -> bool:
    """Whether Catalyst broadcasts the frame as a join side, by its estimate and the session's threshold."""
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return estimated_bytes(df) <= limit


def spread_join(
    left: DataFrame, right: DataFrame, on: dict[str, str], how: str,
    spread_by: list[str], extra: list[Column] | None = None, salts: int = 8,
) -> DataFrame:
    """Equi-join (inner or left) where one key may hold much of ``left``.

    A right side that is known to be small is left to Catalyst, which broadcasts it: no row of ``left`` moves. Otherwise each left
    row goes to one of ``salts`` groups of its key, by a hash of ``spread_by``, and the right side is repeated once per group. The
    result is that of the plain join. ``on`` maps left to right column; the names must differ, and the right ones are dropped.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"spread_join repeats the right side, so it cannot do a {how} join")
    l, r = left, right
    condition = [F.col(a) == F.col(b) for a, b in on.items()] + (extra or [])
    if salts > 1 and not will_broadcast(right):
        l = left.withColumn("_l_salt", F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int"))
        r = right.withColumn("_r_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        condition.append(F.col("_l_salt") == F.col("_r_salt"))
    return l.join(r, condition, how).drop("_l_salt", "_r_salt", *on.values())


def attach_current_key(facts: DataFrame, dim: DataFrame, on: dict[str, str], key: str) -> DataFrame:
    """Left join of staged facts with the current version's surrogate key.

    Stage (bucket) the facts first: then a device has one row per bucket and no key is hot.
    """
    names = {d: f"_d_{d}" for d in on.values()}
    look_up = current(dim).select(key, *(F.col(d).alias(n) for d, n in names.items()))
    condition = [F.col(f) == F.col(names[d]) for f, d in on.items()]
    return facts.join(look_up, condition, "left").drop(*names.values())


def left_join_current(df: DataFrame, dim: DataFrame, on: list[str]) -> DataFrame:
    """Left join with the current-version test inside the ON clause: rows without one keep NULLs."""
    l, r = df.alias("l"), dim.alias("r")
    condition = [F.col(f"l.{k}") == F.col(f"r.{k}") for k in on] + [F.col("r.current_flag")]
    rest = [F.col(f"r.{c}") for c in dim.columns if c not in on and c not in df.columns]
    return l.join(r, condition, "left").select("l.*", *rest)


def attach_scalar(df: DataFrame, one_row: DataFrame, name: str) -> DataFrame:
    """Add the single value of ``one_row`` as a column, by a scalar subquery.

    No row gives NULL; more than one row fails the query.
    """
    return df.withColumn(name, one_row.scalar())
