"""Series in time order, cut into chunks, with what crosses a chunk's border carried over.

A key may hold a third of all rows: its rows go to one group per key and chunk of time, and are read there in order once. What
the rows of a chunk need from before or behind comes from a table with one row per key and chunk.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattloom.functions.timebucket import micros

DAY_US = 86_400_000_000
_CHUNK = "_chunk"


def _placed(rows: DataFrame, at: str, chunk_us: int) -> DataFrame:
    return rows.withColumn(_CHUNK, F.floor(micros(F.col(at)) / F.lit(chunk_us)))


def _with_edges(local: DataFrame, edges: DataFrame, key: list[str]) -> DataFrame:
    """Rows without key or time meet no edge, as NULLs are equal to nothing."""
    renamed = edges.withColumnsRenamed({k: f"_e{i}" for i, k in enumerate(key)})
    return local.join(renamed, [F.col(k) == F.col(f"_e{i}") for i, k in enumerate(key)], "left").drop(*(f"_e{i}" for i in range(len(key))))


def last_known(rows: DataFrame, by: list[str], at: str, value: str, order: list[Column], chunk_us: int = DAY_US) -> DataFrame:
    """Rows with ``_known``, the last ``value`` that is not NULL up to the row by ``at``, then ``order``, and ``_first``, the first of the series.

    ``order`` must decide between values of the same time.
    """
    key = [*by, _CHUNK]
    placed = _placed(rows, at, chunk_us)
    place = F.struct(F.col(at), *order)
    there = F.col(value).isNotNull()
    edges = placed.groupBy(*key).agg(
        F.max_by(F.when(there, F.col(value)), F.when(there, place)).alias("_last"),
        F.min_by(F.when(there, F.col(value)), F.when(there, place)).alias("_head"),
    )
    chunks = Window.partitionBy(*by).orderBy(_CHUNK)
    edges = edges.select(
        *key, F.last("_last", ignorenulls=True).over(chunks.rowsBetween(Window.unboundedPreceding, -1)).alias("_carried"),
        F.first("_head", ignorenulls=True).over(chunks.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("_first"),
    )
    inside = Window.partitionBy(*key).orderBy(F.col(at), *order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = placed.withColumn("_here", F.last(value, ignorenulls=True).over(inside))
    out = _with_edges(local, edges, key)
    return out.withColumn("_known", F.coalesce("_here", "_carried")).drop("_here", "_carried", _CHUNK)


def neighbours(rows: DataFrame, by: list[str], at: str, value: str, chunk_us: int = DAY_US) -> DataFrame:
    """Rows with ``_before``, the ``value`` (never NULL) of the row before in the series, and ``_next``, the time of the one behind; times are unique in a series."""
    key = [*by, _CHUNK]
    placed = _placed(rows, at, chunk_us)
    edges = placed.groupBy(*key).agg(F.min(at).alias("_head"), F.max_by(value, at).alias("_tail"))
    chunks = Window.partitionBy(*by).orderBy(_CHUNK)
    edges = edges.select(*key, F.lag("_tail").over(chunks).alias("_from"), F.lead("_head").over(chunks).alias("_to"))
    inside = Window.partitionBy(*key).orderBy(at)
    local = placed.withColumns({"_before": F.lag(value).over(inside), "_next": F.lead(at).over(inside)})
    out = _with_edges(local, edges, key)
    return out.withColumns({"_before": F.coalesce("_before", "_from"), "_next": F.coalesce("_next", "_to")}).drop("_from", "_to", _CHUNK)


def carried(points: DataFrame, by: list[str], at: str, values: list[str], chunk_us: int = DAY_US) -> DataFrame:
    """One row per series and time of ``points``: each of the ``values`` as it was last said up to then, and ``_next``, the time behind.

    NULL says nothing; of several values of one time the largest counts. Points are shuffled once; beyond that only the edges of
    chunks are.
    """
    key, names = [*by, _CHUNK], range(len(values))
    said = _placed(points, at, chunk_us).repartition(*key).groupBy(*key, at).agg(*(F.max(v).alias(v) for v in values))
    edges = said.groupBy(*key).agg(F.min(at).alias("_head"), *(F.max_by(v, F.when(F.col(v).isNotNull(), F.col(at))).alias(f"_last{i}") for i, v in enumerate(values)))
    chunks = Window.partitionBy(*by).orderBy(_CHUNK)
    before = chunks.rowsBetween(Window.unboundedPreceding, -1)
    edges = edges.select(*key, F.lead("_head").over(chunks).alias("_to"), *(F.last(f"_last{i}", ignorenulls=True).over(before).alias(f"_from{i}") for i in names))
    inside = Window.partitionBy(*key).orderBy(at)
    here = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = said.withColumns({"_next": F.lead(at).over(inside), **{v: F.last(v, ignorenulls=True).over(here) for v in values}})
    out = _with_edges(local, edges, key)
    known = {v: F.coalesce(v, f"_from{i}") for i, v in enumerate(values)}
    return out.withColumns({"_next": F.coalesce("_next", "_to"), **known}).drop("_to", *(f"_from{i}" for i in names), _CHUNK)


def as_of(
    left: DataFrame, versions: DataFrame, on: dict[str, str], ts: str, start: str, end: str, cols: list[str],
    from_start: bool = False, chunk_us: int = DAY_US,
) -> DataFrame:
    """Every row of ``left`` with ``cols`` of the version that is valid at ``ts``: start included, end excluded, NULL where there is none.

    Rows and versions are one timeline, and a row meets the last version that started, not all versions of its key; so a key with
    many versions costs no more than its rows. ``on`` maps columns of ``left`` to columns of ``versions``. The versions of a key must
    not overlap. Of several with one start the one of the latest end counts, an open end being the latest; then the larger
    ``cols``. NULL keys and times have no version. ``from_start``: a key's first version is valid at any time before its end.
    """
    names = [f"_k{i}" for i in range(len(on))]
    facts = left.select(
        *(F.col(f"`{c}`").alias(n) for c, n in zip(on, names, strict=True)), F.col(f"`{ts}`").cast("timestamp").alias("_at"),
        F.lit(1).alias("_side"), F.struct(*(F.col(f"`{c}`") for c in left.columns)).alias("_row"),
    )
    valid = F.struct(F.col(end).cast("timestamp").alias("to"), F.struct(*cols).alias("v"))
    known = versions.select(
        *(F.col(c).alias(n) for c, n in zip(on.values(), names, strict=True)), F.col(start).cast("timestamp").alias("_at"),
        F.lit(0).alias("_side"), valid.alias("_version"),
    ).dropna(subset=[*names, "_at"])
    rows = facts.unionByName(known, allowMissingColumns=True)
    open_end = F.coalesce(F.col("_version.to").isNull(), F.lit(True))
    order = [F.col("_side"), open_end.alias("_open"), F.col("_version.to").alias("_until"), F.col("_version.v").alias("_what")]
    found = last_known(rows, names, "_at", "_version", order, chunk_us).filter("_side = 1")
    version = F.coalesce("_known", "_first") if from_start else F.col("_known")
    holds = version.isNotNull() & F.col("_at").isNotNull() & (version["to"].isNull() | (F.col("_at") < version["to"]))
    return found.select("_row.*", *(F.when(holds, version["v"][c]).alias(c) for c in cols))
