"""Upsampling of sparse series by linear interpolation."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattloom.functions.timebucket import micros

HOUR_US = 3_600_000_000
BLOCK_STEPS = 1000
TASK_STEPS = 1_000_000


def align_to_grid(df: DataFrame, ts: str, cols: list[str], step_us: int, part_by: list[str]) -> DataFrame:
    """Mean of each column per grid slot (``slot``: microseconds, a multiple of the step)."""
    us = micros(F.col(ts))
    slot = (us - F.pmod(us, F.lit(step_us))).alias("slot")
    return df.groupBy(*part_by, slot).agg(*(F.avg(F.col(c).cast("double")).alias(c) for c in cols))


def _segments(sparse: DataFrame, cols: list[str], part_by: list[str], chunk_us: int) -> DataFrame:
    """Each sparse slot with the next slot and, per column, the known points around it.

    Series are cut into time chunks, so one window group holds at most ``chunk_us / step_us`` slots of
    one series however long it is. What crosses a chunk border (first and last known point of each
    chunk) is looked up in a table of one row per series and chunk.
    """
    point = {c: F.when(F.col(c).isNotNull(), F.struct("slot", F.col(c).alias("v"))) for c in cols}
    placed = sparse.withColumn("_chunk", F.col("slot") - F.pmod(F.col("slot"), F.lit(chunk_us)))
    placed = placed.withColumns({f"_p_{c}": p for c, p in point.items()})
    key = [*part_by, "_chunk"]

    edges = placed.groupBy(*key).agg(
        F.min("slot").alias("_head"),
        *(F.min(f"_p_{c}").alias(f"_first_{c}") for c in cols),
        *(F.max(f"_p_{c}").alias(f"_last_{c}") for c in cols),
    )
    over_chunks = Window.partitionBy(*part_by).orderBy("_chunk") if part_by else Window.orderBy("_chunk")
    before = over_chunks.rowsBetween(Window.unboundedPreceding, -1)
    names = ", ".join(part_by)
    partition = f"PARTITION BY {names} " if part_by else ""
    edges = edges.select(
        *key, F.lead("_head").over(over_chunks).alias("_next_head"),
        *(F.expr(f"lead(_first_{c}) IGNORE NULLS OVER ({partition}ORDER BY _chunk)").alias(f"_after_{c}") for c in cols),
        *(F.last(f"_last_{c}", ignorenulls=True).over(before).alias(f"_before_{c}") for c in cols),
    )

    inside = Window.partitionBy(*key).orderBy("slot")
    group = ", ".join(key)
    local = placed.select(
        *key, "slot", F.lead("slot").over(inside).alias("_next"),
        *(F.last(f"_p_{c}", ignorenulls=True).over(inside).alias(f"_prev_{c}") for c in cols),
        *(F.expr(f"lead(_p_{c}) IGNORE NULLS OVER (PARTITION BY {group} ORDER BY slot)").alias(f"_next_{c}") for c in cols),
    )
    # Null-safe: a NULL series id is a series like any other.
    l, e = local.alias("l"), edges.alias("e")
    same = [F.col(f"l.{k}").eqNullSafe(F.col(f"e.{k}")) for k in key]
    return l.join(e, same, "left").select(
        *(F.col(f"l.{k}").alias(k) for k in part_by), "slot", F.coalesce("_next", "_next_head").alias("next_slot"),
        *(F.coalesce(f"_prev_{c}", f"_before_{c}").alias(f"a_{c}") for c in cols),
        *(F.coalesce(f"_next_{c}", f"_after_{c}").alias(f"b_{c}") for c in cols),
    )


def upsample_linear(
    df: DataFrame, ts: str, cols: list[str], step_us: int, part_by: list[str] | None = None,
    chunk_us: int = HOUR_US, spread: int | None = None,
) -> DataFrame:
    """Every series on a fixed grid from its first to its last slot, values interpolated linearly.

    Samples that share a slot are averaged. A column that is NULL in a slot is interpolated across
    it, stays NULL before its first value and keeps its last value after it.

    Windows run on the sparse input only; the dense rows come from two nested explodes, first into
    blocks of steps, then into steps, and stay in their task from there on. Adaptive execution sizes
    tasks by the sparse input, so the blocks are dealt out anew, to ``spread`` tasks or else to one for every
    ``TASK_STEPS`` steps, which one sum over the sparse side counts.
    """
    part_by = part_by or []
    sparse = align_to_grid(df, ts, cols, step_us, part_by)
    segments = _segments(sparse, cols, part_by, chunk_us)

    block_us = step_us * BLOCK_STEPS
    stop = F.coalesce(F.col("next_slot") - F.lit(step_us), F.col("slot"))
    blocks = segments.withColumn("_stop", stop).withColumn(
        "_block", F.explode(F.sequence(F.col("slot"), F.col("_stop"), F.lit(block_us)))
    )
    steps = F.sum((stop - F.col("slot")) / F.lit(step_us) + 1)
    tasks = spread or int(segments.agg(steps).first()[0] or 0) // TASK_STEPS + 1
    blocks = blocks.repartition(tasks, *part_by, "_block")
    last_step = F.least(F.col("_block") + F.lit(block_us - step_us), F.col("_stop"))
    dense = blocks.withColumn("_g", F.explode(F.sequence(F.col("_block"), last_step, F.lit(step_us))))

    def value(c: str):
        a, b = F.col(f"a_{c}"), F.col(f"b_{c}")
        share = (F.col("_g") - a["slot"]) / (b["slot"] - a["slot"])
        return F.when(b.isNull(), a["v"]).otherwise(a["v"] + (b["v"] - a["v"]) * share).alias(c)

    return dense.select(*part_by, F.timestamp_micros("_g").alias(ts), *(value(c) for c in cols))


def expand_minutes(hourly: DataFrame, cols: list[str], part_by: list[str], hour: str = "hour") -> DataFrame:
    """Minutes 1-59 of each hour, on the line from the hour's value to the next hour's.

    ``part_by`` must name one day of one series (at most 24 hours). The last hour of a day has no
    successor and gives no minutes.
    """
    w = Window.partitionBy(*part_by).orderBy(hour)
    pairs = hourly.withColumns({f"_next_{c}": F.lead(c).over(w) for c in cols}).withColumn(
        "_next_hour", F.lead(hour).over(w)
    ).filter(F.col("_next_hour").isNotNull())
    minutes = pairs.withColumn("minute", F.explode(F.sequence(F.lit(1), F.lit(59))))
    return minutes.select(*part_by, hour, "minute", *(
        (F.col(c) + (F.col(f"_next_{c}") - F.col(c)) * (F.col("minute") / F.lit(60))).alias(c) for c in cols
    ))
