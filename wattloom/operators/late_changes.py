"""Type-2 dimensions from changes that come in any order.

Each change says when it took effect. All changes are kept; a load derives the validity of the keys that it touches anew from
their changes and leaves every other key as it is. So the dimension is a function of the changes alone, not of their order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.operators import timeline
from wattloom.operators.scd2 import END, FLAG, OPENED, START, CompositeKey, DenseKey


def changes_of(dim: DataFrame, key: str, at: str = "effective") -> DataFrame:
    """A dimension's versions as changes, to begin the record of changes of one that had none."""
    return dim.select(F.col(START).alias(at), *(c for c in dim.columns if c not in (key, START, END, FLAG)))


def versions_of(changes: DataFrame, business_key: list[str], tracked: list[str], at: str = "effective", chunk_us: int = timeline.DAY_US) -> DataFrame:
    """Versions (all columns of ``changes`` but ``at``, with start, end and current flag) in the order of ``at``.

    A change opens a version if a tracked column differs from the change before, NULL being a value like any other. Of several changes of a
    key at one time the largest counts, tracked columns first. Changes without key or time are left out.
    """
    rest = [c for c in changes.columns if c not in (*business_key, *tracked, at)]
    said = changes.dropna(subset=[*business_key, at]).groupBy(*business_key, at).agg(F.max(F.struct(*tracked, *rest)).alias("_said"))
    now = F.struct(*(F.col(f"_said.{c}").alias(c) for c in tracked))
    met = timeline.neighbours(said.withColumn("_now", now), business_key, at, "_now", chunk_us)
    opens = met.filter(~F.col("_before").eqNullSafe(F.col("_now"))).drop("_before", "_next")
    ended = timeline.neighbours(opens, business_key, at, "_now", chunk_us)
    return ended.select(*business_key, "_said.*", F.col(at).alias(START), F.col("_next").alias(END), F.col("_next").isNull().alias(FLAG))


def scd2_late(
    dim: DataFrame, record: DataFrame, changes: DataFrame, business_key: list[str], tracked: list[str],
    key: CompositeKey | DenseKey, at: str = "effective",
) -> DataFrame:
    """The whole dimension after ``changes`` of any time, given the ``record`` of all changes before them.

    A change between two others splits the interval of closed history that it falls in; one that says what the change behind it says moves
    that version's start to its own. Only touched keys are derived anew. A version that keeps business key and start keeps its surrogate
    key; new ones get theirs by ``key``: composite keys are then the same whatever the order of loads, dense ones number new versions in the
    order of loads (name the start among their business key columns, as a load may open several versions of a key).
    """
    touched = changes.select(*business_key).distinct()
    said = changes.unionByName(record.join(touched, business_key, "left_semi").select(*changes.columns))
    made = versions_of(said, business_key, tracked, at)
    same = dim.join(touched, business_key, "left_semi").select(*business_key, START, key.key)
    rows = made.join(same, [*business_key, START], "left").withColumn(OPENED, F.col(key.key).isNull())
    typed = rows.select(*(
        (F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in dim.schema.fields
    ), OPENED)
    return dim.join(touched, business_key, "left_anti").select(*dim.columns).unionByName(key.fill(dim, typed).drop(OPENED))


def moved_spans(before: DataFrame, after: DataFrame, business_key: list[str], key: str) -> DataFrame:
    """``business_key``, ``from``, ``to`` (NULL: open), ``old_key``, ``new_key``: where facts need another surrogate key now.

    The starts and ends of both versions of the dimension cut each key's time; a stretch counts where the keys valid in it differ.
    """
    sides = [d.select(*business_key, START, END, key) for d in (before, after)]
    net = sides[0].withColumn("_n", F.lit(1)).union(sides[1].withColumn("_n", F.lit(-1)))
    differ = net.groupBy(*business_key, START, END, key).agg(F.sum("_n").alias("_n")).filter("_n <> 0")
    changed = differ.select(*business_key).distinct()
    # As in an as-of join, of versions with one start the one of the latest end counts, then the larger key.
    version = F.struct(F.col(END).isNull().alias("open"), F.col(END).cast("timestamp").alias("until"), F.col(key).alias("key"))
    names = ["old_key", "new_key"]
    ends = [
        d.join(changed, business_key, "left_semi").select(*business_key, version.alias("_version"), F.posexplode(F.array(START, END)).alias("_end", "from"))
        .dropna(subset="from").select(*business_key, "from", F.when(F.col("_end") == 0, F.col("_version")).alias(name))
        for d, name in zip(sides, names, strict=True)
    ]
    cuts = timeline.carried(ends[0].unionByName(ends[1], allowMissingColumns=True), business_key, "from", names)
    valid = lambda v: F.when(v["until"].isNull() | (F.col("from").cast("timestamp") < v["until"]), v["key"])
    found = cuts.withColumns({name: valid(F.col(name)) for name in names})
    moved = found.filter(~F.col("old_key").eqNullSafe(F.col("new_key")))
    return moved.select(*business_key, "from", F.col("_next").alias("to"), "old_key", "new_key")
