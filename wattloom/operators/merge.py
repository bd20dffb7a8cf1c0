"""MERGE, UPDATE and change log as joins, for tables without row-level operations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattloom.functions.predicates import changed
from wattloom.operators.quality import require_unique


def _same_keys(keys: list[str], left: str = "t", right: str = "s") -> list[Column]:
    return [F.col(f"{left}.{k}") == F.col(f"{right}.{k}") for k in keys]


def insert_new(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Source rows whose key the target lacks: what an insert-only merge would append.

    Only the key columns of the target are read. Give a target that is already narrowed to the
    partitions the source can touch.
    """
    return source.join(target.select(*keys), keys, "left_anti").select(*source.columns)


def replace_matching(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Target with the source rows put in place of those of the same key (last write wins)."""
    kept = target.join(source.select(*keys), keys, "left_anti")
    return kept.select(*target.columns).unionByName(source.select(*target.columns))


def upsert(
    target: DataFrame, source: DataFrame, keys: list[str], set_cols: list[str],
    when_changed: list[str] | None = None, null_safe: bool = False, check_keys: bool = True,
) -> DataFrame:
    """Type-1 merge: the whole target after it.

    Matched rows take ``set_cols`` from the source, always or only where a ``when_changed`` column
    differs; other columns keep the target's value. Unmatched source rows are inserted whole.
    """
    src = require_unique(source, keys) if check_keys else source
    t = target.withColumn("_t", F.lit(True)).alias("t")
    s = src.withColumn("_s", F.lit(True)).alias("s")
    joined = t.join(s, _same_keys(keys), "full_outer")

    inserted = F.col("_t").isNull()
    updated = F.col("_t").isNotNull() & F.col("_s").isNotNull()
    if when_changed is not None:
        updated = updated & changed("t", "s", when_changed, null_safe)

    def merged(name: str) -> Column:
        old = F.col(f"t.{name}")
        if name not in source.columns:
            return old.alias(name)
        take = inserted | updated if name in set_cols else inserted
        new = F.col(f"s.{name}").cast(target.schema[name].dataType)
        return F.when(take, new).otherwise(old).alias(name)

    return joined.select(*(merged(c) for c in target.columns))


def update_where(df: DataFrame, condition: Column, assignments: dict[str, Column]) -> DataFrame:
    """UPDATE … SET … WHERE as a projection."""
    return df.withColumns({
        name: F.when(condition, value.cast(df.schema[name].dataType)).otherwise(F.col(name))
        for name, value in assignments.items()
    })


def changelog(before: DataFrame, after: DataFrame, id_cols: list[str], ordinal: int = 0) -> DataFrame:
    """Row changes between two versions of a table, keyed by ``id_cols``.

    Rows that both versions hold, as often in the one as in the other, are no change. Of what is left, an id with one
    row before and one after gives an UPDATE_BEFORE and an UPDATE_AFTER row; otherwise rows are a DELETE or an INSERT each. An
    id may repeat: versions of one business key are not mixed up, and no row meets all others of its id.
    """
    cols = after.columns
    sided = before.select(*cols, F.lit(-1).alias("_n")).unionByName(after.select(*cols, F.lit(1).alias("_n")))
    left = sided.groupBy(*cols).agg(F.sum("_n").alias("_n")).filter("_n <> 0")
    names = {c: f"_id_{i}" for i, c in enumerate(id_cols)}
    gone, come = F.sum(F.greatest(F.lit(0), -F.col("_n"))), F.sum(F.greatest(F.lit(0), F.col("_n")))
    ids = left.groupBy(*(F.col(c).alias(n) for c, n in names.items())).agg(((gone == 1) & (come == 1)).alias("_pair"))
    joined = left.join(ids, [F.col(c).eqNullSafe(F.col(n)) for c, n in names.items()])
    old, new = F.when(F.col("_pair"), "UPDATE_BEFORE").otherwise("DELETE"), F.when(F.col("_pair"), "UPDATE_AFTER").otherwise("INSERT")
    copies = F.explode(F.sequence(F.lit(1), F.abs("_n"))).alias("_copy")
    rows = joined.select(*cols, F.when(F.col("_n") < 0, old).otherwise(new).alias("_change_type"), copies)
    return rows.drop("_copy").withColumn("_change_ordinal", F.lit(ordinal))


def changelog_of_versions(versions: list[DataFrame], id_cols: list[str]) -> DataFrame:
    """Change logs of consecutive versions, numbered by ``_change_ordinal`` from 0."""
    steps = [changelog(b, a, id_cols, i) for i, (b, a) in enumerate(zip(versions, versions[1:]))]
    out = steps[0]
    for step in steps[1:]:
        out = out.unionByName(step)
    return out
