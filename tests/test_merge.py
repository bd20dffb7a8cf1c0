import pytest
from pyspark.sql import functions as F

from wattloom.operators import merge, quality
from wattloom.operators.scd2 import CompositeKey

SCHEMA = "id INT, name STRING, cap DOUBLE"


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def test_upsert_updates_listed_columns_and_inserts_whole_rows(spark, rows):
    target = frame(spark, (1, "a", 1.0), (2, "b", 2.0))
    source = frame(spark, (2, "other", 5.0), (3, "c", 3.0))
    got = merge.upsert(target, source, ["id"], ["cap"])
    assert rows(got) == [(1, "a", 1.0), (2, "b", 5.0), (3, "c", 3.0)]


def test_upsert_into_empty_and_from_empty(spark, rows):
    full, empty = frame(spark, (1, "a", 1.0)), frame(spark)
    assert rows(merge.upsert(empty, full, ["id"], ["cap"])) == [(1, "a", 1.0)]
    assert rows(merge.upsert(full, empty, ["id"], ["cap"])) == [(1, "a", 1.0)]


def test_conditional_upsert_does_not_see_nulls_unless_null_safe(spark, rows):
    target = frame(spark, (1, "a", 1.0), (2, "b", None), (3, "c", 3.0))
    source = frame(spark, (1, "a2", None), (2, "b2", 2.0), (3, "c2", 4.0))
    plain = merge.upsert(target, source, ["id"], ["name", "cap"], when_changed=["cap"])
    assert rows(plain) == [(1, "a", 1.0), (2, "b", None), (3, "c2", 4.0)]
    safe = merge.upsert(target, source, ["id"], ["name", "cap"], when_changed=["cap"], null_safe=True)
    assert rows(safe) == [(1, "a2", None), (2, "b2", 2.0), (3, "c2", 4.0)]


@pytest.mark.parametrize("bad", [[(1, "a", 1.0), (1, "b", 2.0)], [(None, "a", 1.0)]])
def test_upsert_fails_on_a_repeated_or_missing_key(spark, bad):
    with pytest.raises(Exception, match="merge key id repeats or is NULL"):
        merge.upsert(frame(spark, (1, "a", 0.0)), frame(spark, *bad), ["id"], ["cap"]).collect()


def test_insert_new_keeps_repeats_of_an_unmatched_key(spark, rows):
    target = frame(spark, (1, "a", 1.0))
    source = frame(spark, (1, "x", 9.0), (2, "b", 2.0), (2, "b", 2.0), (None, "n", 0.0))
    assert rows(merge.insert_new(target, source, ["id"])) == [(2, "b", 2.0), (2, "b", 2.0), (None, "n", 0.0)]


def test_insert_new_on_two_columns(spark, rows):
    target = frame(spark, (1, "a", 1.0))
    source = frame(spark, (1, "a", 9.0), (1, "b", 2.0))
    assert rows(merge.insert_new(target, source, ["id", "name"])) == [(1, "b", 2.0)]


def test_replace_matching(spark, rows):
    target = frame(spark, (1, "a", 1.0), (2, "b", 2.0))
    assert rows(merge.replace_matching(target, frame(spark, (2, "b", 7.0), (3, "c", 3.0)), ["id"])) == [
        (1, "a", 1.0), (2, "b", 7.0), (3, "c", 3.0)]


def test_update_where_casts_to_the_column_type(spark, rows):
    got = merge.update_where(frame(spark, (1, "a", 1.0), (3, "c", 3.0)), F.col("id") == 3, {"cap": F.lit(12)})
    assert rows(got) == [(1, "a", 1.0), (3, "c", 12.0)]
    assert got.schema["cap"].dataType.typeName() == "double"


def test_changelog_kinds(spark, rows):
    before = frame(spark, (1, "a", 1.0), (2, "b", None), (3, "c", 3.0), (4, "d", None))
    after = frame(spark, (1, "a", 1.0), (2, "b", 2.0), (4, "d", None), (5, "e", 5.0))
    got = merge.changelog(before, after, ["id"], ordinal=7)
    assert rows(got, "_change_type", "id", "cap", "_change_ordinal") == [
        ("DELETE", 3, 3.0, 7), ("INSERT", 5, 5.0, 7), ("UPDATE_AFTER", 2, 2.0, 7), ("UPDATE_BEFORE", 2, None, 7)]


def test_quality_splits_are_whole(spark):
    df = frame(spark, (1, None, 1.0), (2, "b", None), (3, "c", 3.0))
    good, bad = quality.split_not_null(df, ["name", "cap"])
    assert [r["id"] for r in good.collect()] == [3]
    assert {(r["id"], r["missing"]) for r in bad.collect()} == {(1, "name"), (2, "cap")}


def test_require_unique_keeps_rows(spark, rows):
    df = frame(spark, (1, "a", None), (2, None, 2.0))
    assert rows(quality.require_unique(df, ["id"])) == rows(df)


def test_composite_key_does_not_overflow(spark):
    from wattloom.functions.keys import composite_key

    got = spark.sql("SELECT 22 AS id, TIMESTAMP'2025-02-14 10:11:12' AS at").select(
        composite_key(F.col("id"), F.col("at")), composite_key(F.col("id"), F.col("at"), "second")).first()
    assert tuple(got) == (2220250214, 2220250214101112)
    assert CompositeKey("k", "id").resolution == "day"
