from datetime import datetime

import pytest
from pyspark.sql import functions as F

from wattloom.functions.keys import dense_keys, next_key
from wattloom.operators import scd2
from wattloom.operators.joins import attach_scalar, spread_join
from wattloom.operators.quality import current_violations

DIM = "key BIGINT, id INT, name STRING, cap DOUBLE, start_date TIMESTAMP, end_date TIMESTAMP, current_flag BOOLEAN"
SRC = "id INT, name STRING, cap DOUBLE"
T0, T1, T2 = datetime(2024, 1, 1), datetime(2024, 2, 1), datetime(2024, 3, 1)
COMPOSITE, DENSE = scd2.CompositeKey("key", "id"), scd2.DenseKey("key", ("id",))


def now(t):
    return F.lit(t.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp")


@pytest.fixture
def dim(spark):
    return spark.createDataFrame([
        (1, 1, "a", 1.0, T0, T1, False), (2, 1, "a", 2.0, T1, None, True), (3, 2, "b", None, T0, None, True),
        (4, 3, "c", 3.0, T0, None, True)], DIM)


def source(spark, *rows):
    return spark.createDataFrame(list(rows), SRC)


def apply(dim, src, key=DENSE, **kw):
    return scd2.scd2_apply(dim, src, ["id"], ["cap"], now(T2), key, **kw)


def versions(df):
    return sorted((r["id"], r["cap"], r["start_date"], r["end_date"], r["current_flag"]) for r in df.fillna(-1.0, ["cap"]).withColumn(
        "end_date", F.coalesce("end_date", F.lit("2999-01-01").cast("timestamp"))).collect())


OPEN = datetime(2999, 1, 1)


def test_change_new_key_vanished_key_and_null(spark, dim):
    got = apply(dim, source(spark, (1, "renamed", 5.0), (2, "b", 9.0), (4, "d", 4.0)))
    assert versions(got) == [
        (1, 1.0, T0, T1, False), (1, 2.0, T1, T2, False), (1, 5.0, T2, OPEN, True),
        (2, -1.0, T0, OPEN, True), (3, 3.0, T0, OPEN, True), (4, 4.0, T2, OPEN, True)]
    assert current_violations(got, ["id"]).count() == 0
    keys = [r["key"] for r in got.collect()]
    assert sorted(keys) == [1, 2, 3, 4, 5, 6]


def test_null_safe_sees_the_null(spark, dim):
    got = apply(dim, source(spark, (2, "b", 9.0)), null_safe=True)
    assert (2, 9.0, T2, OPEN, True) in versions(got) and (2, -1.0, T0, T2, False) in versions(got)


def test_no_change_and_empty_source(spark, dim):
    assert versions(apply(dim, source(spark, (1, "x", 2.0), (3, "y", 3.0)))) == versions(dim)
    assert versions(apply(dim, source(spark))) == versions(dim)


def test_empty_dimension(spark, dim):
    got = apply(dim.limit(0), source(spark, (7, "g", 7.0), (8, "h", None)), COMPOSITE)
    assert sorted(r["key"] for r in got.collect()) == [720240301, 820240301]


def test_rerun_changes_nothing(spark, dim):
    src = source(spark, (1, "a", 5.0), (9, "z", 1.0))
    once = apply(dim, src)
    again = scd2.scd2_apply(once, src, ["id"], ["cap"], now(datetime(2024, 4, 1)), DENSE)
    assert versions(again) == versions(once)


def test_close_then_open_equals_apply(spark, dim):
    src = source(spark, (1, "a", 5.0), (2, "b", 9.0), (4, "d", 4.0))
    closed = scd2.scd2_close(dim, src, ["id"], ["cap"], now(T2))
    both = scd2.scd2_open(closed, src, ["id"], now(T2), COMPOSITE)
    assert sorted(map(repr, both.collect())) == sorted(map(repr, apply(dim, src, COMPOSITE).collect()))


def test_repeated_business_key_fails(spark, dim):
    with pytest.raises(Exception, match="repeats or is NULL"):
        apply(dim, source(spark, (1, "a", 5.0), (1, "a", 6.0))).collect()


def test_missing_current_flag_counts_as_history(spark, dim):
    odd = dim.withColumn("current_flag", F.when(F.col("id") != 2, F.col("current_flag")))
    got = apply(odd, source(spark, (2, "b", 9.0)))
    assert got.filter("id = 2").count() == 2 and got.count() == 5


def test_dense_keys_have_no_gaps(spark):
    new = spark.range(5000).select((F.col("id") * 7919).alias("bk"))
    dim = spark.sql("SELECT 41L AS key")
    got = next_key(dim, new, ["bk"], "key")
    assert got.agg(F.min("key"), F.max("key"), F.countDistinct("key")).first() == (42, 5041, 5000)
    again = next_key(dim, new.repartition(3), ["bk"], "key")
    assert got.join(again, ["bk", "key"]).count() == 5000
    assert dense_keys(new.limit(0), ["bk"], "key").count() == 0


def test_as_of_bounds_and_gaps(spark, dim):
    facts = spark.createDataFrame(
        [(1, datetime(2023, 12, 31)), (1, T0), (1, datetime(2024, 1, 31, 23)), (1, T1), (9, T1)], "dev INT, ts TIMESTAMP")
    got = scd2.scd2_as_of_join(facts, dim, {"dev": "id"}, "ts", ["key"])
    assert [r["key"] for r in got.orderBy("dev", "ts").collect()] == [None, 1, 1, 2, None]


@pytest.mark.parametrize("salts", [1, 4])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_spread_join_equals_the_plain_join(spark, rows, salts, how):
    left = spark.range(900).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 40).alias("k"), F.col("id").alias("v"))
    right = spark.range(30).select(F.col("id").alias("k2"), (F.col("id") * 2).alias("w"))
    plain = left.join(right, F.col("k") == F.col("k2"), how).drop("k2")
    assert rows(spread_join(left, right, {"k": "k2"}, how, spread_by=["v"], salts=salts)) == rows(plain)


def test_spread_join_refuses_joins_it_would_multiply(spark):
    with pytest.raises(ValueError):
        spread_join(spark.range(1), spark.range(1), {"id": "id"}, "full", spread_by=["id"])


def test_scalar_needs_one_row(spark):
    two = spark.range(2).select("id")
    assert attach_scalar(spark.range(1), two.limit(0), "k").first()["k"] is None
    with pytest.raises(Exception, match="SCALAR_SUBQUERY_TOO_MANY_ROWS|more than one row"):
        attach_scalar(spark.range(1), two, "k").collect()
