from datetime import datetime, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wattloom.functions import timebucket as tb

EPOCH = datetime(1970, 1, 1)
moments = st.datetimes(datetime(1900, 1, 1), datetime(2100, 1, 1))


def quarter(t: datetime) -> datetime:
    return EPOCH + (t - EPOCH) // timedelta(minutes=15) * timedelta(minutes=15)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(moments, min_size=1, max_size=50))
def test_buckets_equal_plain_arithmetic(spark, stamps):
    df = spark.createDataFrame([(t,) for t in stamps], "ts timestamp_ntz")
    got = df.select(
        "ts", tb.bucket_start(F.col("ts")).cast("timestamp_ntz"), tb.bucket_start_from_text(F.col("ts")).cast("timestamp_ntz"),
        tb.interval_15m(F.col("ts")),
    ).collect()
    for ts, bucket, from_text, index in got:
        assert bucket == from_text == quarter(ts)
        assert index == (ts.hour * 60 + ts.minute - 60) // 15


def test_interval_index_of_known_times(spark):
    df = spark.sql("SELECT explode(array(TIMESTAMP'2024-01-01 00:07:00', TIMESTAMP'2024-01-01 01:00:00', TIMESTAMP'2024-01-01 23:59:00')) AS ts")
    assert [r[0] for r in df.select(tb.interval_15m(F.col("ts"))).collect()] == [-4, 0, 91]
    assert [r[0] for r in df.select(tb.interval_15m(F.col("ts"), origin_minute=0)).collect()] == [0, 4, 95]


def test_bucket_equals_the_built_in_window(spark):
    df = spark.range(10_000).select(F.timestamp_micros(F.col("id") * 987_654_321 + 1_700_000_000_000_000).alias("ts"))
    differs = df.filter(tb.bucket_start(F.col("ts")) != F.window("ts", "15 minutes")["start"])
    assert differs.count() == 0


def test_weekend_is_sunday_unless_asked(spark):
    df = spark.sql("SELECT explode(sequence(DATE'2024-01-01', DATE'2024-01-07')) AS d")
    assert [r[0] for r in df.filter(tb.is_weekend(F.col("d"))).selectExpr("day(d)").collect()] == [7]
    assert [r[0] for r in df.filter(tb.is_weekend(F.col("d"), (5, 6))).selectExpr("day(d)").collect()] == [6, 7]


def test_on_day_uses_the_partition_column(spark, tmp_path):
    df = spark.sql("SELECT TIMESTAMP'2024-01-01 10:00:00' + make_dt_interval(id) AS ts FROM range(5)").withColumn("day", F.to_date("ts"))
    df.write.partitionBy("day").parquet(str(tmp_path / "t"))
    day = tb.on_day(spark.read.parquet(str(tmp_path / "t")), "2024-01-03")
    assert day.count() == 1
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "day" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "GreaterThanOrEqual(ts" in plan
