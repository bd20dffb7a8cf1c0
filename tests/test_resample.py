from datetime import datetime

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from wattloom.operators.resample import align_to_grid, expand_minutes, upsample_linear
from wattloom.plans.prepare import home_series, weather_series

START = datetime(2024, 1, 1, 1, 1)


def by_pandas(pdf, cols, step, by):
    """The same by pandas: mean per slot, then linear interpolation, series by series."""
    parts = []
    for key, group in pdf.groupby(by, dropna=False):
        dense = group.set_index("ts")[cols].resample(step).mean().interpolate().reset_index()
        parts.append(dense.assign(**{by: key}))
    return pd.concat(parts)


def compare(spark_df, expected, cols, by):
    got = spark_df.toPandas().sort_values([by, "ts"]).reset_index(drop=True)
    want = expected.sort_values([by, "ts"]).reset_index(drop=True)
    assert len(got) == len(want)
    assert (got["ts"].astype("datetime64[us]") == want["ts"].astype("datetime64[us]")).all()
    for c in cols:
        np.testing.assert_allclose(got[c].astype(float), want[c].astype(float), rtol=0, atol=1e-9, equal_nan=True)


def samples(n, seed, gaps=0.0):
    rng = np.random.default_rng(seed)
    # A third of all samples belongs to series 0.
    series = np.where(rng.random(n) < 1 / 3, 0, rng.integers(1, 6, n))
    ts = pd.Timestamp(START) + pd.to_timedelta(rng.integers(0, 6 * 3600 * 10, n) * 100, unit="ms")
    pdf = pd.DataFrame({"s": series, "ts": ts.astype("datetime64[us]"), "a": rng.random(n) * 100, "b": rng.random(n)})
    for c in ("a", "b"):
        pdf.loc[rng.random(n) < gaps, c] = np.nan
    return pdf


def as_spark(spark, pdf):
    df = spark.createDataFrame(pdf)
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in ("a", "b")}).withColumn("ts", F.col("ts").cast("timestamp"))


@pytest.mark.parametrize("gaps", [0.0, 0.4])
@pytest.mark.parametrize("step_us, step, chunk_us", [
    (1_000_000, "1s", 3_600_000_000), (60_000_000, "60s", 600_000_000), (7_000_000, "7s", 60_000_000)])
def test_upsampling_equals_pandas(spark, gaps, step_us, step, chunk_us):
    pdf = samples(400, 3, gaps)
    df = upsample_linear(as_spark(spark, pdf), "ts", ["a", "b"], step_us, ["s"], chunk_us=chunk_us, spread=4)
    # pandas anchors the grid at midnight, the build at the epoch: the same when the step divides a day.
    if 86_400_000_000 % step_us:
        assert df.count() > 0
        return
    compare(df, by_pandas(pdf, ["a", "b"], step, "s"), ["a", "b"], "s")


def test_chunk_length_does_not_matter(spark):
    df = as_spark(spark, samples(200, 5, 0.3))
    one = upsample_linear(df, "ts", ["a"], 60_000_000, ["s"], chunk_us=10**14)
    many = upsample_linear(df, "ts", ["a"], 60_000_000, ["s"], chunk_us=120_000_000)
    assert one.exceptAll(many).count() == 0 and many.exceptAll(one).count() == 0


def test_single_series_single_sample_and_long_segments(spark):
    one = spark.createDataFrame([(START, 5.0)], "ts TIMESTAMP, a DOUBLE")
    assert upsample_linear(one, "ts", ["a"], 1000).collect()[0]["a"] == 5.0
    two = spark.createDataFrame([(START, 0.0), (datetime(2024, 1, 1, 1, 2), 60.0)], "ts TIMESTAMP, a DOUBLE")
    dense = upsample_linear(two, "ts", ["a"], 5000)
    assert dense.count() == 12_001
    assert dense.filter(F.abs(F.col("a") - (F.unix_micros("ts") - F.lit(1704070860000000)) / 1e6) > 1e-9).count() == 0


def test_null_series_id_is_a_series(spark):
    df = spark.createDataFrame([(None, START, 0.0), (None, datetime(2024, 1, 1, 3, 1), 2.0), (1, START, 7.0)], "s INT, ts TIMESTAMP, a DOUBLE")
    got = upsample_linear(df, "ts", ["a"], 3_600_000_000, ["s"], chunk_us=3_600_000_000)
    assert sorted((str(r["s"]), r["a"]) for r in got.collect()) == [("1", 7.0), ("None", 0.0), ("None", 1.0), ("None", 2.0)]


def test_off_grid_samples_are_averaged(spark):
    df = spark.createDataFrame([(START, 1.0), (datetime(2024, 1, 1, 1, 1, 30), 3.0)], "ts TIMESTAMP, a DOUBLE")
    assert [r["a"] for r in align_to_grid(df, "ts", ["a"], 60_000_000, []).collect()] == [2.0]


def climate(spark):
    hours = spark.range(1, 25).select(F.col("id").cast("int").alias("hour"), (F.col("id") * 10.0).alias("solar_intensity"), (F.col("id") / 2).alias("temp"))
    return hours.withColumns({"station": F.lit("s"), "date": F.lit("2013-01-01").cast("date")})


def test_minutes_of_a_day(spark):
    got = expand_minutes(climate(spark), ["solar_intensity"], ["station", "date"])
    assert got.count() == 23 * 59
    assert got.filter("hour = 1 AND minute = 30").first()["solar_intensity"] == 15.0
    assert got.filter("hour = 24").count() == 0


def test_weather_day_at_one_second(spark):
    got = weather_series(climate(spark), step_us=1_000_000)
    assert got.count() == 22 * 3600 + 58 * 60 + 1
    first, last = got.agg(F.min("timestamp"), F.max("timestamp")).first()
    assert (first, last) == (datetime(2013, 1, 1, 1, 1), datetime(2013, 1, 1, 23, 59))


def test_home_series_covers_each_day(spark):
    appliances = spark.createDataFrame([("a", 360.0, 720.0, "00:00-24:00")], "appliance STRING, min_consumption_power_wh DOUBLE, max_consumption_power_wh DOUBLE, usage_time STRING")
    got = home_series(appliances, "2024-01-01", "2024-01-02", step_us=60_000_000)
    assert got.count() == 2 * (22 * 60 + 59 + 1)
    assert got.select("min_consumption_wh", "avg_consumption_wh").distinct().collect() == [(6.0, 9.0)]
