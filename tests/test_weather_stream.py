import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from wattloom.session import scratch
from wattloom.streaming.jobs import write_stream
from wattloom.streaming.weather import with_weather

READING, WEATHER = "site_id INT, timestamp TIMESTAMP, wh DOUBLE, temp DOUBLE", "site_id INT, timestamp TIMESTAMP, temp DOUBLE, sun INT"
T0 = dt.datetime(2024, 1, 1)


def at(minutes):
    return T0 + dt.timedelta(minutes=minutes)


def streamed(spark, batches, schema, name):
    """One file per batch, taken up one at a time, in order of modification."""
    folder = scratch(spark, name)
    for n, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)


def run(spark, readings, weather, **how):
    out = scratch(spark, "joined")
    joined = with_weather(streamed(spark, readings, READING, "readings"), streamed(spark, weather, WEATHER, "weather"), **how)
    write_stream(joined, out, scratch(spark, "state")).awaitTermination()
    return spark.read.schema(joined.schema).parquet(out)


def test_pairs_in_any_order_and_missing_sides(spark):
    readings = [[(1, at(5), 1.0, 0.5), (1, at(65), 2.0, 0.5), (2, at(10), 3.0, 0.5), (None, at(5), 9.0, 0.5), (1, None, 9.0, 0.5)], [(1, at(20), 4.0, 0.5), (1, at(600), 5.0, 0.5)], [(2, at(620), 6.0, 0.5)]]
    weather = [[(1, at(60), 10.0, 1)], [(1, at(0), 11.0, 2), (None, at(0), 9.0, 9), (3, at(0), 9.0, 9)], [(1, at(600), 12.0, 3), (2, at(615), 13.0, 4)]]
    out = run(spark, readings, weather, late="60 minutes", weather_late="90 minutes")
    assert out.columns == ["site_id", "timestamp", "wh", "temp", "weather_temp", "sun"]
    # Site 2 has no sample at 00:10; its row comes out as the watermarks have passed it.
    assert sorted((r.wh, r.weather_temp, r.sun) for r in out.collect()) == [(1.0, 11.0, 2), (2.0, 10.0, 1), (3.0, None, None), (4.0, 11.0, 2), (5.0, 12.0, 3), (6.0, 13.0, 4)]


def test_rows_wait_for_both_watermarks(spark):
    """Readings go on, weather stands still: a reading without weather must wait, and late weather still finds it."""
    readings = [[(1, at(5), 1.0, 0.0)], [(1, at(900), 2.0, 0.0)]]
    assert run(spark, readings, [[(2, at(0), 1.0, 1)]], late="1 minute", weather_late="1 minute").count() == 0
    rows = run(spark, readings, [[(2, at(0), 1.0, 1)], [(2, at(1), 1.0, 1)], [(1, at(4), 7.0, 1)]], late="1 minute", weather_late="1 minute").collect()
    assert [(r.wh, r.weather_temp) for r in rows] == [(1.0, 7.0)]


def test_late_rows_are_dropped(spark):
    readings = [[(1, at(900), 1.0, 0.0)], [(1, at(901), 2.0, 0.0)], [(1, at(5), 3.0, 0.0)]]
    weather = [[(1, at(900), 5.0, 1)], [(1, at(960), 6.0, 1)], [(1, at(0), 7.0, 1)]]
    rows = run(spark, readings, weather, late="10 minutes", weather_late="10 minutes").collect()
    assert sorted((r.wh, r.weather_temp) for r in rows) == [(1.0, 5.0), (2.0, 5.0)]


@pytest.mark.parametrize("seed", range(2))
def test_any_cut_gives_the_batch_join(spark, seed):
    rnd = random.Random(seed)
    readings = [(rnd.randint(1, 3), at(rnd.uniform(0, 900)), float(i), 0.0) for i in range(120)] + [(1, at(3000), -1.0, 0.0), (2, at(60), -2.0, 0.0)]
    weather = [(s, at(60 * h + 7 * (s == 3)), float(100 * s + h), h) for s in (1, 2, 3) for h in range(15) if rnd.random() < 0.7] + [(1, at(3000), 1.0, 1)]
    last_r, last_w = readings.pop(-2), weather.pop()
    deal = lambda rows, n: [[r for k, r in enumerate(rows) if k % n == i] for i in range(n)]
    rnd.shuffle(readings), rnd.shuffle(weather)
    got = run(spark, [*deal(readings, rnd.randint(1, 3)), [last_r]], [*deal(weather, rnd.randint(1, 3)), [last_w]], late="1 day", weather_late="1 day")
    plain = with_weather(spark.createDataFrame([*readings, last_r], READING), spark.createDataFrame([*weather, last_w], WEATHER))
    # 3,000 minutes less a day have passed, so all other readings have come out.
    show = lambda df: sorted(((r.wh, r.weather_temp) for r in df.collect()), key=repr)
    assert show(got) == show(plain) and got.filter(F.col("weather_temp").isNull()).count() > 0


def test_empty_streams(spark):
    assert run(spark, [[]], [[]]).count() == 0
