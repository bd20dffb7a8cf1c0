"""Upsampling as a stream against the batch operator."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from wattloom.operators.resample import upsample_linear
from wattloom.streaming import jobs, upsample

T0 = datetime(2024, 1, 1)
SCHEMA = "site INT, timestamp TIMESTAMP, light DOUBLE, temp DOUBLE"
RND = random.Random(5)
ROWS = [(s, T0 + timedelta(seconds=(s or 3) * 7 + 10 * RND.randint(0, 400)), float(RND.randint(0, 50)), None if RND.random() < 0.1 else float(RND.randint(0, 9))) for s in (1, 2, None) for _ in range(40)]


@pytest.mark.parametrize("parts", [1, 4])
def test_any_cut_gives_the_batch_rows(spark, tmp_path, parts):
    closing = [(s, T0 + timedelta(days=n), 0.0, 0.0) for s in (1, 2, None) for n in (1, 2, 3)]
    for batch in [ROWS[n::parts] for n in range(parts)] + [closing[n::3] for n in range(3)]:
        spark.createDataFrame(batch, SCHEMA).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema(SCHEMA).parquet(f"{tmp_path}/in")
        dense = upsample.upsample(stream, "timestamp", ["light", "temp"], 60_000_000, ["site"], late="70 minutes")
        jobs.write_stream(dense, f"{tmp_path}/out", f"{tmp_path}/state").awaitTermination()
    got = spark.read.parquet(f"{tmp_path}/out")
    rows = spark.createDataFrame([r for r in ROWS if r[3] is not None] + closing, SCHEMA)
    want = upsample_linear(rows, "timestamp", ["light", "temp"], 60_000_000, ["site"])
    # The newest slots wait for a successor that the watermark has passed.
    last = got.agg(F.max("timestamp")).first()[0]
    assert last > T0 + timedelta(hours=23)
    rounded = lambda df: sorted((r.site or 0, r.timestamp, round(r.light, 6), round(r.temp, 6)) for r in df.filter(F.col("timestamp") < F.lit(T0 + timedelta(hours=23))).collect())
    assert rounded(got) == rounded(want)
