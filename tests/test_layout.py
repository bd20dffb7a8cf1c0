import pytest
from pyspark.sql import functions as F

from wattloom.sinks import layout


@pytest.fixture(scope="module")
def readings(spark):
    """40,000 readings of 100 devices over 30 days; device 7 has a third of them."""
    device = F.when(F.col("id") % 3 == 0, 7).otherwise(F.pmod(F.xxhash64("id"), F.lit(100))).cast("int")
    second = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(30 * 86_400))
    ts = F.timestamp_seconds(F.lit(1_704_067_200) + second)
    return spark.range(40_000).select("id", device.alias("device"), ts.alias("ts"), F.lit("x").alias("text"))


@pytest.fixture(scope="module")
def curved(spark, readings, tmp_path_factory):
    path = f"{tmp_path_factory.mktemp('a b')}/t"
    layout.write_curved(readings, path, ["device", "ts"], 200)
    return path


def hour(device, day=10):
    return {"device": (device, device), "ts": (f"2024-01-{day} 05:00:00", f"2024-01-{day} 05:59:59")}


@pytest.mark.parametrize("device,most", [(7, 0.05), (8, 0.05), (99, 0.05), (500, 0)])
def test_a_device_and_an_hour_open_few_files(spark, readings, curved, device, most):
    some, every = layout.files_in(spark, curved, hour(device))
    assert len(every) >= 150 and len(some) <= most * len(every)
    want = readings.filter((F.col("device") == device) & F.col("ts").between("2024-01-10 05:00:00", "2024-01-10 05:59:59"))
    assert sorted(layout.read_curved(spark, curved, hour(device)).collect()) == sorted(want.collect())


def test_either_column_alone_opens_a_part(spark, curved):
    """Both columns prune: neither is merely the second key of a sort."""
    for bounds in ({"device": (20, 20)}, {"ts": ("2024-01-10 05:00:00", "2024-01-10 05:59:59")}, {"ts": (None, "2024-01-02")}):
        some, every = layout.files_in(spark, curved, bounds)
        assert len(some) <= 0.3 * len(every)


def test_a_hot_device_fills_no_file_beyond_its_share(spark, curved):
    counts = [r["_rows"] for r in spark.read.parquet(f"{curved}/_ranges").collect()]
    assert sum(counts) == 40_000 and max(counts) <= 4 * 200


def test_files_without_ranges_are_read(spark, curved, readings, tmp_path):
    path = str(tmp_path / "t")
    layout.write_curved(readings.limit(1000), path, ["device", "ts"], 100)
    spark.createDataFrame([(-1, 7, None, "late")], readings.schema).withColumn("ts", F.timestamp_seconds(F.lit(1_704_862_800))).write.mode("append").parquet(path)
    got = layout.read_curved(spark, path, {"device": (7, 7), "ts": ("2024-01-10 05:00:00", "2024-01-10 05:00:00")})
    assert [r.id for r in got.filter("id = -1").collect()] == [-1]


def test_nulls_ties_nan_and_clashing_names(spark, tmp_path):
    rows = spark.sql("""SELECT * FROM VALUES (1, CAST('NaN' AS DOUBLE), 'a'), (NULL, NULL, 'b'), (1, 2.0D, 'c'), (1, 2.0D, 'c'), (5, NULL, NULL)
      AS t(`_rows`, `x.y`, c0)""")
    path = str(tmp_path / "t")
    layout.write_curved(rows, path, ["_rows", "x.y"], 2)
    back = spark.read.parquet(path)
    assert sorted(map(repr, back.collect())) == sorted(map(repr, rows.collect()))
    assert [r.c0 for r in layout.read_curved(spark, path, {"_rows": (1, 1), "x.y": (2.0, 2.0)}).collect()] == ["c", "c"]
    assert layout.read_curved(spark, path, {"_rows": (1, 1)}).count() == 3


def test_empty_tables_and_other_types(spark, readings, tmp_path):
    path = str(tmp_path / "t")
    layout.write_curved(readings.limit(0), path, ["device", "ts"])
    assert layout.read_curved(spark, path, hour(7)).collect() == []
    for by in (["device"], ["device", "text"]):
        with pytest.raises(ValueError):
            layout.write_curved(readings, path, by)


def test_places_follow_the_distribution(spark):
    """Half of the rows in a thousandth of the range: their places still spread over half of the curve."""
    x = F.when(F.col("id") < 1000, F.col("id") / 1000.0).otherwise(F.col("id").cast("double"))
    rows, n = layout.with_curve(spark.range(2000).select(x.alias("x"), F.lit(1).alias("y")), ["x", "y"])
    got = [r[0] for r in rows.orderBy("x").select("_curve").collect()]
    top = 4 ** layout.BITS
    assert n == 2000 and got == sorted(got) and abs(got[1000] / top - 0.5) < 0.1 and got[-1] > 0.6 * top


def test_bits_are_taken_in_turns(spark):
    (got,) = spark.range(1).select(layout._woven([F.lit(0b101000000011).cast("long"), F.lit(0b000100000001).cast("long")])).first()
    assert got == int("".join(a + b for a, b in zip(f"{0b101000000011:015b}", f"{0b000100000001:015b}", strict=True)), 2)
