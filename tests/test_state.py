"""Newest state as a stream: any cut into micro-batches gives the batch result."""

import os
import random
import subprocess
import sys
from datetime import datetime, timedelta
from types import SimpleNamespace

import duckdb
import pytest
from check import differences
from pyspark import cloudpickle
from pyspark.sql import functions as F

import __spark_entry__ as contract
from wattloom.functions.timebucket import QUARTER_US
from wattloom.operators import bucketing
from wattloom.session import ROCKSDB, STATE_STORE
from wattloom.streaming import jobs, state, upsample

DEFAULT_STORE = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"

T0 = datetime(2024, 1, 1)
SCHEMA = "device STRING, timestamp TIMESTAMP, v INT, d DOUBLE"


def stamped(rows):
    return [(d, T0 + timedelta(minutes=m), v, None if v % 7 == 0 else v / 3) for d, m, v in rows]


def run(spark, folder, out, batches, make):
    """Each batch is a file, and a run of its own over the same state."""
    for n, rows in enumerate(batches):
        spark.createDataFrame(stamped(rows), SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(SCHEMA).parquet(f"{folder}/in")
        jobs.write_stream(make(stream), f"{folder}/{out}", f"{folder}/{out}-state").awaitTermination()
    return spark.read.parquet(f"{folder}/{out}")


ROWS = [(random.Random(k).choice("abc"), random.Random(k + 1000).randint(0, 240), k) for k in range(120)]
CUTS = [[ROWS], [ROWS[60:], ROWS[:60]], [ROWS[n::3] for n in range(3)]]


@pytest.mark.parametrize("cut", range(len(CUTS)))
def test_any_cut_gives_the_batch_result(spark, rows, tmp_path, cut):
    end = [("z", 5000, 1)]  # closes every bucket before it
    made = run(spark, tmp_path, "last", [*CUTS[cut], end], lambda s: state.last_per_bucket(s, "device", late="300 minutes"))
    batch = spark.createDataFrame(stamped(ROWS), SCHEMA)
    want = bucketing.last_per_bucket(batch, "device")
    assert rows(made.filter("device <> 'z'"), "bucket", *batch.columns) == rows(want, "bucket", *batch.columns)


def test_newest_state_and_its_end(spark, rows, tmp_path):
    batches = [[("a", 10, 1), ("b", 10, 2)], [("a", 5, 3), ("a", 10, 9), ("c", 200, 4)], [("c", 201, 5), ("b", 300, 6), (None, 1, 7)], [("a", 1000, 8)]]
    made = run(spark, tmp_path, "new", batches, lambda s: state.latest_state(s, "device", late="30 minutes", idle="1 hour"))
    flat = [r for b in batches for r in b if r[0]]
    batch = spark.createDataFrame(stamped(flat), SCHEMA)
    assert rows(bucketing.latest_state(made, "device"), *batch.columns) == rows(bucketing.latest_state(batch, "device"), *batch.columns)
    emitted = {(r.device, r.v) for r in made.collect()}
    assert ("a", 3) not in emitted and {("a", 8), ("b", 2), ("b", 6), ("c", 4), ("c", 5)} <= emitted
    kept = spark.read.format("statestore").option("stateVarName", "newest").load(f"{tmp_path}/new-state")
    assert {r[0] for r in kept.select("key.device").collect()} == {"a"}


def test_rows_of_a_batch_are_thinned_before_the_shuffle(spark):
    many = spark.range(100_000).select(F.lit("a").alias("device"), F.lit(0).cast("long").alias("bucket"), F.current_timestamp().alias("at"), F.col("id").alias("us"), F.lit(1).cast("long").alias("tie"), F.lit("{}").alias("row"))
    got = many.coalesce(1).mapInPandas(state._newest_of_batch, state.PACKED)
    assert got.count() == 10 and got.agg(F.max("us")).first()[0] == 99_999


@pytest.fixture
def default_store(spark):
    """Spark's own state store, which a session has that says nothing."""
    spark.conf.set(STATE_STORE, DEFAULT_STORE)
    yield
    spark.conf.set(STATE_STORE, ROCKSDB)


@pytest.mark.parametrize("name", ["stream_last_per_bucket", "stream_latest_state", "stream_upsample"])
def test_queries_run_in_a_session_with_the_default_store(spark, tmp_path, default_store, name):
    con = duckdb.connect()
    con.sql(f"""COPY (SELECT i AS event_id, TIMESTAMP '2024-01-01 00:00:30' + INTERVAL (i * 53 % 7200 * 6) MINUTE AS ts, i % 5 AS user_id, 'view' AS event_type, i / 4 AS value, '{{"k": 1}}' AS props
      FROM range(120) AS r(i)) TO '{tmp_path}/events.parquet'""")
    con.sql(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet'")
    want = con.sql(contract.oracle_sql()[name]).df()
    assert len(want) and differences(contract.queries()[name](spark, str(tmp_path)).toPandas(), want) == []
    assert spark.conf.get(STATE_STORE) == DEFAULT_STORE


PROCESSORS = [state.LastOfBuckets(900_000_000), state.Newest(86_400_000), upsample.Segments(60_000_000, 2)]


@pytest.mark.parametrize("processor", PROCESSORS, ids=lambda p: type(p).__name__)
def test_a_processor_loads_without_the_package(tmp_path, processor):
    """As in the process beside the driver, which has only what comes with the processor."""
    load = "import pickle, sys; print(type(pickle.load(sys.stdin.buffer)).__name__)"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", load], input=cloudpickle.dumps(processor), cwd=tmp_path, env=env, capture_output=True, check=False)
    assert done.stdout.decode().split() == [type(processor).__name__], done.stderr.decode()


@pytest.mark.parametrize(("width", "ends"), [(900_000_000, {900_000: [0], 1_800_000: [1]}), (500, {1: [0, 1], 2: [2, 3]})])
def test_a_timer_closes_its_buckets_without_listing_the_others(width, ends):
    """Buckets 0 to 3; several of them end in one millisecond where the width is below that."""
    class Open(dict):
        listed = 0

        def keys(self):
            self.listed += 1
            return list(super().keys())

        containsKey, getValue, removeKey = dict.__contains__, dict.__getitem__, dict.__delitem__

    processor = state.LastOfBuckets(width)
    processor.open = Open({(n * width,): (0, 0, n) for n in range(4)})
    for ms, rows in ends.items():
        timer = SimpleNamespace(getExpiryTimeInMs=lambda ms=ms: ms)
        assert [r for pdf in processor.handleExpiredTimer(("a",), None, timer) for r in pdf.row] == rows
    assert processor.open.listed == (0 if width % 1000 == 0 else len(ends))


def test_buckets_are_aggregated_without_a_processor(spark, tmp_path):
    """A call for every bucket that opens or closes, in Python, is what took the time; the devices' newest rows still need theirs."""
    (tmp_path / "in").mkdir()
    stream = spark.readStream.schema(SCHEMA).parquet(f"{tmp_path}/in")
    plan = lambda df: df._jdf.queryExecution().analyzed().toString()
    made = plan(state.last_per_bucket(stream, "device"))
    assert "InPandas" not in made and "TransformWithState" not in made and "EventTimeWatermark" in made and "max_by" in made
    assert "TransformWithState" in plan(state.latest_state(stream, "device"))


@pytest.mark.parametrize("width", [QUARTER_US, 90_000_001])
def test_buckets_of_every_kind_of_column(spark, rows, tmp_path, width):
    """Columns come out as they went in, and a bucket that ends with the watermark is closed."""
    schema = "device DOUBLE, timestamp TIMESTAMP, `r` ARRAY<STRING>, at STRUCT<a: DOUBLE, b: DATE>, place STRING"
    at = lambda us: datetime(1970, 1, 1) + timedelta(microseconds=us)
    first = 2_000_000 * width
    data = [
        (1.5, at(first), ["x", None], (float("inf"), datetime(2024, 1, 2).date()), "a"),
        (1.5, at(first + width - 1), [], (None, None), 'quoted "b"\n'),
        (2.0, at(first + 1), None, None, None),
        (1.5, at(first + width), ["open"], None, "still open"),
        (None, at(first), [], None, "nobody"), (1.5, None, [], None, "never"),
    ]
    end = first + width + -(first + width) % 1000  # watermarks are whole milliseconds
    marks = [(9.0, at(end + 10 * 60_000_000), [], None, "end")]
    for part in (data, marks):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema(schema).parquet(f"{tmp_path}/in")
        made = state.last_per_bucket(stream, "device", late="10 minutes", width_us=width)
        jobs.write_processed(made, f"{tmp_path}/out", f"{tmp_path}/state").awaitTermination()
    got = spark.read.schema(made.schema).parquet(f"{tmp_path}/out")
    assert got.columns == ["bucket", *stream.columns] and made.schema["at"].dataType == stream.schema["at"].dataType
    want = spark.createDataFrame([data[1], data[2]], schema).select(F.lit(at(first)).alias("bucket"), "*")
    assert rows(got) == rows(want)
