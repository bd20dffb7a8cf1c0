"""Streamed facts against a dimension that changes, compared with one batch run."""

import datetime as dt
import random

import pytest
from pyspark.sql import types as T

from wattloom.operators.timeline import as_of
from wattloom.session import scratch
from wattloom.streaming.keyed import KeyedFacts

T0 = dt.datetime(2024, 1, 1)
FACT = T.StructType([T.StructField("panel", T.IntegerType()), T.StructField("bucket", T.TimestampType()), T.StructField("wh", T.DoubleType())])
DIM = "panel_key BIGINT, id INT, start_date TIMESTAMP, end_date TIMESTAMP, current_flag BOOLEAN"


def day(n):
    return None if n is None else T0 + dt.timedelta(days=n)


def dims(spark, *versions):
    return [spark.createDataFrame([(k, i, day(a), day(b), b is None) for k, i, a, b in v], DIM) for v in versions]


def facts_on(spark, versions, root=None):
    now = [1]
    facts = KeyedFacts(spark, root or scratch(spark, "keyed"), FACT, {"panel": "id"}, "panel_key", "bucket", lambda: now[0], lambda n: versions[n - 1])
    return facts, now


def show(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def batch_run(spark, rows, dim):
    keyed = as_of(spark.createDataFrame(rows, FACT), dim, {"panel": "id"}, "bucket", "start_date", "end_date", ["panel_key"], from_start=True)
    return show(keyed.filter("panel_key IS NOT NULL"))


def test_waiting_facts_and_late_versions(spark):
    versions = dims(spark, [(11, 1, 0, None)], [(11, 1, 0, 5), (12, 1, 5, None), (21, 2, 3, None)])
    facts, now = facts_on(spark, versions)
    rows = [(1, day(1), 1.0), (1, day(6), 2.0), (2, day(1), 3.0), (None, day(1), 4.0), (1, None, 5.0), (1, day(1), 1.0)]
    facts.take(spark.createDataFrame(rows[:4], FACT), 0)
    assert show(facts.read()) == [(1, day(1), 1.0, 11), (1, day(6), 2.0, 11)] and facts.waiting().count() == 2
    now[0] = 2
    facts.take(spark.createDataFrame(rows[4:], FACT), 1)
    want = batch_run(spark, rows, versions[1])
    assert show(facts.read()) == want and {r[3] for r in want} == {11, 12, 21} and facts.waiting().count() == 2
    facts.take(spark.createDataFrame(rows, FACT), 1)  # a batch that comes again
    assert show(facts.read()) == want


def test_a_step_that_died_is_done_again(spark):
    versions = dims(spark, [(11, 1, 0, None)])
    root = scratch(spark, "keyed")
    facts, _ = facts_on(spark, versions, root)
    facts.take(spark.createDataFrame([(1, day(1), 1.0)], FACT), 0)
    spark.createDataFrame([(1, day(9), 9.0, 11)], "panel INT, bucket TIMESTAMP, wh DOUBLE, panel_key BIGINT").write.parquet(f"{root}/data/_keyed=true/_step=2")
    assert show(facts.read()) == [(1, day(1), 1.0, 11)]
    facts.take(spark.createDataFrame([(1, day(2), 2.0)], FACT), 1)
    assert show(facts.read()) == [(1, day(1), 1.0, 11), (1, day(2), 2.0, 11)]


@pytest.mark.parametrize("seed", range(2))
def test_any_order_gives_the_batch_run(spark, seed):
    rnd = random.Random(seed)
    versions = dims(
        spark, [(11, 1, 2, None)], [(11, 1, 2, 6), (12, 1, 6, None), (31, 3, 4, None)],
        [(10, 1, 1, 3), (11, 1, 3, 6), (12, 1, 6, None), (21, 2, 0, 5), (22, 2, 5, None), (31, 3, 4, 9)])
    rows = [(rnd.randint(1, 4), day(rnd.uniform(0, 12)), float(i)) for i in range(60)]
    folder, facts, now = scratch(spark, "facts"), *facts_on(spark, versions)
    checkpoint = scratch(spark, "state")
    for n in range(3):
        now[0] = n + 1
        spark.createDataFrame(rows[n::3], FACT).coalesce(1).write.mode("append").parquet(folder)
        facts.start(spark.readStream.schema(FACT).parquet(folder), checkpoint).awaitTermination()
    assert show(facts.read()) == batch_run(spark, rows, versions[2])
    assert facts.read().count() + facts.waiting().count() == len(rows)
    now[0] = 2  # the dimension moves without new facts
    facts.settle()
    assert show(facts.read()) == batch_run(spark, rows, versions[1])


def test_nothing_yet(spark):
    facts, _ = facts_on(spark, dims(spark, []))
    facts.settle()
    facts.take(spark.createDataFrame([], FACT), 0)
    assert facts.read().count() == 0 and facts.waiting().count() == 0
