import pytest
from pyspark.sql import functions as F

from wattloom.operators.bucketing import last_per_bucket, latest_n, latest_state, sum_per_bucket

AT = "TIMESTAMP'2024-01-01 00:00:00'"


def readings(spark, text=False):
    df = spark.range(3000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 0 ELSE id % 11 END AS dev", f"{AT} + make_dt_interval(0, 0, 0, (id * 7919) % 7200) AS timestamp",
        "id * 0.5D AS v", "id AS n")
    return df.withColumn("status", F.concat(F.lit("s"), F.col("n").cast("string"))) if text else df


def brute(rows, bucketed):
    best = {}
    for r in rows:
        quarter = r["timestamp"].replace(minute=r["timestamp"].minute // 15 * 15, second=0)
        key = (r["dev"], quarter if bucketed else None)
        if key not in best or (r["timestamp"], r["n"]) > (best[key]["timestamp"], best[key]["n"]):
            best[key] = r
    return best


@pytest.mark.parametrize("text", [False, True])
@pytest.mark.parametrize("tie", [None, ["n"]])
def test_last_rows_equal_brute_force(spark, text, tie):
    df = readings(spark, text)
    for bucketed, got in ((True, last_per_bucket(df, "dev", tie_break=tie)), (False, latest_state(df, "dev", tie_break=tie))):
        want, rows = brute(df.collect(), bucketed), got.collect()
        assert len(rows) == len(want)
        for r in rows:
            w = want[r["dev"], r["bucket"] if bucketed else None]
            # Values of one row belong together, with or without a tie-break.
            assert r["timestamp"] == w["timestamp"] and r["v"] == r["n"] * 0.5
            assert tie is None or r["n"] == w["n"]
            assert not text or r["status"] == f"s{r['n']}"


def test_newest_row_may_hold_nulls(spark):
    df = spark.sql(f"SELECT 1 AS dev, {AT} AS timestamp, 5 AS v UNION ALL SELECT 1, {AT} + INTERVAL 1 MINUTE, NULL")
    assert [r["v"] for r in latest_state(df, "dev").collect()] == [None]


def test_sums_are_preserved(spark):
    df = readings(spark)
    got = sum_per_bucket(df, ["dev"], {"v": "v"}, "timestamp")
    assert got.agg(F.sum("v")).first() == df.agg(F.sum("v")).first()
    assert got.select("dev", "bucket").distinct().count() == got.count()


def test_latest_n(spark):
    assert [r["n"] for r in latest_n(readings(spark), 2, tie_break=["n"]).collect()] == [
        r["n"] for r in readings(spark).orderBy(F.desc("timestamp"), F.desc("n")).take(2)]
