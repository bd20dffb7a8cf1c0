"""Plan shapes that must hold at any size."""

import pytest
from pyspark.sql import functions as F

from wattloom.workload import QUERIES

FOLDER = "/root/testdata/sf0.001"
FILES = {"daily_flows", "stream_tumbling_15m", "stream_drop_repeats", "stream_ingest_logs", "stream_ingest_batteries", "stream_insert_new"}
SLOW = {"fact_shrunk_load", "stream_late_days", "scd2_late_changes", "scd2_late_spans", "dim_history_parts", "stream_last_per_bucket", "stream_latest_state", "stream_upsample"}


def plan(spark, name):
    return QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - FILES - SLOW))
def test_no_cross_join_and_no_python(spark, name):
    text = plan(spark, name)
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas"):
        assert bad not in text


@pytest.mark.parametrize("name", ["as_of_join", "solar_generation", "solar_fact_15m", "scd2_apply", "left_join_current"])
def test_joins_do_not_depend_on_broadcasting(spark, name):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(spark, name)
        assert "Broadcast" not in text and "CartesianProduct" not in text and "SortMergeJoin" in text
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_day_filter_and_columns_reach_the_scan(spark):
    text = plan(spark, "on_day")
    assert "GreaterThanOrEqual(ts,2024-01-03T00:00)" in text and "LessThan(ts,2024-01-04T00:00)" in text
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,value:double>" in text


@pytest.mark.parametrize("name", ["current_key_join", "solar_generation_15m", "daily_kwh", "top_intervals", "orphan_keys"])
def test_sums_are_partial_before_the_shuffle(spark, name):
    text = plan(spark, name)
    assert "partial_" in text and text.index("partial_") > text.index("Exchange hashpartitioning")


def test_last_per_bucket_is_limited_before_its_one_shuffle(spark):
    text = plan(spark, "last_per_bucket")
    assert text.count("Exchange hashpartitioning") == 1
    assert text.index("Final") < text.index("Exchange hashpartitioning") < text.index("Partial")


def test_newest_is_limited_before_its_shuffle(spark):
    text = plan(spark, "dim_battery")
    assert "WindowGroupLimit" in text and "max_by" not in text


def test_the_baseline_job_shuffles_nothing(spark, tmp_path):
    """One panel for a day of samples: the catalogue is literal rows, so the larger side stays where it is."""
    from wattloom.operators.generation import solar_generation
    from wattloom.sources.catalogues import panel_catalogue
    from wattloom.sources.readings import read_weather_csv

    (tmp_path / "w.csv").write_text("timestamp,solar_intensity,temp\n" + "2013-01-01 01:00:00,5.0,20.0\n" * 2000)
    weather = read_weather_csv(spark, str(tmp_path / "w.csv")).withColumn("site_id", F.hour("timestamp"))
    text = solar_generation(weather, panel_catalogue(spark)).select("timestamp", "panel_id", "generation_power_wh")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in text and "BuildRight" in text and "Exchange hashpartitioning" not in text and "SortMergeJoin" not in text
