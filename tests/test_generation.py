import pytest
from pyspark.sql import functions as F

from wattloom.functions.energy import panel_output
from wattloom.operators.generation import appliance_hourly_load, schedule_hours, solar_generation
from wattloom.sources.catalogues import panel_catalogue

APPLIANCE = "appliance STRING, min_consumption_power_wh DOUBLE, max_consumption_power_wh DOUBLE, usage_time STRING"


def test_rated_conditions_give_rated_energy(spark):
    got = spark.range(1).select(panel_output(*(F.lit(v) for v in (10.0, 1000.0, 25.0, 1000.0, 25.0))), panel_output(
        *(F.lit(v) for v in (10.0, 1000.0, 25.0, 500.0, 50.0)), sample_ms=1000)).first()
    assert got[0] == 10_000 / 720_000 and got[1] == 10_000 / 3600 / 4


def test_zero_temperature_gives_null(spark):
    assert spark.range(1).select(panel_output(*(F.lit(v) for v in (10.0, 1000.0, 25.0, 500.0, 0.0)))).first()[0] is None


@pytest.mark.parametrize("salts", [1, 8])
def test_every_panel_of_the_site_and_no_other(spark, salts):
    weather = spark.createDataFrame([(1, i, 100.0, 25.0) for i in range(50)] + [(2, 0, 1.0, 1.0)], "site_id INT, timestamp INT, solar_intensity DOUBLE, temp DOUBLE")
    got = solar_generation(weather, panel_catalogue(spark), salts=salts)
    assert got.columns == ["site_id", "timestamp", "panel_id", "generation_power_wh"]
    assert got.count() == 200 and got.select("timestamp", "panel_id").distinct().count() == 200


@pytest.mark.parametrize("text, hours", [
    ("00:00-24:00", list(range(1, 24))), ("07:00-07:15", [7]), ("16:00-18:00", [16, 17]), ("16:00-18:01,21:00-21:30", [16, 17, 18, 21]),
    ("22:00-02:00", []), ("545454", []), ("00:00-00:30", []), ("23:30-24:00", [23])])
def test_schedule_text(spark, text, hours):
    df = spark.createDataFrame([("a", 1.0, 2.0, text)], APPLIANCE)
    assert sorted(r["hour"] for r in schedule_hours(df).collect()) == hours


def test_load_sums_over_appliances(spark):
    df = spark.createDataFrame([("a", 100.0, 200.0, "00:00-24:00"), ("b", 10.0, 30.0, "23:00-24:00")], APPLIANCE)
    got = {r["hour"]: r for r in appliance_hourly_load(df, load_factor=0.5).collect()}
    assert len(got) == 23 and got[1]["min_consumption_wh"] == 50.0 and got[1]["minute"] == 0
    assert tuple(got[23][c] for c in ("min_consumption_wh", "max_consumption_wh", "avg_consumption_wh", "minute")) == (55.0, 115.0, 85.0, 59)
