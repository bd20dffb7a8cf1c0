import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from wattloom.operators.quality import current_violations
from wattloom.plans.flows import run_raw, run_warehouse
from wattloom.schemas import TABLES, drop_tables, ensure_tables, list_tables, namespace_exists
from wattloom.sinks import tables as sinks
from wattloom.sources.catalogues import panel_catalogue

DAY, NEXT = "2025-02-14", "2025-02-15"
NOW = "2025-02-20 00:00:00"


def battery(energy, cap=12):
    return {"capacity_kwh": cap, "max_charge_speed_w": 1, "current_energy_wh": energy, "is_charging": 1, "status": "ideal", "max_output_w": 3.33}


def write_logs(folder, date, cap=12, torn=True):
    (folder / "log").mkdir(parents=True, exist_ok=True)
    power, batteries = [], []
    for h in range(24):
        for m in (0, 7, 20, 50):
            at = f"{date} {h:02d}:{m:02d}:00"
            power.append(json.dumps({"time_stamp": at, "current_consumption_w": 2.0, "consumption_accumulated_w": 1.0}))
            batteries.append(json.dumps({"time_stamp": at, "batteries": {f"battery_{b}": battery(h * 100 + m + b, cap) for b in (1, 2)}}))
    if torn:
        power.append(power[-1][:-1])
        batteries.append(batteries[-1][:-1])
    for topic, lines in (("home", power), ("solar", power), ("battery", batteries)):
        (folder / "log" / f"{topic}_{date}.log").write_text("\n".join(lines) + "\n")


@pytest.fixture
def inputs(tmp_path):
    write_logs(tmp_path / "in", DAY)
    (tmp_path / "in" / "appliances.json").write_text(json.dumps({
        "Fridge": {"consumption": [300, 1500], "time": "00:00-24:00"}, "Bulb": {"consumption": [60, 60], "time": "18:00-23:00"}}))
    return tmp_path / "in"


def counts(lake):
    return {t: lake.read(t).count() for t in TABLES if t.startswith("fact_")}


def test_two_days_and_a_rerun(spark, lake, inputs):
    appliances = str(inputs / "appliances.json")
    bad = run_raw(lake, str(inputs), DAY, "log")
    assert bad == {"home_power_readings": 1, "solar_panel_readings": 1, "battery_readings": 1}
    kept = spark.read.parquet(f"{lake.root}/quarantine/battery_readings/log-{DAY}").collect()
    assert len(kept) == 1 and kept[0]["_corrupt_record"].endswith("}}") and "battery_name" in kept[0]["reason"]

    run_warehouse(lake, appliances, DAY, NOW)
    day_one = {"fact_home_power_readings": 72, "fact_solar_panel_power_readings": 72, "fact_battery_power_readings": 144}
    assert counts(lake) == day_one
    assert lake.read("fact_home_power_readings").filter("min_consumption_power_wh = 4").count() == 24
    last = lake.read("fact_battery_power_readings").filter(
        (F.col("battery_id") == 1) & (F.col("date_key") == F.lit(f"{DAY} 03:00:00").cast("timestamp"))).first()
    assert last["current_energy_wh"] == 308.0 and last["battery_key"] == 120250220
    assert lake.dim("dim_home").select("home_key", "min_consumption_power_wh").collect() == [(1, 360.0)]
    assert lake.read("fact_solar_panel_power_readings").select("solar_panel_key").distinct().collect() == [(420250220,)]

    # The raw day is replaced, the facts add nothing.
    run_raw(lake, str(inputs), DAY, "log")
    run_warehouse(lake, appliances, DAY, NOW)
    assert lake.read("home_power_readings").count() == 96 and counts(lake) == day_one

    # The next day: one appliance more, larger batteries.
    (inputs / "appliances.json").write_text(json.dumps({
        "Fridge": {"consumption": [300, 1500], "time": "00:00-24:00"}, "Bulb": {"consumption": [60, 60], "time": "18:00-23:00"},
        "app": {"consumption": [452, 895], "time": "545454"}}))
    write_logs(inputs, NEXT, cap=14, torn=False)
    assert set(run_raw(lake, str(inputs), NEXT, "log").values()) == {0}
    run_warehouse(lake, appliances, NEXT, "2025-02-21 00:00:00", battery_since=NEXT)
    assert counts(lake) == {t: 2 * n for t, n in day_one.items()}
    homes = lake.read("fact_home_power_readings").groupBy(F.to_date("date_key").cast("string")).agg(F.collect_set("home_key"))
    assert dict(map(tuple, homes.collect())) == {DAY: [1], NEXT: [2]}
    assert lake.dim("dim_home").count() == 2 and lake.dim("dim_battery").count() == 4
    for dim, key in (("dim_home", "home_id"), ("dim_battery", "battery_id"), ("dim_solar_panel", "solar_panel_id")):
        assert current_violations(lake.dim(dim), [key]).count() == 0


def test_file_source_gives_a_fact_row_per_panel_and_bucket(spark, lake, tmp_path):
    from wattloom.plans.prepare import weather_series

    hours = spark.range(1, 25).select(F.col("id").cast("int").alias("hour"), (F.col("id") * 10.0).alias("solar_intensity"), F.lit(20.0).alias("temp"))
    series = weather_series(hours.withColumns({"station": F.lit("s"), "date": F.lit("2013-01-01").cast("date")}), step_us=10_000_000)
    series.select("timestamp", "solar_intensity", "temp").write.option("header", True).csv(str(tmp_path / "in/weather/2013-01-01.csv"))
    load = series.select("timestamp", F.lit(1.0).alias("min_consumption_wh"), F.lit(2.0).alias("max_consumption_wh"), F.lit(1.5).alias("avg_consumption_wh"))
    load.write.option("header", True).csv(str(tmp_path / "in/home/2013-01-01.csv"))
    assert sum(run_raw(lake, str(tmp_path / "in"), "2013-01-01", "file").values()) == 0
    appliances = spark.createDataFrame([(1, 1, "a", 1.0, 2.0, "00:00-24:00")], TABLES["dim_home_appliances"].schema)
    run_warehouse(lake, appliances, "2013-01-01", "2013-01-02 00:00:00")
    facts = lake.read("fact_solar_panel_power_readings")
    assert facts.count() == 3 * 92 and facts.select("date_key").distinct().count() == 92
    raw, fact = (df.agg(F.sum(F.col("generation_power_wh").cast("double"))).first()[0] for df in (lake.read("solar_panel_readings"), facts))
    assert raw == pytest.approx(fact)


def test_unknown_kind_loads_nothing(lake, inputs):
    with pytest.raises(ValueError, match="no 'other' source"):
        run_raw(lake, str(inputs), DAY, "other")


def test_panel_catalogue_change_opens_versions(spark, lake):
    from wattloom.plans.dims import dim_panel

    at = lambda text: F.lit(text).cast("timestamp")
    first = dim_panel(lake.dim("dim_solar_panel"), panel_catalogue(spark), at("2025-02-14"))
    cap = F.when(F.col("id") == 1, 4.0).when(F.col("id") == 3, 12.0).otherwise(F.col("capacity_kwh"))
    second = dim_panel(first, panel_catalogue(spark).withColumn("capacity_kwh", cap), at("2025-03-01"))
    closed = second.filter("NOT current_flag").collect()
    assert sorted(r["solar_panel_id"] for r in closed) == [1, 3] and {r["end_date"] for r in closed} == {datetime(2025, 3, 1)}
    assert second.count() == 6 and second.filter("current_flag").count() == 4


def test_a_version_without_commit_is_not_read(lake):
    rows = lake.spark.createDataFrame([(1, 1, "a", 1.0, 2.0, "x")], TABLES["dim_home_appliances"].schema)
    assert lake.write_dim(rows, "dim_home_appliances") == 1
    rows.unionByName(rows).write.parquet(f"{lake.path('dim_home_appliances')}/data/v2")
    assert lake.dim("dim_home_appliances").count() == 1
    assert lake.write_dim(rows.limit(0), "dim_home_appliances") == 2
    assert lake.dim("dim_home_appliances").count() == 0 and lake.dim_at("dim_home_appliances", 1).count() == 1


def test_old_versions_expire(lake):
    rows = lake.spark.createDataFrame([(1, 1, "a", 1.0, 2.0, "x")], TABLES["dim_home_appliances"].schema)
    for _ in range(4):
        lake.write_dim(rows, "dim_home_appliances")
    assert lake.expire("dim_home_appliances", 2) == 2 and lake.expire("dim_home_appliances", 2) == 0
    assert lake.dim("dim_home_appliances").count() == 1 and lake.write_dim(rows, "dim_home_appliances") == 5


def test_catalog(spark, tmp_path):
    names = ensure_tables(spark, "raw_t", "wh_t", str(tmp_path))
    assert len(names) == 12 and namespace_exists(spark, "raw_t") and not namespace_exists(spark, "absent")
    assert list_tables(spark, "wh_t").count() == 8
    assert ensure_tables(spark, "raw_t", "wh_t", str(tmp_path)) == names
    with pytest.raises(Exception, match="EXCEED_LIMIT_LENGTH"):
        spark.sql(f"INSERT INTO raw_t.solar_panel VALUES (1, '{'x' * 26}', 1, 1, 1, 1)")
    drop_tables(spark, names)
    assert list_tables(spark, "wh_t").count() == 0


def test_retention_prunes_partitions(lake):
    rows = lake.spark.sql("SELECT explode(sequence(TIMESTAMP'2025-02-01', TIMESTAMP'2025-02-14', INTERVAL 6 HOURS)) AS timestamp")
    rows = rows.selectExpr("timestamp", "0S AS interval_15m", "1F AS min_consumption_wh", "1F AS max_consumption_wh")
    sinks.append_home(lake, rows, "log")
    kept = sinks.retain_days(lake.read("home_power_readings"), 7, DAY)
    assert kept.select("day").distinct().count() == 7
    assert "day" in kept._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1].split("]")[0]


def test_command_line(spark, inputs, tmp_path, capsys):
    from wattloom.__main__ import main

    root = str(tmp_path / "cli")
    main(["raw", "--root", root, "--inputs", str(inputs), "--date", DAY, "--kind", "log"])
    assert "battery_readings: 1 rows in quarantine" in capsys.readouterr().out
    main(["warehouse", "--root", root, "--appliances", str(inputs / "appliances.json"), "--date", DAY, "--now", NOW, "--as-of"])
    facts = sinks.Lake(spark, root).read("fact_battery_power_readings")
    # The first version holds from the beginning, so every reading has one.
    assert facts.count() == 144 and facts.filter("battery_key IS NULL").count() == 0
    main(["calendar", "--root", root, "--first", f"{DAY} 00:00:00", "--last", f"{DAY} 23:45:00"])
    assert sinks.Lake(spark, root).dim("dim_date").count() == 96
    main(["retain", "--root", root, "--before", NEXT])
    assert sinks.Lake(spark, root).read("battery_readings").count() == 0


def test_prepared_inputs_load(spark, lake, tmp_path):
    from wattloom.plans.prepare import write_inputs

    header = [f"line {i}" for i in range(12)]
    header[10] = "2013,0,0"
    day = ["* day 1 month 1", *[f"0,{100 + h},{h * 10},0,0,50" for h in range(24)]]
    day[5] = "torn, line"
    (tmp_path / "climate.clm").write_text("\n".join(header + day) + "\n")
    (tmp_path / "list.json").write_text(json.dumps({"Fridge": {"consumption": [300, 1500], "time": "00:00-24:00"}}))
    lost = write_inputs(spark, str(tmp_path / "in"), str(tmp_path / "climate.clm"), str(tmp_path / "list.json"), "2013-01-01", "2013-01-01", 60_000_000)
    assert lost == 1
    assert sum(run_raw(lake, str(tmp_path / "in"), "2013-01-01", "file").values()) == 0
    assert lake.read("home_power_readings").count() > 1000 and lake.read("solar_panel_readings").count() > 3000


def test_late_samples_stay_with_their_load(spark, lake, inputs):
    run_raw(lake, str(inputs), DAY, "log")
    log = inputs / "log" / f"home_{NEXT}.log"
    write_logs(inputs, NEXT, torn=False)
    late = json.dumps({"time_stamp": f"{DAY} 23:59:59", "current_consumption_w": 7.0, "consumption_accumulated_w": 1.0})
    log.write_text(late + "\n" + log.read_text())
    for _ in range(2):
        run_raw(lake, str(inputs), NEXT, "log")
    days = dict(map(tuple, lake.read("home_power_readings").groupBy(F.col("day").cast("string")).count().collect()))
    assert days == {DAY: 97, NEXT: 96}
    # The file is mended and empty now: its load goes, the other stays.
    log.write_text("")
    run_raw(lake, str(inputs), NEXT, "log")
    assert lake.read("home_power_readings").count() == 96


def test_quarantine_follows_its_source(spark, lake, inputs):
    run_raw(lake, str(inputs), DAY, "log")
    where = f"{lake.root}/quarantine/battery_readings/log-{DAY}"
    assert sinks.exists(spark, where)
    write_logs(inputs, DAY, torn=False)
    assert set(run_raw(lake, str(inputs), DAY, "log").values()) == {0} and not sinks.exists(spark, where)


def test_a_battery_without_number_waits_in_quarantine(spark, lake, inputs):
    log = inputs / "log" / f"battery_{DAY}.log"
    log.write_text(log.read_text() + json.dumps({"time_stamp": f"{DAY} 01:00:00", "batteries": {"spare": battery(1)}}) + "\n")
    assert run_raw(lake, str(inputs), DAY, "log")["battery_readings"] == 2
    assert run_warehouse(lake, str(inputs / "appliances.json"), DAY, NOW)["fact_battery_power_readings"] == 0
    assert counts(lake)["fact_battery_power_readings"] == 144


def test_facts_of_unknown_panels_wait(spark, lake, inputs):
    run_raw(lake, str(inputs), DAY, "log", panel_id=9)
    bad = run_warehouse(lake, str(inputs / "appliances.json"), DAY, NOW)
    assert bad["fact_solar_panel_power_readings"] == 72 and counts(lake)["fact_solar_panel_power_readings"] == 0


def test_two_stations_are_not_mixed(spark, tmp_path):
    from wattloom.plans.prepare import write_inputs

    for name in ("a", "b"):
        (tmp_path / f"{name}.clm").write_text("x\n")
    with pytest.raises(ValueError, match="2 climate files"):
        write_inputs(spark, str(tmp_path / "in"), str(tmp_path / "*.clm"), "none.json", "2013-01-01", "2013-01-01")
