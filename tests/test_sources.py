import json
import time

import pytest

from wattloom.operators.quality import CORRUPT, split_corrupt
from wattloom.sources import readings as src
from wattloom.sources.catalogues import panel_catalogue, read_appliances
from wattloom.sources.climate import read_clm
from wattloom.sources.spine import time_spine

BATTERY = {"capacity_kwh": 12, "max_charge_speed_w": 1, "current_energy_wh": 9860, "is_charging": 0, "status": "ideal", "max_output_w": 3.33}


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


def test_csv_readers(spark, tmp_path):
    w = write(tmp_path / "w.csv", "timestamp,solar_intensity,temp\n2013-01-01 01:01:00.005,1.5,11\n")
    h = write(tmp_path / "h.csv", "timestamp,min_consumption_wh,max_consumption_wh,avg_consumption_wh\n2013-01-01 00:07:00,1,3,2\n")
    assert src.read_weather_csv(spark, w).selectExpr("date_format(timestamp, 'HH:mm:ss.SSS')", "solar_intensity", "temp", "interval_15m").first() == ("01:01:00.005", 1.5, 11.0, 0)
    assert src.read_home_csv(spark, h).select("max_consumption_wh", "interval_15m").first() == (3.0, -4)


def test_logs_keep_torn_lines_apart(spark, tmp_path):
    good = json.dumps({"time_stamp": "2025-02-14 02:08:59", "current_consumption_w": 5, "consumption_accumulated_w": 7})
    path = write(tmp_path / "p.log", good + "\n" + good[:-1] + "\n")
    plain = src.read_home_log(spark, path)
    assert sorted(r["time_stamp"] is None for r in plain.collect()) == [False, True]
    parsed, torn = split_corrupt(src.read_solar_log(spark, path, keep_corrupt=True))
    assert [r["current_consumption_w"] for r in parsed.collect()] == [5.0] and [r[CORRUPT] for r in torn.collect()] == [good[:-1]]


def test_battery_log_has_a_row_per_battery(spark, tmp_path):
    line = json.dumps({"time_stamp": "2025-02-14 02:08:59", "batteries": {f"battery_{i}": BATTERY for i in (1, 2, 3)}})
    path = write(tmp_path / "b.log", line + "\n" + line[:-1] + "\n")
    df = src.read_battery_log(spark, path)
    assert sorted(r["battery_name"] for r in df.collect()) == ["battery_1", "battery_2", "battery_3"]
    assert df.select("current_energy_wh", "is_charging", "status", "interval_15m").distinct().collect() == [(9860.0, 0, "ideal", 4)]
    kept = src.read_battery_log(spark, path, keep_corrupt=True)
    assert sorted((r["battery_name"] is None, r[CORRUPT] is None) for r in kept.collect()) == [(False, True)] * 3 + [(True, False)]


def test_source_paths(tmp_path):
    assert src.source_path("/in/", "home", "log", "2025-02-*") == "/in/log/home_2025-02-*.log"
    with pytest.raises(ValueError, match="choose one of"):
        src.source_path("/in", "battery", "file", "2025-02-14")


def test_many_days_in_one_read(spark, tmp_path):
    for d in (1, 2, 3):
        write(tmp_path / "weather" / f"2013-01-0{d}.csv", f"timestamp,solar_intensity,temp\n2013-01-0{d} 10:00:00,1,2\n")
    assert src.read_topic(spark, str(tmp_path), "solar", "file", "2013-01-0*").count() == 3


def test_panels_and_appliances(spark, tmp_path):
    assert [r["id"] for r in panel_catalogue(spark).orderBy("id").collect()] == [1, 2, 3, 4]
    doc = {"Fridge": {"consumption": [300, 1500], "time": "00:00-24:00"}, "Bulb": {"consumption": [60, 60], "time": "18:00-23:00"}}
    path = write(tmp_path / "a.json", json.dumps(doc, indent=2))
    got = read_appliances(spark, path, home_key=2).orderBy("home_appliance_key").collect()
    assert [tuple(r) for r in got] == [(1, 2, "Fridge", 300.0, 1500.0, "00:00-24:00"), (2, 2, "Bulb", 60.0, 60.0, "18:00-23:00")]


def test_climate_file(spark, tmp_path):
    def day(d, m):
        return [f"* day {d:2d} month {m:2d}"] + [f" {h},{100 + h},{h * 10},0,0,0" for h in range(1, 25)]

    text = "\r\n".join([*["# head"] * 10, " 2013,29.87,1.33,0   # year", " 1,365", *day(31, 1), *day(1, 2)]) + "\r\n"
    got = read_clm(spark, write(tmp_path / "x.clm", text))
    assert got.count() == 48
    row = got.filter("hour = 9").orderBy("date").first()
    assert (str(row["date"]), row["solar_intensity"], row["temp"]) == ("2013-01-31", 90.0, 10.9)
    assert {str(r["date"]) for r in read_clm(spark, str(tmp_path / "x.clm"), year=2020).collect()} == {"2020-01-31", "2020-02-01"}


def test_spine_includes_both_ends(spark):
    got = [str(r[0]) for r in time_spine(spark, "2024-01-01 23:00:00", "2024-01-02 00:30:00").orderBy("timestamp").collect()]
    assert got[0] == "2024-01-01 23:00:00" and got[-1] == "2024-01-02 00:30:00" and len(got) == 7
    assert time_spine(spark, "2013-01-01", "2016-12-31 23:45:00").distinct().count() == 140_256


def test_a_battery_log_with_many_names_costs_its_length(spark, tmp_path):
    """A line with a name that the lines before lack costs no copy of all their names."""
    def seconds(names):
        text = "".join(json.dumps({"time_stamp": "2025-02-14 02:08:59", "batteries": {f"battery_{100_000 + i % names}": BATTERY}}) + "\n" for i in range(60_000))
        path, took = write(tmp_path / f"{names}.log", text), []
        for _ in range(2):
            start = time.perf_counter()
            src.read_battery_log(spark, path, keep_corrupt=True).write.format("noop").mode("overwrite").save()
            took.append(time.perf_counter() - start)
        return min(took)

    few = seconds(10)
    assert seconds(60_000) < 3 * few + 0.3


def test_a_battery_log_line_that_is_no_utf8_is_torn(spark, tmp_path):
    good = json.dumps({"time_stamp": "2025-02-14 02:08:59", "batteries": {"b\u00e4ttery_2": BATTERY}}, ensure_ascii=False).encode()
    path = tmp_path / "b.log"
    path.write_bytes(good + b"\n" + good.replace(b"ideal", b"id\xffal") + b"\n")
    got = {(r.battery_name, r[CORRUPT] is None) for r in src.read_battery_log(spark, str(path), keep_corrupt=True).collect()}
    assert got == {("b\u00e4ttery_2", True), (None, False)}
