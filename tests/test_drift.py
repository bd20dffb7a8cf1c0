import json

import pytest
from pyspark.sql import functions as F

from wattloom.operators.quality import CORRUPT
from wattloom.sources import drift
from wattloom.sources import readings as src


def docs(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def rows_of(spark, schema, *texts):
    out = drift.typed(drift.parse_lines(docs(spark, *texts)), "doc", schema)
    return [r.asDict() for r in out.collect()]


def test_what_fits_is_typed_and_the_rest_is_kept(spark):
    text = '{"a": 5, "b": "x", "c": [1, 2.5, null], "d": {"e": null}, "f": null}'
    (r,) = rows_of(spark, "a INT, b STRING, c ARRAY<DOUBLE>, z INT", text)
    assert (r["a"], r["b"], r["c"], r["z"], r[CORRUPT]) == (5, "x", [1.0, 2.5, None], None, None)
    assert json.loads(r["_rescued"]) == {"d": {"e": None}, "f": None}


@pytest.mark.parametrize("kind,value", [
    ("INT", 3.7), ("INT", 3_000_000_000), ("TINYINT", 300), ("INT", "many"), ("INT", {"v": 1}), ("DOUBLE", "n/a"), ("TIMESTAMP", "noon"),
    ("ARRAY<DOUBLE>", [1, "x"]), ("ARRAY<INT>", [1.5]), ("ARRAY<DOUBLE>", 5), ("MAP<STRING, VARIANT>", [1]), ("MAP<STRING, INT>", {"k": "v"}),
])
def test_values_that_do_not_fit_are_rescued(spark, kind, value):
    (r,) = rows_of(spark, f"a {kind}", json.dumps({"a": value}))
    assert r["a"] is None and json.loads(r["_rescued"]) == {"a": value}


@pytest.mark.parametrize("kind,value,want", [("INT", "12", 12), ("INT", 4.0, 4), ("STRING", 5, "5"), ("DOUBLE", 2, 2.0), ("BIGINT", 9_007_199_254_740_993, 9_007_199_254_740_993)])
def test_values_that_convert_whole_are_typed(spark, kind, value, want):
    (r,) = rows_of(spark, f"a {kind}", json.dumps({"a": value}))
    assert (r["a"], r["_rescued"]) == (want, None)


def test_lines_that_are_no_object_keep_their_text(spark):
    texts = ['{"a": 1', "5", "[1]", "null", '"x"', '{"a": 1, "a": 2}', "nothing"]
    got = rows_of(spark, "a INT", *texts, "", "  ")
    assert [r[CORRUPT] for r in got] == texts and all(r["a"] is None and r["_rescued"] is None for r in got)


def test_null_lines_and_empty_tables(spark):
    assert rows_of(spark, "a INT", None) == []
    assert drift.drift_report(drift.parse_lines(docs(spark)).withColumn("load", F.lit("x")), "a INT").count() == 0


def test_columns_with_clashing_names(spark):
    rows = docs(spark, '{"load": 7, "doc": 1, "_rescued": 2}').selectExpr("value", "'day' AS load", "1 AS doc", "2 AS _rescued", "'o' AS _corrupt_record", "3 AS other")
    out = drift.typed(drift.parse_lines(rows), "doc", "load INT").collect()
    assert [r.asDict() for r in out] == [{CORRUPT: None, "other": 3, "load": 7, "_rescued": '{"_rescued":2,"doc":1}'}]


def test_nested_objects_are_declared_as_maps(spark):
    with pytest.raises(ValueError, match="MAP<STRING, VARIANT>"):
        rows_of(spark, "a STRUCT<b: INT>", "{}")


def test_without_drift_it_reads_what_the_plain_readers_read(spark, tmp_path):
    one = {"capacity_kwh": 12, "max_charge_speed_w": 1, "current_energy_wh": 9860.25, "is_charging": 0, "status": "ideal", "max_output_w": 3.33}
    (tmp_path / "b.log").write_text("".join(json.dumps({"time_stamp": f"2025-02-14 02:08:{s}", "batteries": {"battery_1": one, "battery_2": one}}) + "\n" for s in (10, 11)))
    (tmp_path / "p.log").write_text('{"time_stamp": "2025-02-14 02:08:59", "current_consumption_w": 5, "consumption_accumulated_w": 7.5}\n')
    for name, plain, wide in (("b.log", src.read_battery_log, drift.read_battery_log), ("p.log", src.read_home_log, drift.read_power_log)):
        want, got = plain(spark, str(tmp_path / name)), wide(spark, str(tmp_path / name))
        assert sorted(got.select(want.columns).collect()) == sorted(want.collect())
        assert all(v is None for r in got.collect() for c, v in r.asDict().items() if c.startswith("_"))


def test_batteries_of_another_shape_stay_a_row(spark, tmp_path):
    lines = ['{"time_stamp": "2025-02-14 02:08:59", "batteries": [1]}', '{"time_stamp": "2025-02-14 02:09:59"}', '{"batteries": {"b": 5}}', "{"]
    (tmp_path / "b.log").write_text("\n".join(lines))
    got = {(r.battery_name, r._rescued, r._rescued_line, r[CORRUPT]) for r in drift.read_battery_log(spark, str(tmp_path / "b.log")).collect()}
    assert got == {(None, None, '{"batteries":[1]}', None), (None, None, None, None), ("b", "5", None, None), (None, None, None, "{")}


def test_appliances_with_new_fields(spark):
    text = json.dumps({"b": {"consumption": [1, 2], "time": "00:00-24:00", "room": "hall"}, "a": {"consumption": [3, "x"]}, "c": 4})
    got = drift.read_appliances(docs(spark, text, "torn {"), 9).orderBy("appliance").collect()
    assert [(r.home_appliance_key, r.appliance, r.min_consumption_power_wh, r.usage_time, r._rescued, r[CORRUPT]) for r in got] == [
        (None, None, None, None, None, "torn {"), (1, "a", None, None, '{"consumption":[3,"x"]}', None),
        (2, "b", 1.0, "00:00-24:00", '{"room":"hall"}', None), (3, "c", None, None, "4", None)]


def test_report_names_new_fields_and_changed_kinds(spark):
    lines = [("l1", '{"a": 1}'), ("l2", '{"a": "x", "b": true}'), ("l2", '{"a": 2.5, "b": null}'), ("l3", '{"b": false}')]
    rows = drift.parse_lines(spark.createDataFrame(lines, "load string, value string"))
    got = {(r.load, r.field, r.kind): (r.n, r.unfit, r.status, r.first_load) for r in drift.drift_report(rows, "a DOUBLE").collect()}
    assert got == {
        ("l1", "a", "NUMBER"): (1, 0, "known", "l1"), ("l2", "a", "STRING"): (1, 1, "changed", "l2"), ("l2", "a", "NUMBER"): (1, 0, "known", "l1"),
        ("l2", "b", "BOOLEAN"): (1, 1, "new", "l2"), ("l2", "b", "NULL"): (1, 1, "new", "l2"), ("l3", "b", "BOOLEAN"): (1, 1, "new", "l2")}
