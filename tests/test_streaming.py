import json

from pyspark.sql import functions as F

from wattloom.sinks.tables import open_table
from wattloom.streaming import jobs
from wattloom.schemas import TABLES


def write(folder, name, stamps, device=1):
    folder.mkdir(exist_ok=True)
    lines = [json.dumps({"time_stamp": s, "current_consumption_w": 1.0, "consumption_accumulated_w": device}) for s in stamps]
    (folder / name).write_text("\n".join(lines) + "\n")


def stream(spark, folder):
    rows = jobs.stream_power_log(spark, str(folder))
    return rows.select(F.col("time_stamp").alias("timestamp"), F.col("consumption_accumulated_w").cast("int").alias("panel_id"),
                       F.col("current_consumption_w").alias("generation_power_wh"))


def test_open_windows_wait_and_come_out_later(spark, tmp_path):
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    write(tmp_path / "in", "a.log", ["2024-01-01 00:01:00", "2024-01-01 00:16:00", "2024-01-01 00:31:00", "2024-01-01 00:56:00"])

    def run():
        jobs.write_stream(jobs.tumbling_sum(stream(spark, tmp_path / "in"), "panel_id", "generation_power_wh"), out, state).awaitTermination()
        return spark.read.parquet(out).count()

    assert run() == 3
    write(tmp_path / "in", "b.log", ["2024-01-01 00:50:00", "2024-01-01 02:00:00"])
    assert run() == 4
    assert spark.read.parquet(out).agg(F.sum("generation_power_wh")).first()[0] == 5.0


def test_repeats_are_dropped(spark, tmp_path):
    write(tmp_path / "in", "a.log", ["2024-01-01 00:01:00"] * 3 + ["2024-01-01 00:02:00"])
    kept = jobs.drop_repeats(stream(spark, tmp_path / "in"), ["timestamp", "panel_id"])
    jobs.write_stream(kept, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_insert_new_reads_only_the_months_of_the_batch(spark, tmp_path):
    path, table = str(tmp_path / "fact"), TABLES["fact_solar_panel_power_readings"]
    target = lambda: open_table(spark, path, table.schema)
    keys = ["solar_panel_id", "date_key"]

    def run(name):
        rows = stream(spark, tmp_path / "in").select(
            F.lit(1).cast("bigint").alias("solar_panel_key"), F.col("timestamp").alias("date_key"),
            F.col("panel_id").alias("solar_panel_id"), F.col("generation_power_wh").cast("double").alias("generation_power_wh"))
        jobs.start_insert_new(rows, target, keys, path, str(tmp_path / name)).awaitTermination()
        return target().count()

    write(tmp_path / "in", "a.log", ["2024-01-01 00:00:00", "2024-02-01 00:15:00"])
    assert run("s1") == 2
    write(tmp_path / "in", "b.log", ["2024-02-01 00:15:00", "2024-02-01 00:30:00"])
    assert run("s1") == 3
    assert run("s2") == 3
