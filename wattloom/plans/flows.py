"""The daily raw and warehouse flows."""

from __future__ import annotations

from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from wattloom.functions.keys import device_id_from_name
from wattloom.operators.generation import solar_generation
from wattloom.operators.merge import insert_new, upsert
from wattloom.operators.quality import CORRUPT, current_violations, length_report, null_report, orphan_keys
from wattloom.plans import dims, facts, partials
from wattloom.schemas import TABLES
from wattloom.session import scratch
from wattloom.sinks import tables as sinks
from wattloom.sinks.tables import Lake
from wattloom.sources.catalogues import LOG_PANEL_ID, panel_catalogue, read_appliances
from wattloom.sources.readings import loads_of, read_topic

HOME_SITE = 1


def load_checked(lake: Lake, df: DataFrame, table: str, label: str, append: Callable[[DataFrame], None]) -> int:
    """Append the rows that fit the table; the number of those that do not.

    A torn log line, a NULL in a required column (a fact without surrogate key, say), text over its limit or a battery name without
    number keeps a row out. Such rows are counted while the good ones are written, and only if there are any is the input read
    again to put them below ``quarantine`` with the reason. What an earlier run of the same label put there goes.
    """
    spec = TABLES[table]
    required = [c for c in spec.required if c in df.columns]
    limits = {c: n for c, n in spec.text_limits.items() if c in df.columns}
    torn = [F.when(F.col(CORRUPT).isNotNull(), "line does not parse")] if CORRUPT in df.columns else []
    if "battery_name" in df.columns:
        name = F.col("battery_name")
        torn.append(F.when(name.isNotNull() & device_id_from_name(name).isNull(), "battery_name without number"))
    tagged = df.withColumn("reason", F.concat_ws(";", *torn, null_report(required), *length_report(limits)))
    bad = F.col("reason") != ""

    seen = Observation()
    good = tagged.observe(seen, F.count_if(bad).alias("bad")).filter(~bad)
    append(good.drop("reason", CORRUPT))
    try:
        n = seen.get.get("bad") or 0
    except Py4JJavaError as e:  # no metrics where nothing ran, or where adaptive execution found nothing left to write
        if "assertion failed" not in str(e.java_exception):
            raise
        n = tagged.filter(bad).count()
    rejects = f"{lake.root.rstrip('/')}/quarantine/{table}/{label}"
    if n:
        tagged.filter(bad).write.mode("overwrite").parquet(rejects)
    elif sinks.exists(lake.spark, rejects):
        sinks.remove(lake.spark, rejects)
    return n


def load_panels(lake: Lake) -> None:
    """Upsert of the panel catalogue; the name of a known panel stays."""
    ratings = ["capacity_kwh", "intensity_power_rating", "temperature_power_rating"]
    lake.write_dim(upsert(lake.dim("solar_panel"), panel_catalogue(lake.spark), ["id"], ratings), "solar_panel")


def run_raw(lake: Lake, inputs: str, date: str, kind: str, panel_id: int = LOG_PANEL_ID) -> dict[str, int]:
    """Home, panels, solar and, for logs, battery readings of the files of one day (or a glob of days).

    A file may hold samples of other days; they are kept with it. ``panel_id`` is the panel that the solar log is of.
    Gives the number of quarantined rows per table.
    """
    spark, label, bad = lake.spark, f"{kind}-{date.replace('*', 'x')}", {}

    def load(table: str, rows: DataFrame, append: Callable[[DataFrame], None], label: str = label) -> None:
        bad[table] = load_checked(lake, rows, table, label, append)

    home = read_topic(spark, inputs, "home", kind, date)
    loads = loads_of(home, "home", kind)
    load("home_power_readings", sinks.home_rows(home, kind), lambda rows: sinks.append_home(lake, rows, kind, loads))

    load_panels(lake)
    solar = read_topic(spark, inputs, "solar", kind, date)
    solar_loads = loads_of(solar, "solar", kind)
    if kind == "file":
        panels = lake.dim("solar_panel").filter(F.col("id") != LOG_PANEL_ID)
        solar = solar_generation(solar.withColumn("site_id", F.lit(HOME_SITE)), panels)
    else:
        solar_loads = [sinks.panel_load(x, panel_id) for x in solar_loads]
    rows = sinks.solar_rows(solar, kind, panel_id)
    load("solar_panel_readings", rows, lambda rows: sinks.append_solar(lake, rows, kind, solar_loads), label if kind == "file" else sinks.panel_load(label, panel_id))

    if kind == "log":
        battery = read_topic(spark, inputs, "battery", kind, date)
        battery_loads = loads_of(battery, "battery", kind)
        load("battery_readings", sinks.battery_rows(battery), lambda rows: sinks.append_battery(lake, rows, battery_loads))
    return bad


RAW_READINGS = ("home_power_readings", "solar_panel_readings", "battery_readings")


def touched_days(lake: Lake, date: str) -> list[str]:
    """Days that the loads of a date hold readings of, or held before they were replaced, that date included; a few dates from the
    loads' register. Streamed loads belong to their newest day."""
    return sorted({date}.union(*(lake.loads(table).parts_of_date(date) for table in RAW_READINGS)))


def run_warehouse(
    lake: Lake, appliances: str | DataFrame, date: str | None, now: str, as_of: bool = False, battery_since: str | None = None,
    reload: bool = False,
) -> dict[str, int]:
    """Dimensions, and facts of the days that the loads of ``date`` touched (None: all days). A second run adds nothing.

    Batteries are looked up in readings from ``battery_since`` on, by default from the first of these days on; those silent since then
    keep the version that the run of their own days gave them.
    ``reload`` lets facts follow the loads instead, whatever the date: buckets that a new or replaced load touches, or touched before, are merged
    anew from the partial facts of all loads, and go where no load has readings left (see :mod:`wattloom.plans.partials`). Facts
    whose device the dimension lacks go to quarantine; a run after the dimension has it inserts them. Gives their number per table.
    A dimension with two current versions of a device, or a stored fact without its dimension row, stops the run.
    """
    days = None if date is None else touched_days(lake, date)
    bad: dict[str, int] = {}

    def check(table: str, dim: str, business_key: str) -> None:
        expect_none(current_violations(lake.dim(dim), [business_key]), f"{dim}: not one current version")

    def stage(rows: DataFrame, table: str) -> DataFrame:
        """Written beside first: what follows reads the few fact rows, and does not compute them again."""
        path = scratch(lake.spark, table)
        rows.write.parquet(path)
        return lake.spark.read.schema(rows.schema).parquet(path)

    def load(table: str, dim: str, business_key: str, keyed: Callable[[DataFrame], DataFrame], staged: Callable[[], DataFrame]) -> None:
        check(table, dim, business_key)
        key, label = TABLES[dim].keys[0], f"{'reload' if reload else 'facts'}-{date or 'all'}"
        if reload:
            with partials.pending(lake, table) as change:
                fresh = stage(keyed(change.merged), table)
                bad[table] = load_checked(lake, fresh, table, label, lambda good: lake.replace_fact(good, table, change.touched))
        else:
            target = lake.read(table)
            fresh = stage(insert_new(facts.one_month(target, days), keyed(staged()), list(TABLES[table].keys)), table)
            bad[table] = load_checked(lake, fresh, table, label, lambda good: lake.append_fact(good, table))
        seen = lake.read(table) if reload else facts.one_month(lake.read(table), days)
        expect_none(orphan_keys(seen, lake.dim(dim), key, key), f"{table}: key without {dim}")

    at = F.lit(now).cast("timestamp")
    listed = read_appliances(lake.spark, appliances) if isinstance(appliances, str) else appliances

    lake.write_dim(dims.dim_appliances(lake.dim("dim_home_appliances"), listed), "dim_home_appliances")
    lake.write_changes(dims.dim_home(lake.current("dim_home"), lake.dim("dim_home_appliances"), at, lake.dim("dim_home")), "dim_home")
    load("fact_home_power_readings", "dim_home", "home_id", lambda staged: facts.keyed_home(staged, lake.dim("dim_home")),
         lambda: facts.staged_home(lake.read("home_power_readings"), days))

    lake.write_changes(dims.dim_panel(lake.current("dim_solar_panel"), lake.dim("solar_panel"), at), "dim_solar_panel")
    load("fact_solar_panel_power_readings", "dim_solar_panel", "solar_panel_id", lambda staged: facts.keyed_solar(staged, lake.dim("dim_solar_panel"), as_of),
         lambda: facts.staged_solar(lake.read("solar_panel_readings"), days))

    readings = lake.read("battery_readings")
    since = battery_since or (days[0] if days else None)
    lake.write_changes(dims.dim_battery(lake.current("dim_battery"), readings, at, since=since), "dim_battery")
    load("fact_battery_power_readings", "dim_battery", "battery_id", lambda staged: facts.keyed_battery(staged, lake.dim("dim_battery"), as_of),
         lambda: facts.staged_battery(readings, days))
    return bad


def expect_none(rows: DataFrame, what: str) -> None:
    found = rows.limit(5).collect()
    if found:
        raise ValueError(f"{what}: {found}")


def load_calendar(lake: Lake, start: str, end: str) -> None:
    """Store the calendar of quarter hours from ``start`` to ``end`` as the next version of ``dim_date``."""
    lake.write_dim(dims.dim_date(lake.spark, start, end), "dim_date")


def retain(lake: Lake, before: str, versions: int = 7) -> dict[str, int]:
    """Remove raw readings of days before a date, and all but the newest versions of dimensions, whose histories are put together where they have
    many parts; the number of day folders per table."""
    for table, spec in TABLES.items():
        if not spec.partitions:
            lake.compact(table)
            lake.expire(table, versions)
    return {table: sinks.drop_days(lake, table, before) for table in RAW_READINGS}
