"""Jobs for spark-submit: ``prepare`` writes input series, ``raw`` and ``warehouse`` load one day, ``calendar`` stores the calendar,
``retain`` drops old raw days, ``tables`` declares the catalog."""

from __future__ import annotations

import argparse

from wattloom.plans.flows import load_calendar, retain, run_raw, run_warehouse
from wattloom.plans.prepare import write_inputs
from wattloom.schemas import ensure_tables, namespace_exists
from wattloom.session import build_session
from wattloom.sinks.tables import Lake
from wattloom.sources.catalogues import LOG_PANEL_ID


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="wattloom")
    jobs = p.add_subparsers(dest="job", required=True)

    raw = jobs.add_parser("raw", help="load the raw tables of one day, or of a glob of days")
    raw.add_argument("--root", required=True, help="folder of the tables")
    raw.add_argument("--inputs", required=True, help="folder of the source files")
    raw.add_argument("--date", required=True)
    raw.add_argument("--kind", choices=["file", "log"], required=True)

    raw.add_argument("--panel", type=int, default=LOG_PANEL_ID, help="panel that the solar log is of")

    wh = jobs.add_parser("warehouse", help="load dimensions and facts of one day, or of all days")
    wh.add_argument("--root", required=True)
    wh.add_argument("--appliances", required=True, help="JSON document of the home's appliances")
    wh.add_argument("--date", default=None)
    wh.add_argument("--now", required=True, help="start of new dimension versions")
    wh.add_argument("--as-of", action="store_true", help="take the dimension version valid at the reading")
    wh.add_argument("--battery-since", default=None, help="first day to search for the newest battery readings")

    wh.add_argument("--reload", action="store_true", help="put the facts of the touched days in place of earlier ones")

    prep = jobs.add_parser("prepare", help="write home and weather series of some days from a climate file and a list of appliances")
    prep.add_argument("--inputs", required=True, help="folder of the source files")
    prep.add_argument("--climate", required=True)
    prep.add_argument("--appliances", required=True)
    prep.add_argument("--first", required=True)
    prep.add_argument("--last", required=True)
    prep.add_argument("--step-ms", type=float, default=5)

    cal = jobs.add_parser("calendar", help="store the calendar of quarter hours")
    cal.add_argument("--root", required=True)
    cal.add_argument("--first", required=True)
    cal.add_argument("--last", required=True)

    keep = jobs.add_parser("retain", help="remove raw readings of days before a date")
    keep.add_argument("--root", required=True)
    keep.add_argument("--before", required=True)

    tables = jobs.add_parser("tables", help="create namespaces and tables where absent")
    tables.add_argument("--raw", required=True, help="namespace of the raw tables")
    tables.add_argument("--wh", required=True, help="namespace of the warehouse tables")
    tables.add_argument("--location", default=None)
    return p


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = build_session(f"wattloom {args.job}")
    if args.job == "raw":
        for table, bad in run_raw(Lake(spark, args.root), args.inputs, args.date, args.kind, args.panel).items():
            print(f"{table}: {bad} rows in quarantine")
    elif args.job == "warehouse":
        done = run_warehouse(Lake(spark, args.root), args.appliances, args.date, args.now, args.as_of, args.battery_since, args.reload)
        for table, bad in done.items():
            print(f"{table}: {bad} rows in quarantine")
    elif args.job == "prepare":
        lost = write_inputs(spark, args.inputs, args.climate, args.appliances, args.first, args.last, int(args.step_ms * 1000))
        print(f"climate lines without six fields: {lost}")
    elif args.job == "calendar":
        load_calendar(Lake(spark, args.root), args.first, args.last)
    elif args.job == "retain":
        for table, days in retain(Lake(spark, args.root), args.before).items():
            print(f"{table}: {days} day folders removed")
    else:
        for namespace in (args.raw, args.wh):
            print(f"{namespace} {'exists' if namespace_exists(spark, namespace) else 'is new'}")
        ensure_tables(spark, args.raw, args.wh, args.location)


if __name__ == "__main__":
    main()
