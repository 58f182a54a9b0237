"""Run one batch job: ``spark-submit run_job.py JOB [options]``; see ``--help``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession, functions as F

from spoorlens.operators import manifest, quarantine
from spoorlens.plans import incremental, jobs
from spoorlens.session import REPORT_TIME_ZONE, get_session, staging_scope
from spoorlens.sources import readers, writers

TEXT_OPTIONS = {
    "stations": ["stations", "out"],
    "master": ["services", "stations", "disruptions", "out"],
    "weather": ["master", "stations", "readings", "out", "mapping-out"],
    "report": ["master", "holidays", "out"],
    "calendar": ["feed", "out"],
    "manifest": ["pages", "out"],
    "compact": ["out"],
    "analysis": ["master", "out"],
}
# Options that name inputs; their size sets the shuffle width.
INPUTS = ["services", "stations", "disruptions", "master", "readings", "holidays", "feed", "pages"]


def arguments() -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--time-zone", default=REPORT_TIME_ZONE)
    subs = parser.add_subparsers(dest="job", required=True)
    made = {name: subs.add_parser(name) for name in TEXT_OPTIONS}
    for name, options in TEXT_OPTIONS.items():
        for option in options:
            made[name].add_argument(f"--{option}", required=True)
    for name in ("master", "weather"):
        made[name].add_argument("--only-given-months", action="store_true")
    for name in ("master", "compact"):
        made[name].add_argument("--ledger", help="folder of the list of input files; only changed ones are read")
    made["master"].add_argument("--rejects-out", help="folder for values and lines that cannot be read")
    made["weather"].add_argument("--metric", default="planar", choices=["planar", "great_circle"])
    made["weather"].add_argument("--by", default="local_hour", choices=["local_hour", "instant"])
    made["report"].add_argument("--skip-month", action="append", default=[], metavar="YYYY-MM")
    made["report"].add_argument("--first-day")
    made["report"].add_argument("--last-day")
    made["report"].add_argument("--one-row-per-stop", action="store_true")
    made["report"].add_argument("--collapse-holidays", action="store_true")
    made["calendar"].add_argument("--last-year", type=int, help="of repeated holidays; default: the year after the last event")
    made["calendar"].add_argument("--first-vacation-year", type=int, default=2015)
    made["calendar"].add_argument("--last-vacation-year", type=int, help="default: the year after the last event")
    made["manifest"].add_argument("--first-year", type=int, default=manifest.FIRST_YEAR)
    made["compact"].add_argument("--readings", action="append", required=True)
    return parser.parse_args()


def main() -> None:
    a = arguments()
    inputs = []
    for name in INPUTS:
        value = getattr(a, name, None) or []
        inputs += value if isinstance(value, list) else [value]
    spark = get_session(f"spoorlens-{a.job}", a.time_zone, inputs)
    with staging_scope(spark):
        run(spark, a)
    spark.stop()


def run(spark: SparkSession, a: argparse.Namespace) -> None:
    if a.job == "stations":
        for name, df in jobs.consolidate_stations(spark, a.stations, a.out).items():
            if name != "stations":
                df.show(20, truncate=False)
    elif a.job == "master":
        if a.ledger:
            print(incremental.refresh_master(spark, a.services, a.stations, a.disruptions, a.out, a.ledger))
        else:
            jobs.build_master(
                spark, a.services, a.stations, a.disruptions, a.out, a.only_given_months, a.rejects_out
            )
            if a.rejects_out:
                found = quarantine.counts(readers.read_parquet(spark, a.rejects_out))
                found.orderBy(F.desc("rejects")).show(50, truncate=False)
    elif a.job == "weather":
        done = jobs.attach_weather(
            spark, a.master, a.stations, a.readings, a.out, a.mapping_out,
            a.metric, a.by, a.only_given_months,
        )
        for name in ("match_rate", "without_time", "repeated_hours"):
            done[name].show(truncate=False)
        done["services_with_weather"].orderBy("stop_event_ts", "stop_rdt_id").show(20, truncate=False)
    elif a.job == "report":
        skip = [tuple(int(n) for n in month.split("-")) for month in a.skip_month]
        jobs.delay_report(
            spark, a.master, a.holidays, a.out, skip, a.first_day, a.last_day,
            a.one_row_per_stop, a.collapse_holidays,
        )
    elif a.job == "calendar":
        jobs.build_calendar(spark, a.feed, a.out, a.last_year, a.first_vacation_year, a.last_vacation_year)
    elif a.job == "manifest":
        files = jobs.build_manifest(readers.read_parquet(spark, a.pages), a.first_year)
        writers.write_csv(files, a.out)
    elif a.job == "compact":
        if a.ledger:
            print(incremental.refresh_months(spark, "{" + ",".join(a.readings) + "}" if len(a.readings) > 1 else a.readings[0], a.out, a.ledger))
        else:
            jobs.compact_weather(spark, a.readings, a.out)
    elif a.job == "analysis":
        for df in jobs.analyse(spark, a.master, a.out).values():
            df.show(50, truncate=False)


if __name__ == "__main__":
    main()
