"""Readers, writers and whole jobs on small files."""

import datetime
import glob
import gzip

import pytest
from pyspark.sql import functions as F

from conftest import rows
from spoorlens.plans import jobs
from spoorlens.schemas import REPORT_COLUMNS, SERVICE_COLUMNS
from spoorlens.session import scratch_dir
from spoorlens.sources import readers, writers

D, T = datetime.date, datetime.datetime


def put(path, *lines, zipped=False):
    opened = gzip.open(path, "wt") if zipped else open(path, "w")
    with opened as fh:
        fh.write("\n".join(lines) + "\n")
    return path


def test_files_with_another_header_are_refused(spark, folder):
    put(f"{folder}/a.csv", "code,country", "A,NL")
    put(f"{folder}/b.csv", "country,code", "NL,B")
    with pytest.raises(Exception, match="header"):
        readers.read_csv(spark, f"{folder}/*.csv").collect()


def test_gzip_and_spread(spark, folder):
    put(f"{folder}/a.csv.gz", "x,y", *[f"{n},v" for n in range(50)], zipped=True)
    df = readers.read_csv(spark, f"{folder}/*", spread=3)
    assert df.count() == 50 and dict(df.dtypes) == {"x": "string", "y": "string"}


def test_the_caller_decides_on_single_csv(spark, folder):
    df = spark.range(100).repartition(4)
    writers.write_csv(df, f"{folder}/one", single=True)
    writers.write_csv(df, f"{folder}/many")
    assert len(glob.glob(f"{folder}/one/part-*")) == 1
    assert len(glob.glob(f"{folder}/many/part-*")) == 4


def test_partitioned_overwrite(spark, folder):
    old = spark.createDataFrame([(1, 2024, 1), (2, 2024, 2), (3, None, None)], "v int, year int, month int")
    writers.write_parquet(old, folder, ["year", "month"])
    assert glob.glob(f"{folder}/year=__HIVE_DEFAULT_PARTITION__/*")
    new = spark.createDataFrame([(9, 2024, 2)], "v int, year int, month int")
    writers.write_parquet(new, folder, ["year", "month"], only_given_partitions=True)
    assert rows(readers.read_parquet(spark, folder), "v") == [(1,), (3,), (9,)]
    writers.write_parquet(new, folder, ["year", "month"])
    assert rows(readers.read_parquet(spark, folder), "v") == [(9,)]


def test_large_month_is_written_by_several_tasks(spark, folder):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "16KB")
    try:
        df = spark.range(200_000).repartition(8).select("id", F.lit(2024).alias("year"), F.lit(1).alias("month"))
        writers.write_parquet(df, folder, ["year", "month"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.minPartitionSize")
    assert len(glob.glob(f"{folder}/year=2024/month=1/*.parquet")) > 1


def test_month_is_that_of_each_row(spark, folder):
    a = spark.createDataFrame([("2024-01-31 23:00:00", 1.0), ("2024-02-01 00:00:00", 2.0)], "time string, T double")
    b = spark.createDataFrame([("2024-01-05 00:00:00", 5)], "time string, N int")
    a.write.parquet(f"{folder}/a")
    b.write.parquet(f"{folder}/b")
    got = jobs.compact_weather(spark, [f"{folder}/a", f"{folder}/b"], f"{folder}/out")
    assert rows(got, F.col("month").cast("string"), "T", "N") == [
        ("2024-01", 1.0, None), ("2024-01", None, 5), ("2024-02", 2.0, None)]


def test_scratch_folder(spark):
    a, b = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert a != b
    set_to = spark.conf.get("spark.checkpoint.dir", None)
    if set_to:
        assert a.startswith(set_to)


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    """Raw files, and all jobs run on them one after another."""
    root = str(tmp_path_factory.mktemp("lake"))
    header = ",".join([*SERVICE_COLUMNS, "Extra"])

    def service(sid, stop, code, arrival, departure, delay, complete="false", partly="false", date="2024-01-01"):
        return f"{sid},{date},IC,NS,12.0,{complete},{partly},0,{stop},{code},name,{arrival},{delay},false,{departure},,false,,1,1,e"

    raw = {n: f"{root}/raw-{n}" for n in ("services", "stations", "disruptions", "feed", "weather")}
    for path in raw.values():
        import os
        os.makedirs(path)
    put(f"{raw['services']}/services-2024.csv.gz", header,
        service("s1", "1", " asd ", "2024-01-01T08:05:00", "2024-01-01T08:07:00", "4"),
        service("s1", "2", "UT", "2024-01-01T09:00:00", "", "12"),
        service("s2", "3", "asd", "", "2024-01-01T08:30:00", "", partly="true"),
        service("s3", "4", "XX", "", "", "1"),
        service("s4", "5", "UT", "2024-01-02T00:10:00", "", "", date=""), zipped=True)
    put(f"{raw['stations']}/a.csv", "id,code,country,geo_lat,geo_lng",
        "1,asd,NL,,", "2,ASD,NL,52.38,4.90", "3,ut,NL,52.09,5.11", "4,BER,D,,")
    put(f"{raw['disruptions']}/d.csv", "rdt_station_codes,cause_en,statistical_cause_en,cause_group,start_time,end_time",
        '"asd, UT",works,s,g,2024-01-01T08:00:00,2024-01-01T08:07:00', '"ASD",tree,s,g,2024-01-01T08:07:00,2024-01-01T10:00:00',
        '"UT",open,s,g,2024-01-01T08:00:00,', '"",none,s,g,2024-01-01T08:00:00,2024-01-01T09:00:00')
    put(f"{raw['feed']}/h.ics", "BEGIN:VCALENDAR", "BEGIN:VEVENT", "DTSTART:20230101", "SUMMARY:Nieuwjaar (New Year)", "END:VEVENT", "END:VCALENDAR")
    spark.createDataFrame(
        [("w1", "2024-01-01 08:00:00", 52.3, 4.8, "Schiphol", 50.0), ("w2", "2024-01-01 09:00:00", 52.1, 5.2, "De Bilt", 60.0)],
        "station string, time string, lat double, lon double, stationname string, T double").write.mode("overwrite").parquet(raw["weather"])

    out = {"root": root}
    out["stations"] = jobs.consolidate_stations(spark, raw["stations"], f"{root}/stations")
    out["master"] = jobs.build_master(spark, raw["services"], raw["stations"], raw["disruptions"], f"{root}/master")
    out["weather"] = jobs.attach_weather(
        spark, f"{root}/master", f"{root}/stations", raw["weather"], f"{root}/with_weather", f"{root}/mapping")
    out["calendar"] = jobs.build_calendar(spark, raw["feed"], f"{root}/holidays", 2025, 2023, 2024)
    out["report"] = jobs.delay_report(spark, f"{root}/master", f"{root}/holidays", f"{root}/report")
    return out


def test_consolidated_stations(spark, lake):
    got = lake["stations"]
    assert got["stations"].columns == ["id", "code", "country", "geo_lat", "geo_lng"]
    assert rows(got["stations"], "code", "id") == [("ASD", "2"), ("BER", "4"), ("UT", "3")]
    assert rows(got["stats"]) == [(3, 3, 1)] and rows(got["raw_stats"]) == [(4, 3, 2)]
    assert [tuple(r) for r in got["by_country"].collect()] == [("NL", 2), ("D", 1)]
    assert rows(readers.read_csv(spark, f"{lake['root']}/stations_csv"), "code") == [("ASD",), ("BER",), ("UT",)]


def test_master(lake):
    got = lake["master"]
    assert rows(got, "stop_rdt_id", "disruption_cause_en") == [
        ("1", "tree"), ("1", "works"), ("2", None), ("3", "tree"), ("4", None), ("5", None)]
    assert rows(got.filter("stop_rdt_id = '3'"), "station_country", "station_geo_lat", "year", "month", "Extra") == [("NL", 52.38, 2024, 1, "e")]
    assert rows(got.filter("stop_rdt_id = '5'"), "year", "service_train_number") == [(None, 12)]


def test_weather_of_the_nearest_station(lake):
    got = lake["weather"]
    assert rows(got["mapping"], "station_code", "weather_station", "stationname") == [("ASD", "w1", "Schiphol"), ("UT", "w2", "De Bilt")]
    assert rows(got["services_with_weather"], "stop_rdt_id", "weather_station", "T") == [
        ("1", "w1", 50.0), ("1", "w1", 50.0), ("2", "w2", 60.0), ("3", "w1", 50.0), ("5", "w2", None)]
    assert rows(got["without_time"]) == [(6, 5, 1)]
    rate = got["match_rate"].first()
    assert (rate.total, rate.with_weather, rate.station_but_no_weather) == (5, 4, 1)


def test_calendar_job(lake):
    got = rows(lake["calendar"].filter("category = 'Holiday'"))
    assert got == [(D(y, 1, 1), "New Year", "Holiday") for y in (2023, 2024, 2025)]


def test_report_job(lake):
    got = lake["report"]
    assert got.columns == REPORT_COLUMNS
    assert rows(got, "service_date", "hour", "services_in_hour", "partly_cancelled", "holiday_name") == [
        ("2024-01-01", "8", "2", "1", "Christmas vacation"), ("2024-01-01", "8", "2", "1", "New Year"),
        ("2024-01-01", "9", "1", "0", "Christmas vacation"), ("2024-01-01", "9", "1", "0", "New Year"),
        ("2024-01-02", "0", "1", "0", "Christmas vacation")]


def test_report_options(spark, lake):
    root = lake["root"]
    got = jobs.delay_report(
        spark, f"{root}/master", f"{root}/holidays", f"{root}/report2", skip_months=[],
        first_day="2024-01-01", last_day="2024-01-01", one_row_per_stop=True, collapse_holidays=True)
    assert rows(got, "hour", "holiday_name") == [
        ("8", "Christmas vacation; New Year"), ("9", "Christmas vacation; New Year")]
    assert jobs.delay_report(spark, f"{root}/master", f"{root}/holidays", f"{root}/report3", skip_months=[(2024, 1)]).count() == 0


def test_a_december_counts_and_coming_years_have_vacations(spark, lake):
    import inspect

    assert inspect.signature(jobs.delay_report).parameters["skip_months"].default == ()
    root = lake["root"]
    got = jobs.build_calendar(spark, f"{root}/raw-feed", f"{root}/holidays-now")
    last = readers.read_ical(spark, f"{root}/raw-feed").agg(F.max(F.year("event_date"))).first()[0]
    years = {r[0].year for r in got.filter("category = 'Vacation'").select("event_date").distinct().collect()}
    # The feed tells the last year, whenever the job runs.
    assert {2015, last + 1} <= years and max(years) <= last + 2


def test_analysis_job(spark, lake):
    root = lake["root"]
    got = jobs.analyse(spark, f"{root}/with_weather", f"{root}/analysis")
    total = got["by_dimension"].filter("grouping_id = '7'").first()
    assert total.services_in_hour == got["by_time"].filter("grouping_id = '7'").first().services_in_hour
    assert {r.measure for r in got["by_weather"].collect()} == {"T"}


def test_nothing_staged_is_left(spark, lake):
    import os

    from spoorlens.session import scratch_dir, staged, staging_scope

    with staging_scope(spark):
        before = scratch_dir(spark, "x").rsplit("/", 1)[0].removeprefix("file:")
        known = set(os.listdir(before))
        staged(spark.range(3), "gone")
        assert set(os.listdir(before)) > known
    assert set(os.listdir(before)) == known


def test_shuffle_width_follows_the_input(spark, folder):
    from spoorlens import session

    spark.range(1000).write.parquet(f"{folder}/t")
    assert session.size_of(spark, [f"{folder}/t", f"{folder}/*"]) > 2 * 1000
    assert session.size_of(spark, [f"{folder}/none*"]) == 0
    assert session.shuffle_partitions(0) == 200 and session.shuffle_partitions(1 << 50) == 1 << 22


def test_rejects_of_the_master_job(spark, folder):
    import os

    os.makedirs(f"{folder}/services")
    names = list(SERVICE_COLUMNS)
    values = {"Service:RDT-ID": "1", "Service:Date": "2024-13-45", "Service:Train number": "x", "Stop:RDT-ID": "1", "Stop:Station code": "A", "Stop:Arrival time": "2024-01-01 10:00:00"}
    line = ",".join(values.get(c, "") for c in names)
    put(f"{folder}/services/a.csv", ",".join(names), line, line + ",more")
    put(f"{folder}/stations.csv", "code,country,geo_lat,geo_lng", "A,NL,1,2")
    put(f"{folder}/disruptions.csv", "rdt_station_codes,cause_en,statistical_cause_en,cause_group,start_time,end_time", "B,c,s,g,2024-01-01 00:00:00,2024-01-02 00:00:00")
    got = jobs.build_master(spark, f"{folder}/services", f"{folder}/stations.csv", f"{folder}/disruptions.csv", f"{folder}/master", rejects_out=f"{folder}/rejects")
    assert rows(got, "stop_rdt_id", "station_country", "service_train_number") == [("1", "NL", None)]
    found = readers.read_parquet(spark, f"{folder}/rejects")
    assert rows(found, "column", "expected") == [("service_date", "date"), ("service_train_number", "whole number"), (None, "line")]
