"""Runs over changed files only, against runs over all files."""

import datetime
import glob
import os
import shutil

from pyspark.sql import functions as F

from conftest import rows
from spoorlens.plans import incremental, jobs
from spoorlens.sources import readers

HEADER = "Service:RDT-ID,Service:Date,Service:Type,Service:Company,Service:Train number,Service:Completely cancelled," \
    "Service:Partly cancelled,Service:Maximum delay,Stop:RDT-ID,Stop:Station code,Stop:Station name,Stop:Arrival time," \
    "Stop:Arrival delay,Stop:Arrival cancelled,Stop:Departure time,Stop:Departure delay,Stop:Departure cancelled," \
    "Stop:Platform change,Stop:Planned platform,Stop:Actual platform"


def put(path, stops):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    lines = [f"{n},{day},IC,NS,1,false,false,0,{n},{code},,{day} 10:00:00,0,false,,,false,false,1,1" for n, day, code in stops]
    with open(path, "w") as file:
        file.write("\n".join([HEADER, *lines]) + "\n")


def sides(folder):
    with open(f"{folder}/stations.csv", "w") as file:
        file.write("code,country,geo_lat,geo_lng\nA,NL,1,2\nB,DE,3,4\n")
    with open(f"{folder}/disruptions.csv", "w") as file:
        file.write("rdt_station_codes,cause_en,statistical_cause_en,cause_group,start_time,end_time\n\"A,B\",c,s,g,2024-02-01 00:00:00,2024-02-20 00:00:00\n")
    return f"{folder}/stations.csv", f"{folder}/disruptions.csv"


def test_master_follows_its_files(spark, folder):
    stations, disruptions = sides(folder)
    services, out, ledger = f"{folder}/services", f"{folder}/master", f"{folder}/ledger"
    cols = ["stop_rdt_id", "stop_station_code", "station_country", "disruption_cause_en", "year", "month"]

    def run():
        done = incremental.refresh_master(spark, f"{services}/*.csv", stations, disruptions, out, ledger)
        jobs.build_master(spark, f"{services}/*.csv", stations, disruptions, f"{folder}/whole")
        assert rows(readers.read_parquet(spark, out), *cols) == rows(readers.read_parquet(spark, f"{folder}/whole"), *cols)
        return sorted(os.path.basename(p) for p in done.read), done.months

    put(f"{services}/a.csv", [(1, "2024-01-05", "A"), (2, "2024-02-05", "B")])
    put(f"{services}/b.csv", [(3, "2024-03-05", "B"), (4, "", "A")])
    assert run()[0] == ["a.csv", "b.csv"]
    assert run() == ([], [])
    # A new file with a month of its own, and one month of another.
    put(f"{services}/c.csv", [(5, "2024-02-07", "A"), (6, "2024-05-01", "A")])
    before = {p: os.stat(p).st_mtime_ns for p in glob.glob(f"{out}/year=2024/month=[13]/*.parquet")}
    assert run() == (["a.csv", "c.csv"], [("2024", "2"), ("2024", "5")])
    assert before and before == {p: os.stat(p).st_mtime_ns for p in glob.glob(f"{out}/year=2024/month=[13]/*.parquet")}
    # A file that loses its rows of one month, which no other file has.
    put(f"{services}/c.csv", [(5, "2024-02-07", "A"), (7, "2024-02-08", "C")])
    assert run() == (["a.csv", "c.csv"], [("2024", "2"), ("2024", "5")])
    assert not os.path.exists(f"{out}/year=2024/month=5")
    # A file that is gone.
    os.remove(f"{services}/a.csv")
    assert run() == (["c.csv"], [("2024", "1"), ("2024", "2")])
    # Every row depends on the stations.
    with open(stations, "a") as file:
        file.write("C,BE,5,6\n")
    assert run()[0] == ["b.csv", "c.csv"]
    assert run() == ([], [])


def test_a_run_that_dies_before_the_ledger_is_repeated(spark, folder):
    stations, disruptions = sides(folder)
    services, out, ledger = f"{folder}/services", f"{folder}/master", f"{folder}/ledger"
    put(f"{services}/a.csv", [(1, "2024-01-05", "A")])
    incremental.refresh_master(spark, f"{services}/*", stations, disruptions, out, ledger)
    put(f"{services}/b.csv", [(2, "2024-01-06", "A")])
    incremental.refresh_master(spark, f"{services}/*", stations, disruptions, out, ledger)
    shutil.rmtree(f"{ledger}/version=2")
    done = incremental.refresh_master(spark, f"{services}/*", stations, disruptions, out, ledger)
    assert len(done.read) == 2 and rows(readers.read_parquet(spark, out), "stop_rdt_id") == [("1",), ("2",)]


def test_month_folders_follow_their_files(spark, folder):
    at = datetime.datetime
    readings, out, ledger = f"{folder}/readings", f"{folder}/out", f"{folder}/ledger"
    one = spark.createDataFrame([(at(2024, 1, 31, 23), 1.0), (at(2024, 2, 1), 2.0)], "time timestamp, T double")
    two = spark.createDataFrame([(at(2024, 3, 5), 5)], "time timestamp, N int")
    one.write.parquet(f"{readings}/a b")
    two.write.parquet(f"{readings}/c")
    assert len(incremental.refresh_months(spark, f"{readings}/*", out, ledger).months) == 3
    got = lambda: rows(readers.read_parquet(spark, out, merge=True), F.col("month").cast("string"), "T", "N")
    assert got() == [("2024-01", 1.0, None), ("2024-02", 2.0, None), ("2024-03", None, 5)]
    two.withColumn("N", F.lit(7)).write.mode("overwrite").parquet(f"{readings}/c")
    done = incremental.refresh_months(spark, f"{readings}/*", out, ledger)
    assert done.months == [("2024-03",)] and not any("a b" in p for p in done.read)
    assert got() == [("2024-01", 1.0, None), ("2024-02", 2.0, None), ("2024-03", None, 7)]
    assert incremental.refresh_months(spark, f"{readings}/*", out, ledger) == incremental.Refreshed([], [])
