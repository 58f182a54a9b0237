import datetime

import pytest
from pyspark.sql import functions as F

from conftest import rows
from spoorlens.functions import values as v
from spoorlens.operators.stops import add_event_time, clean_services


def one(spark, text, fn):
    return spark.createDataFrame([(text,)], "x string").select(fn("x").alias("y")).first()[0]


@pytest.mark.parametrize("text,want", [
    ("12", 12), (" 12 ", 12), ("12.0", 12), ("12.9", 12), ("-3", -3), ("-3.7", -3),
    ("", None), (" ", None), ("x", None), ("1e3", None), (None, None), ("99999999999", None),
])
def test_int(spark, text, want):
    assert one(spark, text, v.to_int) == want


@pytest.mark.parametrize("text,want", [
    ("True", True), ("false", False), ("yes", True), ("1", True), ("0", False),
    ("", None), ("maybe", None), (None, None),
])
def test_flag(spark, text, want):
    assert one(spark, text, v.to_flag) == want


def test_bad_values_give_null(spark):
    for fn in (v.to_double, v.to_day, v.to_instant):
        for text in ("", "  ", "junk", None, "2023-02-30"):
            assert one(spark, text, fn) is None
    assert one(spark, "1.5", v.to_double) == 1.5
    assert one(spark, "2023-02-28", v.to_day) == datetime.date(2023, 2, 28)


def test_each_day_has_the_season_of_its_borders(spark):
    days = spark.sql("SELECT explode(sequence(DATE'2024-01-01', DATE'2024-12-31')) AS d")
    got = {r.d: r.s for r in days.select("d", v.season("d").alias("s")).collect()}
    assert len(got) == 366 and None not in got.values()
    borders = {(12, 20): "autumn", (12, 21): "winter", (3, 19): "winter", (3, 20): "spring",
               (6, 20): "spring", (6, 21): "summer", (9, 22): "summer", (9, 23): "autumn", (2, 29): "winter"}
    for (month, day), season in borders.items():
        assert got[datetime.date(2024, month, day)] == season


@pytest.mark.parametrize("minutes,short,long_", [
    (-1.0, False, False), (0.0, False, False), (2.9, True, False), (3.0, False, False),
    (10.0, False, False), (10.1, False, True),
])
def test_delay_classes(spark, minutes, short, long_):
    df = spark.createDataFrame([(minutes,)], "d double")
    assert tuple(df.select(v.is_short_delay("d"), v.is_long_delay("d")).first()) == (short, long_)


def test_event_time_order(spark):
    df = spark.createDataFrame([(1, 2), (1, None), (None, 2), (None, None)], "a int, d int")
    got = df.select(v.event_time("a", "d", "arrival"), v.event_time("a", "d", "departure")).collect()
    assert [tuple(r) for r in got] == [(1, 2), (1, 1), (2, 2), (None, None)]
    with pytest.raises(ValueError):
        v.event_time("a", "d", "other")


def test_epoch_units(spark):
    at = 1_700_000_000
    df = spark.createDataFrame(
        [(at,), (at * 10**3,), (at * 10**6,), (at * 10**9 + 999,), (None,)], "t long"
    )
    got = [r[0] for r in df.select(F.unix_micros(v.epoch_to_instant("t"))).collect()]
    assert got == [at * 10**6] * 4 + [None]


def test_epochs_keep_both_hours_when_the_clock_goes_back(spark, zone):
    zone("Europe/Amsterdam")
    hours = [1698537600, 1698541200]  # 00:00Z and 01:00Z on 29 October 2023
    df = spark.createDataFrame([(h * 1000,) for h in hours], "t long")
    assert [r[0] for r in df.select(F.unix_seconds(v.epoch_to_instant("t"))).collect()] == hours


def test_share(spark):
    df = spark.createDataFrame([(1, 4), (1, 0), (None, 4), (1, None)], "x int, n int")
    assert [r[0] for r in df.select(v.share("x", "n")).collect()] == [0.25, 0.0, None, 0.0]


def test_services_keep_unknown_columns_and_null_bad_values(spark):
    header = {
        "Service:RDT-ID": "7", "Service:Date": "", "Service:Type": "IC", "Service:Company": "NS",
        "Service:Train number": "12.0", "Service:Completely cancelled": "", "Service:Partly cancelled": "true",
        "Service:Maximum delay": "", "Stop:RDT-ID": "1", "Stop:Station code": " asd ", "Stop:Station name": "A",
        "Stop:Arrival time": "2024-01-02 23:59:00", "Stop:Arrival delay": "", "Stop:Arrival cancelled": "0",
        "Stop:Departure time": "2024-01-03 00:01:00", "Stop:Departure delay": "2", "Stop:Departure cancelled": "x",
        "Stop:Platform change": "", "Stop:Planned platform": "1", "Stop:Actual platform": "1", "Extra": "e",
    }
    raw = spark.createDataFrame([tuple(header.values())], list(header))
    r = clean_services(raw).first()
    assert (r.service_train_number, r.service_maximum_delay, r.stop_station_code) == (12, None, "ASD")
    assert (r.service_completely_cancelled, r.service_partly_cancelled, r.stop_departure_cancelled) == (None, True, None)
    assert r.service_date is None and r.year is None and r.month is None and r.Extra == "e"
    assert r.stop_event_ts == datetime.datetime(2024, 1, 3, 0, 1)
    assert r.stop_arrival_delay is None and r.stop_departure_delay == 2.0


def test_event_time_is_added_only_where_missing(spark):
    df = spark.createDataFrame([(1, 2, 3)], "stop_arrival_ts int, stop_departure_ts int, stop_event_ts int")
    assert add_event_time(df).first().stop_event_ts == 3
    assert rows(add_event_time(df.drop("stop_event_ts")), "stop_event_ts") == [(2,)]
