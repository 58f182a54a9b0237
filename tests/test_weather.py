import datetime

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from conftest import rows
from spoorlens.operators import quality, weather
from spoorlens.schemas import WEATHER_EVIDENCE
from spoorlens.sources import readers

UTC = datetime.timezone.utc


def _weather(spark, data, kind="string"):
    return weather.tidy_weather(spark.createDataFrame(
        data, f"station string, time {kind}, lat string, lon string, stationname string, T double, FF double, extra int"
    ))


def _stops(spark, data):
    return spark.createDataFrame(data, "id int, stop_station_code string, stop_event_ts timestamp")


def _mapping(spark):
    return spark.createDataFrame([("A", "w1", 1.5), ("B", "w2", 2.5)], "station_code string, weather_station string, distance_km double")


def test_columns_and_times(spark):
    got = _weather(spark, [("w1", "2024-01-01 05:30:00", "52.1", "x", "W", 10.0, None, 1)])
    assert got.columns == ["station", "time", "lat", "lon", "stationname", "T", "FF", "weather_time",
                           "weather_date", "weather_hour", "weather_station", "weather_lat", "weather_lng"]
    r = got.first()
    assert (r.weather_hour, r.weather_lat, r.weather_lng) == (5, 52.1, None)
    assert r.weather_date == datetime.date(2024, 1, 1)


def test_missing_time_column(spark):
    with pytest.raises(ValueError, match="time"):
        weather.tidy_weather(spark.createDataFrame([(1, 1.0, 1.0)], "station int, lat double, lon double"))


def test_nanosecond_file(spark, folder):
    at = datetime.datetime(2024, 1, 1, 5, 0)
    table = pa.table({"station": ["w"], "lat": [1.0], "lon": [2.0], "time": pa.array([at], pa.timestamp("ns"))})
    pq.write_table(table, f"{folder}/a.parquet")
    got = weather.tidy_weather(readers.read_parquet(spark, f"{folder}/*")).first()
    assert got.time == 1704085200 * 10**9 and got.weather_time == at


def test_other_time_types(spark):
    df = spark.createDataFrame([(datetime.date(2024, 1, 2),)], "time date")
    assert weather.parse_time(df, "time", "t").first().t == datetime.datetime(2024, 1, 2)


def test_station_list_keeps_stations_with_some_bad_rows(spark):
    w = _weather(spark, [("w1", None, None, None, "W", 1.0, 1.0, 1), ("w1", None, "52", "5", "W", 1.0, 1.0, 1),
                         ("w1", None, "51", "5", "W", 1.0, 1.0, 1), ("w2", None, "x", "5", "W", 1.0, 1.0, 1)])
    assert rows(weather.weather_stations(w)) == [("w1", "W", 51.0, 5.0)]


def test_join_and_repeated_readings(spark):
    readings = _weather(spark, [
        ("w1", "2024-01-01 05:10:00", "1", "1", "W", 10.0, None, 1), ("w1", "2024-01-01 05:50:00", "1", "1", "W", 11.0, None, 1),
        ("w2", "2024-01-01 05:10:00", "1", "1", "W", 20.0, None, 1),
    ])
    at = datetime.datetime(2024, 1, 1, 5, 59, 59)
    stops = _stops(spark, [(1, "A", at), (2, "B", at), (3, "B", None), (4, "X", at), (5, None, at), (6, "B", datetime.datetime(2024, 1, 2, 5))])
    joined = weather.attach_weather(weather.attach_station(stops, _mapping(spark)), readings)
    assert rows(joined, "id", "weather_station", "T") == [
        (1, "w1", 10.0), (1, "w1", 11.0), (2, "w2", 20.0), (3, "w2", None), (4, None, None), (5, None, None), (6, "w2", None)
    ]
    assert rows(quality.repeated_hours(readings), "weather_station", "readings") == [("w1", 2)]
    # Only T and FF are there of the evidence columns.
    rate = quality.match_rate(joined, "stop_event_ts", "weather_station", WEATHER_EVIDENCE).first()
    assert (rate.total, rate.with_weather, rate.without_time, rate.without_station, rate.station_but_no_weather) == (7, 3, 1, 2, 1)
    assert rate.pct_with_weather == pytest.approx(300 / 7)


def test_rate_of_nothing(spark):
    df = _stops(spark, []).withColumn("weather_station", F.lit("x"))
    rate = quality.match_rate(df, "stop_event_ts", "weather_station", WEATHER_EVIDENCE).first()
    assert rate.total == 0 and rate.pct_with_weather is None


def test_hour_that_occurs_twice(spark, zone):
    zone("Europe/Amsterdam")
    first, second = (1698537600 + n * 3600 for n in (0, 1))  # both are 02:00 local time
    readings = weather.tidy_weather(spark.createDataFrame(
        [("w1", first, 1.0, 1.0, 10.0), ("w1", second, 1.0, 1.0, 20.0)], "station string, time long, lat double, lon double, T double"
    ))
    stops = spark.createDataFrame([(1, "A", second + 60)], "id int, stop_station_code string, s long").withColumn(
        "stop_event_ts", F.timestamp_seconds("s"))
    mapped = weather.attach_station(stops, _mapping(spark))
    assert rows(weather.attach_weather(mapped, readings), "T") == [(10.0,), (20.0,)]
    assert rows(weather.attach_weather(mapped, readings, by="instant"), "T") == [(20.0,)]
    with pytest.raises(ValueError):
        weather.attach_weather(mapped, readings, by="minute")
