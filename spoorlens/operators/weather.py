"""Hourly weather: typed columns, station list, and the join to stops."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F, types as T

from spoorlens import schemas
from spoorlens.functions.values import epoch_to_instant, month_key, to_double, to_instant
from spoorlens.operators import skew
from spoorlens.operators.keep_one import keep_one
from spoorlens.session import staged


def keep_known_columns(df: DataFrame, wanted: list[str]) -> DataFrame:
    """The wanted columns that are there, in the wanted order."""
    return df.select(*[c for c in wanted if c in df.columns])


def require_columns(df: DataFrame, columns: list[str], table: str) -> DataFrame:
    absent = [c for c in columns if c not in df.columns]
    if absent:
        raise ValueError(f"{table} lacks column(s) {', '.join(absent)}")
    return df


def parse_time(df: DataFrame, source: str, target: str) -> DataFrame:
    """Time from text, from a long epoch of any unit, or from another time type."""
    kind = df.schema[source].dataType
    if isinstance(kind, T.StringType):
        value = to_instant(source)
    elif isinstance(kind, T.LongType):
        value = epoch_to_instant(source)
    else:
        value = F.col(source).cast("timestamp")
    return df.withColumn(target, value)


def tidy_weather(raw: DataFrame) -> DataFrame:
    """Known columns plus station, time, local date and hour, and coordinates."""
    require_columns(raw, ["station", "time", "lat", "lon"], "weather")
    known = keep_known_columns(raw, schemas.WEATHER_KEYS + schemas.WEATHER_MEASURES)
    if "stationname" not in known.columns:
        known = known.withColumn("stationname", F.lit(None).cast("string"))
    return parse_time(known, "time", "weather_time").withColumns({
        "weather_date": F.to_date("weather_time"),
        "weather_hour": F.hour("weather_time"),
        "weather_station": F.col("station"),
        "weather_lat": to_double("lat"),
        "weather_lng": to_double("lon"),
    })


def measures_of(weather: DataFrame) -> list[str]:
    return [c for c in schemas.WEATHER_MEASURES if c in weather.columns]


def weather_stations(weather: DataFrame) -> DataFrame:
    """One located row per weather station.

    Rows without coordinates go first, so a station with some bad rows is still found.
    The distinct step reduces the readings to a few rows per station before the shuffle.
    """
    places = (
        weather.select("weather_station", "stationname", "weather_lat", "weather_lng")
        .filter(F.col("weather_lat").isNotNull() & F.col("weather_lng").isNotNull())
        .distinct()
    )
    return keep_one(places, ["weather_station"])


def attach_station(stops: DataFrame, mapping: DataFrame, **options) -> DataFrame:
    """Left join of the nearest weather station to each stop."""
    pick = mapping.select(
        F.col("station_code").alias("_mapped"),
        "weather_station",
        F.col("distance_km").alias("weather_station_distance_km"),
    )
    return skew.keyed_join(stops, pick, [("stop_station_code", "_mapped")], **options).drop("_mapped")


def of_months(readings: DataFrame, stops: DataFrame, event_ts: str, month: str = "month") -> DataFrame:
    """The readings of the months in which stops occur.

    ``readings`` lie in month folders. The months of the stops, a row each, are found first
    and sent to the scan, which then lists and reads their folders alone.
    """
    months = staged(stops.select(month_key(event_ts).alias("_month")).filter(F.col("_month") > "").distinct(), "months")
    # Spark prunes at run time only by a side with a filter of its own.
    wanted = F.broadcast(months.filter(F.col("_month") > ""))
    return readings.join(wanted, F.col(month).cast("string") == F.col("_month"), "left_semi")


def attach_weather(
    stops: DataFrame,
    weather: DataFrame,
    event_ts: str = "stop_event_ts",
    by: str = "local_hour",
    **options,
) -> DataFrame:
    """Left join of the hour's weather on (weather station, date, hour).

    ``by="local_hour"`` compares local date and hour, so the hour that occurs twice when
    the clock goes back meets two readings. ``by="instant"`` compares the hour as an
    instant and meets one. Several readings for one station-hour repeat the stop.
    """
    values = measures_of(weather)
    if by == "local_hour":
        left = {"_day": F.to_date(event_ts), "_hour": F.hour(event_ts)}
        right = {"_w_day": F.col("weather_date"), "_w_hour": F.col("weather_hour")}
        on = [("_day", "_w_day"), ("_hour", "_w_hour")]
    elif by == "instant":
        left = {"_hour": F.date_trunc("hour", F.col(event_ts))}
        right = {"_w_hour": F.date_trunc("hour", F.col("weather_time"))}
        on = [("_hour", "_w_hour")]
    else:
        raise ValueError(f"by must be 'local_hour' or 'instant', not {by!r}")
    hourly = weather.select(
        F.col("weather_station").alias("_w_station"),
        *[c.alias(n) for n, c in right.items()],
        *values,
    )
    joined = skew.keyed_join(
        stops.withColumns(left), hourly, [("weather_station", "_w_station"), *on], **options
    )
    return joined.drop("_w_station", *left, *right)


def attach_next_weather(
    stops: DataFrame, mapping: DataFrame, weather: DataFrame, event_ts: str = "stop_event_ts",
) -> DataFrame:
    """Left join of the hour's weather from the nearest of several stations that has it.

    ``mapping`` has several weather stations per station code, by ``place``. Which of them
    serves is settled per station, date and hour that occur, and not per stop: a row per
    candidate meets the hours that have readings, and the lowest place stays.
    """
    asked = stops.select(
        F.col("stop_station_code").alias("_code"), F.to_date(event_ts).alias("_a_day"), F.hour(event_ts).alias("_a_hour")
    ).dropna().distinct()
    candidates = mapping.select(F.col("station_code").alias("_candidate_of"), "place", "weather_station", "distance_km")
    hours = staged(weather.select(
        F.col("weather_station").alias("_w_station"), F.col("weather_date").alias("_w_day"), F.col("weather_hour").alias("_w_hour")
    ).distinct(), "hours")
    each = skew.keyed_join(asked, candidates, [("_code", "_candidate_of")], how="inner")
    met = skew.keyed_join(each, hours, [("weather_station", "_w_station"), ("_a_day", "_w_day"), ("_a_hour", "_w_hour")], how="inner")
    first = Window.partitionBy("_code", "_a_day", "_a_hour").orderBy("place")
    serving = staged(
        met.withColumn("_first", F.row_number().over(first)).filter("_first = 1")
        .select("_code", "_a_day", "_a_hour", "place", "weather_station", F.col("distance_km").alias("weather_station_distance_km")), "serving",
    )
    dated = stops.withColumns({"_day": F.to_date(event_ts), "_hour": F.hour(event_ts)})
    mapped = skew.keyed_join(dated, serving, [("stop_station_code", "_code"), ("_day", "_a_day"), ("_hour", "_a_hour")])
    return attach_weather(mapped.drop("_code", "_a_day", "_a_hour", "_day", "_hour"), weather, event_ts)
