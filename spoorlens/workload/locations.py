"""Stations, nearest weather station, weather joins and join quality."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from spoorlens.functions.geo import great_circle_km, planar_distance_sq
from spoorlens.functions.values import all_present, any_missing, delay_minutes, event_time
from spoorlens.operators import quality, rollup, weather
from spoorlens.operators.keep_one import keep_one, missing_from, prefer_located
from spoorlens.operators.nearest import nearest_site, nearest_sites
from spoorlens.operators.skew import keyed_join
from spoorlens.schemas import WEATHER_EVIDENCE
from spoorlens.session import scratch_dir, staged
from spoorlens.sources import bucketed, readers, writers
from spoorlens.workload import roles
from spoorlens.workload.registry import plain, query, r6, rounded, table


def nearest_sql(order: str) -> str:
    return f"""
WITH {roles.PLACES_SQL},
spots AS (SELECT DISTINCT station_lat, station_lng FROM trains),
places AS (SELECT weather_lat, weather_lng, min(weather_station) AS weather_station FROM sites GROUP BY 1, 2),
ranked AS (SELECT *, row_number() OVER (PARTITION BY station_lat, station_lng ORDER BY {order}, weather_station) AS place
           FROM spots, places)
SELECT t.station_code, r.weather_station, s.stationname, round({roles.KM_SQL.replace('weather_l', 'r.weather_l').replace('station_l', 't.station_l')} + 1.2345e-9, 6) AS distance_km
FROM trains t JOIN ranked r ON r.place = 1 AND t.station_lat = r.station_lat AND t.station_lng = r.station_lng
JOIN sites s ON s.weather_station = r.weather_station"""


PLANAR_ORDER = "round((station_lat - weather_lat) * (station_lat - weather_lat) + (station_lng - weather_lng) * (station_lng - weather_lng), 9)"


def _nearest(spark, folder, **options) -> DataFrame:
    found = nearest_site(roles.train_stations(spark, folder), roles.weather_sites(spark, folder), **options)
    return found.select("station_code", "weather_station", "stationname", r6("distance_km").alias("distance_km"))


@query(nearest_sql(PLANAR_ORDER))
def nearest_station(spark, folder):
    return _nearest(spark, folder)


@query(nearest_sql(f"round({roles.KM_SQL}, 6)"))
def nearest_station_haversine(spark, folder):
    return _nearest(spark, folder, metric="great_circle")


@query(nearest_sql(PLANAR_ORDER))
def nearest_station_shuffled(spark, folder):
    """The form for site tables beyond the broadcast bound."""
    return _nearest(spark, folder, small_rows=0, hot_rows=1000)


@query(f"""
WITH {roles.PLACES_SQL},
pairs AS (SELECT * FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey
          JOIN trains ON station_code = 'S' || o_custkey JOIN sites ON weather_station = l_suppkey)
SELECT c_nationkey, count(*) AS pairs,
       round(avg((station_lat - weather_lat) ** 2 + (station_lng - weather_lng) ** 2) + 1.2345e-9, 6) AS mean_distance_sq,
       round(avg({roles.KM_SQL}) + 1.2345e-9, 6) AS mean_km
FROM pairs GROUP BY c_nationkey""")
def shipment_distances(spark, folder):
    """Both distances between the customer and the supplier of every line item."""
    trains = roles.train_stations(spark, folder)
    sites = roles.weather_sites(spark, folder).drop("stationname")
    orders = table(spark, folder, "orders").select(
        "o_orderkey", F.col("o_custkey").alias("_cust"),
        F.concat(F.lit("S"), F.col("o_custkey").cast("string")).alias("_code"),
    )
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_suppkey")
    nations = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    wide = keyed_join(lines, orders, [("l_orderkey", "o_orderkey")], how="inner")
    wide = keyed_join(wide, nations, [("_cust", "c_custkey")], how="inner")
    wide = keyed_join(wide, trains, [("_code", "station_code")], how="inner")
    wide = keyed_join(wide, sites, [("l_suppkey", "weather_station")], how="inner")
    ends = [F.col(c) for c in ("station_lat", "station_lng", "weather_lat", "weather_lng")]
    return wide.groupBy("c_nationkey").agg(
        F.count("*").alias("pairs"),
        r6(F.avg(planar_distance_sq(*ends))).alias("mean_distance_sq"),
        r6(F.avg(great_circle_km(*ends))).alias("mean_km"),
    )


def nearest_places_sql(k: int) -> str:
    return f"""{roles.PLACES_SQL},
ranked AS (SELECT station_code, weather_station, stationname, {roles.KM_SQL} AS km,
  row_number() OVER (PARTITION BY station_code ORDER BY {PLANAR_ORDER}, weather_station) AS place FROM trains, sites),
mapping AS (SELECT * FROM ranked WHERE place <= {k})"""


@query(f"""
WITH {nearest_places_sql(3)}
SELECT station_code, CAST(place AS INT) AS place, weather_station, stationname, round(km + 1.2345e-9, 6) AS distance_km FROM mapping""")
def nearest_three_stations(spark, folder):
    found = nearest_sites(roles.train_stations(spark, folder), roles.weather_sites(spark, folder), 3)
    return found.select("station_code", "place", "weather_station", "stationname", r6("distance_km").alias("distance_km"))


@query(f"""
WITH {roles.STOPS_SQL}, {nearest_places_sql(3)},
readings AS (SELECT user_id % 100 AS w_station, CAST(ts AS DATE) AS w_date, hour(ts) AS w_hour, max(value) AS "T"
             FROM events WHERE event_type = 'view' GROUP BY 1, 2, 3),
timed_stops AS (SELECT *, coalesce(dep, arr) AS event_at FROM stops),
met AS (SELECT stop_rdt_id, place, weather_station, "T", row_number() OVER (PARTITION BY stop_rdt_id ORDER BY place) AS n
  FROM timed_stops JOIN mapping ON station_code = stop_station_code
  JOIN readings ON w_station = weather_station AND w_date = CAST(event_at AS DATE) AND w_hour = hour(event_at))
SELECT s.stop_rdt_id, CAST(place AS INT) AS place, weather_station, "T" FROM timed_stops s LEFT JOIN met m ON m.stop_rdt_id = s.stop_rdt_id AND n = 1""")
def weather_of_next_station(spark, folder):
    """The hour's weather of the nearest of three stations that has a reading for it."""
    stops = roles.stops(spark, folder).withColumn(
        "stop_event_ts", event_time("stop_arrival_ts", "stop_departure_ts", prefer="departure")
    )
    mapping = nearest_sites(roles.train_stations(spark, folder), roles.weather_sites(spark, folder), 3)
    joined = weather.attach_next_weather(stops, mapping, staged(_hourly_weather(spark, folder), "hourly"))
    return joined.select("stop_rdt_id", "place", "weather_station", "T")


# --- weather joins ---------------------------------------------------------------


def _mapping(spark, folder) -> DataFrame:
    """Customers as train stations; those in debt have no weather station."""
    c = table(spark, folder, "customer").filter(F.col("c_acctbal") >= 0)
    return c.select(
        F.concat(F.lit("S"), F.col("c_custkey").cast("string")).alias("station_code"),
        F.pmod("c_custkey", F.lit(100)).alias("weather_station"),
        F.abs(F.col("c_acctbal")).alias("distance_km"),
    )


def _hourly_weather(spark, folder) -> DataFrame:
    """One reading per station and hour, made from the view events."""
    e = table(spark, folder, "events").filter(F.col("event_type") == "view")
    hour = F.date_trunc("hour", "ts")
    return (
        e.groupBy(F.pmod("user_id", F.lit(100)).alias("weather_station"), hour.alias("weather_time"))
        .agg(F.max("value").alias("T"), F.count("*").alias("FF"))
        .withColumns({"weather_date": F.to_date("weather_time"), "weather_hour": F.hour("weather_time")})
    )


def _with_weather(spark, folder, **options) -> DataFrame:
    stops = roles.stops(spark, folder).withColumn(
        "stop_event_ts", event_time("stop_arrival_ts", "stop_departure_ts", prefer="departure")
    )
    mapped = weather.attach_station(stops, _mapping(spark, folder))
    # An aggregate: staged, as the size check would otherwise compute it a second time.
    return weather.attach_weather(mapped, staged(_hourly_weather(spark, folder), "hourly"), **options)


WITH_WEATHER_SQL = f"""{roles.STOPS_SQL},
timed_stops AS (SELECT *, coalesce(dep, arr) AS stop_event_ts FROM stops),
mapping AS (SELECT 'S' || c_custkey AS station_code, c_custkey % 100 AS weather_station, abs(c_acctbal) AS km
            FROM customer WHERE c_acctbal >= 0),
readings AS (SELECT user_id % 100 AS w_station, CAST(ts AS DATE) AS w_date, hour(ts) AS w_hour,
                    max(value) AS "T", count(*) AS "FF" FROM events WHERE event_type = 'view' GROUP BY 1, 2, 3),
joined AS (SELECT s.*, weather_station, km, "T", "FF" FROM timed_stops s
  LEFT JOIN mapping ON station_code = stop_station_code
  LEFT JOIN readings ON w_station = weather_station AND w_date = CAST(stop_event_ts AS DATE) AND w_hour = hour(stop_event_ts))"""

WEATHER_ROWS_SQL = f"""
WITH {WITH_WEATHER_SQL}
SELECT stop_rdt_id, stop_station_code, strftime(stop_event_ts, '%Y-%m-%d %H:%M:%S') AS stop_event_ts,
       weather_station, km AS weather_station_distance_km, "T", "FF" FROM joined"""


def _weather_rows(df: DataFrame) -> DataFrame:
    return plain(df.select(
        "stop_rdt_id", "stop_station_code", "stop_event_ts",
        "weather_station", "weather_station_distance_km", "T", "FF",
    ))


@query(WEATHER_ROWS_SQL)
def weather_hourly_join(spark, folder):
    return _weather_rows(_with_weather(spark, folder))


@query(WEATHER_ROWS_SQL)
def weather_instant_join(spark, folder):
    return _weather_rows(_with_weather(spark, folder, by="instant"))


@query(WEATHER_ROWS_SQL)
def weather_join_salted(spark, folder):
    """The form for weather tables beyond the broadcast bound."""
    return _weather_rows(_with_weather(spark, folder, small_rows=0, hot_rows=1000))


@query(WEATHER_ROWS_SQL)
def weather_join_in_place(spark, folder):
    """Stops and readings written in buckets by station, day and hour; the join itself
    reads both in place."""
    when = F.col("stop_event_ts")
    stops = roles.stops(spark, folder).withColumn(
        "stop_event_ts", event_time("stop_arrival_ts", "stop_departure_ts", prefer="departure")
    )
    mapped = weather.attach_station(stops, _mapping(spark, folder)).select(
        "stop_rdt_id", "stop_station_code", "stop_event_ts", "weather_station", "weather_station_distance_km",
        F.to_date(when).alias("day"), F.hour(when).alias("hour"),
    )
    readings = _hourly_weather(spark, folder).select(
        F.col("weather_station").alias("w_station"), F.col("weather_date").alias("w_day"),
        F.col("weather_hour").alias("w_hour"), "T", "FF",
    )
    buckets = bucketed.buckets_for(spark, [f"{folder}/events.parquet"])
    left = bucketed.write_bucketed(mapped, scratch_dir(spark, "stops"), ["weather_station", "day", "hour"], buckets)
    right = bucketed.write_bucketed(readings, scratch_dir(spark, "readings"), ["w_station", "w_day", "w_hour"], buckets)
    return _weather_rows(bucketed.join_in_place(left, right))


@query("""
WITH returned AS (SELECT CAST(l_shipdate AS TIMESTAMP) AS ts, l_suppkey % 100 AS station FROM lineitem WHERE l_returnflag = 'R'),
readings AS (SELECT CAST(o_orderdate AS TIMESTAMP) AS r_ts, o_custkey % 100 AS r_station, sum(o_totalprice) AS "T" FROM orders GROUP BY 1, 2),
joined AS (SELECT * FROM returned LEFT JOIN readings ON r_station = station AND r_ts = ts)
SELECT strftime(ts, '%Y-%m') AS month, count(*) AS stops, count("T") AS with_weather, round(sum("T"), 2) AS total FROM joined GROUP BY 1""")
def weather_of_months(spark, folder):
    """Returned items as stops; of the readings, made from all orders and kept in month
    folders, only the months in which items were returned are read."""
    o = table(spark, folder, "orders")
    hourly = o.groupBy(F.pmod("o_custkey", F.lit(100)).alias("station"), F.col("o_orderdate").cast("timestamp").alias("time")).agg(
        F.sum("o_totalprice").alias("T")
    )
    out = scratch_dir(spark, "months")
    writers.write_monthly(hourly, out)
    stops = table(spark, folder, "lineitem").filter(F.col("l_returnflag") == "R").select(
        F.col("l_shipdate").cast("timestamp").alias("stop_event_ts"), F.pmod("l_suppkey", F.lit(100)).alias("weather_station")
    )
    readings = weather.of_months(readers.read_parquet(spark, out), stops, "stop_event_ts").select(
        F.col("station").alias("weather_station"), F.to_date("time").alias("weather_date"), F.hour("time").alias("weather_hour"), "T"
    )
    joined = weather.attach_weather(stops, staged(readings, "readings"))
    return joined.groupBy(F.date_format("stop_event_ts", "yyyy-MM").alias("month")).agg(
        F.count("*").alias("stops"), F.count("T").alias("with_weather"), F.round(F.sum("T"), 2).alias("total")
    )


@query(f"""
WITH {WITH_WEATHER_SQL},
c AS (SELECT count(*) AS total, count(*) FILTER (WHERE "T" IS NOT NULL OR "FF" IS NOT NULL) AS with_weather,
  count(*) FILTER (WHERE stop_event_ts IS NULL) AS without_time,
  count(*) FILTER (WHERE weather_station IS NULL) AS without_station,
  count(*) FILTER (WHERE "T" IS NULL AND "FF" IS NULL AND stop_event_ts IS NOT NULL AND weather_station IS NOT NULL) AS station_but_no_weather
  FROM joined)
SELECT *, round(100.0 * with_weather / total + 1.2345e-9, 6) AS pct_with_weather,
  round(100.0 * without_time / total + 1.2345e-9, 6) AS pct_without_time,
  round(100.0 * without_station / total + 1.2345e-9, 6) AS pct_without_station FROM c""")
def match_rate(spark, folder):
    rates = quality.match_rate(
        _with_weather(spark, folder), "stop_event_ts", "weather_station", WEATHER_EVIDENCE
    )
    return rounded(rates, "pct_with_weather", "pct_without_time", "pct_without_station")


@query(f"""
WITH {roles.STOPS_SQL}
SELECT count(*) AS before, count(coalesce(dep, arr)) AS after, count(*) - count(coalesce(dep, arr)) AS removed FROM stops""")
def removed_rows(spark, folder):
    stops = roles.stops(spark, folder)
    when = event_time("stop_arrival_ts", "stop_departure_ts", prefer="departure")
    return quality.removed_by(stops, when.isNotNull())


@query("""
SELECT user_id % 100 AS weather_station, CAST(CAST(ts AS DATE) AS VARCHAR) AS weather_date,
       CAST(hour(ts) AS INT) AS weather_hour, count(*) AS readings
FROM events WHERE event_type = 'view' GROUP BY 1, 2, 3 HAVING count(*) > 1""")
def repeated_weather_hours(spark, folder):
    e = table(spark, folder, "events").filter(F.col("event_type") == "view").select(
        F.pmod("user_id", F.lit(100)).alias("weather_station"),
        F.to_date("ts").alias("weather_date"), F.hour("ts").alias("weather_hour"),
    )
    return plain(quality.repeated_hours(e))


@query(f"""
WITH {WITH_WEATHER_SQL},
d AS (SELECT "T" AS x, coalesce(arr_delay, dep_delay, 0.0) AS y FROM joined WHERE "T" IS NOT NULL)
SELECT count(*) AS stops, round(corr(x, y), 8) AS correlation, round(regr_slope(y, x), 8) AS slope,
       round(corr(x, CASE WHEN y > 0 THEN 1.0 ELSE 0.0 END), 8) AS delayed_correlation FROM d""")
def weather_delay_corr(spark, folder):
    joined = _with_weather(spark, folder).withColumn(
        "delay", delay_minutes("stop_arrival_delay", "stop_departure_delay")
    )
    effect = rollup.weather_effect(joined, "T", "delay")
    return effect.withColumns({
        c: F.round(c, 8) for c in ("correlation", "slope", "delayed_correlation")
    })


@query(f"""
WITH {WITH_WEATHER_SQL},
d AS (SELECT "T" AS a, km AS b, coalesce(arr_delay, dep_delay, 0.0) AS y FROM joined WHERE "T" IS NOT NULL AND km IS NOT NULL),
c AS (SELECT count(*) AS n, avg(a) AS ma, avg(b) AS mb, avg(y) AS my, var_pop(a) AS aa, var_pop(b) AS bb, covar_pop(a, b) AS ab,
        covar_pop(a, y) AS ay, covar_pop(b, y) AS b_y, var_pop(y) AS yy FROM d),
s AS (SELECT *, (ay * bb - b_y * ab) / (aa * bb - ab * ab) AS ka, (b_y * aa - ay * ab) / (aa * bb - ab * ab) AS kb FROM c)
SELECT 'T' AS term, round(ka, 8) AS coefficient, n AS stops, round((ka * ay + kb * b_y) / yy, 8) AS explained FROM s
UNION ALL SELECT 'weather_station_distance_km', round(kb, 8), n, round((ka * ay + kb * b_y) / yy, 8) FROM s
UNION ALL SELECT '(intercept)', round(my - ka * ma - kb * mb, 8), n, round((ka * ay + kb * b_y) / yy, 8) FROM s""")
def weather_delay_model(spark, folder):
    """Temperature and distance together, where each alone could take credit for the other."""
    joined = _with_weather(spark, folder).withColumn(
        "delay", delay_minutes("stop_arrival_delay", "stop_departure_delay")
    )
    model = rollup.weather_model(joined, ["T", "weather_station_distance_km"], "delay")
    return model.withColumns({c: F.round(c, 8) for c in ("coefficient", "explained")})


@query(f"""
WITH {WITH_WEATHER_SQL},
d AS (SELECT CAST(floor("T" / 25) AS BIGINT) AS band, coalesce(arr_delay, dep_delay, 0.0) AS y FROM joined)
SELECT band, count(*) AS stops, count(*) FILTER (WHERE y > 0) AS delayed,
       round(count(*) FILTER (WHERE y > 0) / count(*) + 1.2345e-9, 6) AS pct_delayed,
       round(avg(y) + 1.2345e-9, 6) AS avg_delay FROM d GROUP BY band""")
def weather_delay_bands(spark, folder):
    joined = _with_weather(spark, folder).withColumn(
        "delay", delay_minutes("stop_arrival_delay", "stop_departure_delay")
    )
    return rounded(rollup.delay_by_weather(joined, "T", "delay", 25.0), "pct_delayed", "avg_delay")


# --- dimension joins, one row per key, missing keys --------------------------------


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, s_name, n_name FROM lineitem
LEFT JOIN supplier ON s_suppkey = l_suppkey AND s_acctbal >= 0 LEFT JOIN nation ON n_nationkey = s_nationkey""")
def broadcast_dim_join(spark, folder):
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    s = table(spark, folder, "supplier").filter(F.col("s_acctbal") >= 0)
    n = table(spark, folder, "nation").select("n_nationkey", "n_name")
    wide = keyed_join(lines, s.select("s_suppkey", "s_name", "s_nationkey"), [("l_suppkey", "s_suppkey")])
    wide = keyed_join(wide, n, [("s_nationkey", "n_nationkey")])
    return wide.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "s_name", "n_name")


def _keyed_documents(spark, folder) -> DataFrame:
    """documents without, labels with coordinates, under one code."""
    docs = table(spark, folder, "documents").select(
        F.col("doc_id").alias("code"), F.lit(None).cast("double").alias("geo_lat"),
        F.lit(None).cast("double").alias("geo_lng"), F.col("lang").alias("country"),
    )
    labels = table(spark, folder, "labels").select(
        F.lit("labels").alias("country"), F.col("doc_id").alias("code"),
        F.col("quality").cast("double").alias("geo_lat"), F.col("toxic").cast("double").alias("geo_lng"),
    )
    return docs.unionByName(labels)


KEYED_SQL = """keyed AS (
  SELECT doc_id AS code, CAST(NULL AS DOUBLE) AS geo_lat, CAST(NULL AS DOUBLE) AS geo_lng, lang AS country FROM documents
  UNION ALL SELECT doc_id, CAST(quality AS DOUBLE), CAST(toxic AS DOUBLE), 'labels' FROM labels)"""


@query(f"""
WITH {KEYED_SQL}
SELECT code, geo_lat, geo_lng, country FROM (SELECT *, row_number() OVER (PARTITION BY code
  ORDER BY geo_lat IS NOT NULL AND geo_lng IS NOT NULL DESC, geo_lat NULLS LAST, geo_lng NULLS LAST, country NULLS LAST) AS place FROM keyed)
WHERE place = 1""")
def consolidate_keys(spark, folder):
    return prefer_located(_keyed_documents(spark, folder), "code", "geo_lat", "geo_lng")


@query(f"""
WITH {KEYED_SQL}
SELECT country, count(*) AS count FROM keyed WHERE geo_lat IS NULL OR geo_lng IS NULL GROUP BY country
UNION ALL SELECT 'located', count(*) FROM keyed WHERE geo_lat IS NOT NULL AND geo_lng IS NOT NULL""")
def located_or_not(spark, folder):
    keyed = _keyed_documents(spark, folder)
    missing = keyed.filter(any_missing("geo_lat", "geo_lng")).groupBy("country").count()
    located = keyed.filter(all_present("geo_lat", "geo_lng")).agg(F.count("*").alias("count"))
    return missing.unionByName(located.select(F.lit("located").alias("country"), "count"))


@query("""
SELECT doc_id, lang, source FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""")
def anti_join_missing(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "lang", "source")
    return missing_from(docs, table(spark, folder, "labels"), ["doc_id"])


@query("""
SELECT user_id, event_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id
  ORDER BY value DESC, event_id) AS place FROM events) WHERE place = 1""")
def keep_one_per_key(spark, folder):
    e = table(spark, folder, "events").select("user_id", "event_id", "event_type", "value")
    return keep_one(e, ["user_id"], [F.col("value").desc()])


@query("""
SELECT weather_station, stationname, weather_lat, weather_lng FROM (
  SELECT *, row_number() OVER (PARTITION BY weather_station ORDER BY stationname, weather_lat, weather_lng) AS place FROM (
    SELECT l_suppkey AS weather_station, l_returnflag AS stationname,
      CASE WHEN l_linenumber > 1 THEN CAST(l_suppkey % 11 AS DOUBLE) END AS weather_lat,
      CASE WHEN l_quantity > 5 THEN CAST(l_suppkey % 13 AS DOUBLE) END AS weather_lng FROM lineitem)
  WHERE weather_lat IS NOT NULL AND weather_lng IS NOT NULL) WHERE place = 1""")
def weather_station_list(spark, folder):
    """Line items as readings, some without coordinates: one located row per station."""
    readings = table(spark, folder, "lineitem").select(
        F.col("l_suppkey").alias("weather_station"), F.col("l_returnflag").alias("stationname"),
        F.when(F.col("l_linenumber") > 1, F.pmod("l_suppkey", F.lit(11)).cast("double")).alias("weather_lat"),
        F.when(F.col("l_quantity") > 5, F.pmod("l_suppkey", F.lit(13)).cast("double")).alias("weather_lng"),
    )
    return weather.weather_stations(readings)


@query(f"""
WITH {KEYED_SQL}
SELECT count(*) AS rows, count(DISTINCT code) AS keys,
       count(*) FILTER (WHERE geo_lat IS NULL OR geo_lng IS NULL) AS missing_coordinates FROM keyed""")
def distinct_key_stats(spark, folder):
    return quality.key_stats(_keyed_documents(spark, folder), "code", "geo_lat", "geo_lng")


COUNT_SQL = """
SELECT n_name, count(*) AS count FROM customer JOIN nation ON n_nationkey = c_nationkey
GROUP BY n_name ORDER BY count DESC, n_name"""


def _nations_of_customers(spark, folder):
    n = table(spark, folder, "nation").select("n_nationkey", "n_name")
    customers = table(spark, folder, "customer").select("c_nationkey")
    return keyed_join(customers, n, [("c_nationkey", "n_nationkey")], how="inner")


@query(COUNT_SQL)
def count_by_group_desc(spark, folder):
    return quality.count_by(_nations_of_customers(spark, folder), "n_name")


@query(COUNT_SQL + " LIMIT 20")
def count_by_group_top(spark, folder):
    """The twenty most frequent values, as a report shows them."""
    return quality.count_by(_nations_of_customers(spark, folder), "n_name", 20)
