"""Test tables in the roles of the railway tables, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from spoorlens.workload.registry import table


def stops(spark: SparkSession, folder: str) -> DataFrame:
    """events as stop events: missing times and delays follow from type and value."""
    e = table(spark, folder, "events")
    kind, value = F.col("event_type"), F.col("value")
    return e.select(
        F.col("event_id").alias("stop_rdt_id"),
        F.col("user_id").alias("service_rdt_id"),
        F.col("event_type").alias("service_type"),
        F.concat(F.lit("S"), F.col("user_id").cast("string")).alias("stop_station_code"),
        (kind == "error").alias("service_completely_cancelled"),
        F.when(kind != "view", kind == "signup").alias("service_partly_cancelled"),
        F.when(kind != "click", F.col("ts")).alias("stop_arrival_ts"),
        F.when(value < 100, F.col("ts") + F.expr("INTERVAL 5 MINUTES")).alias("stop_departure_ts"),
        F.when(kind == "view", 0.0).when(kind != "purchase", value / 20 - 1).alias("stop_arrival_delay"),
        F.when(value <= 200, value / 25).alias("stop_departure_delay"),
    )


STOPS_SQL = """
stops AS (
  SELECT event_id AS stop_rdt_id, user_id AS service_rdt_id, event_type AS service_type,
         'S' || user_id AS stop_station_code,
         event_type = 'error' AS cc,
         CASE WHEN event_type <> 'view' THEN event_type = 'signup' END AS pc,
         CASE WHEN event_type <> 'click' THEN ts END AS arr,
         CASE WHEN value < 100 THEN ts + INTERVAL 5 MINUTE END AS dep,
         CASE WHEN event_type = 'view' THEN 0.0 WHEN event_type <> 'purchase' THEN value / 20 - 1 END AS arr_delay,
         CASE WHEN value <= 200 THEN value / 25 END AS dep_delay
  FROM events)"""

TIMED_SQL = STOPS_SQL + """,
timed AS (
  SELECT CAST(coalesce(arr, dep) AS DATE) AS service_date,
         CAST(hour(coalesce(arr, dep)) AS INT) AS hour,
         service_rdt_id, service_type, cc, pc,
         CAST(coalesce(arr_delay, dep_delay, 0.0) AS DOUBLE) AS delay
  FROM stops WHERE coalesce(arr, dep) IS NOT NULL)"""


def service_hours_sql(by: str = "") -> str:
    return f"""
per_service AS (
  SELECT {by} service_date, hour, service_rdt_id,
         max(CAST(cc AS INT)) AS svc_cc, max(CAST(pc AS INT)) AS svc_pc,
         max(delay) AS svc_max, avg(delay) AS svc_avg
  FROM timed GROUP BY {by} service_date, hour, service_rdt_id)"""


COUNTS_SQL = """
  CAST(count(service_rdt_id) AS BIGINT) AS services_in_hour,
  CAST(sum(svc_cc) AS BIGINT) AS completely_cancelled,
  CAST(sum(CASE WHEN svc_cc = 1 THEN 0 ELSE svc_pc END) AS BIGINT) AS partly_cancelled,
  count(*) FILTER (WHERE svc_max > 0) AS delayed_count,
  count(*) FILTER (WHERE svc_max = 0) AS on_time_count,
  count(*) FILTER (WHERE svc_max > 0 AND svc_max < 3) AS short_delay_count,
  count(*) FILTER (WHERE svc_max > 10) AS long_delay_count,
  round(avg(svc_avg) + 1.2345e-9, 6) AS avg_avg_delay_all_services,
  round(avg(svc_avg) FILTER (WHERE svc_avg > 0) + 1.2345e-9, 6) AS avg_avg_delay_delays_only"""


def season_sql(day: str) -> str:
    mmdd = f"(month({day}) * 100 + day({day}))"
    return (
        f"CASE WHEN {mmdd} >= 1221 OR {mmdd} <= 319 THEN 'winter' "
        f"WHEN {mmdd} BETWEEN 320 AND 620 THEN 'spring' "
        f"WHEN {mmdd} BETWEEN 621 AND 922 THEN 'summer' ELSE 'autumn' END"
    )


def years_of(df: DataFrame, time: str) -> DataFrame:
    return df.select(F.year(time).alias("year")).distinct()


def vacations_sql(years: str) -> str:
    """Vacation days for a relation ``years`` with a column y."""
    week = lambda d: f"CAST(date_trunc('week', {d}) AS DATE)"
    weekly = "\n".join(
        f"UNION ALL SELECT '{n} vacation', {week(f'make_date(y, {m}, {d})')}, {week(f'make_date(y, {m}, {d})')} + 6 FROM {years}"
        for n, m, d in [("Spring", 2, 15), ("Autumn", 10, 15), ("May", 4, 27)]
    )
    return f"""
vacations AS (
  SELECT CAST(unnest(generate_series(CAST(f AS TIMESTAMP), CAST(l AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS event_date,
         name, 'Vacation' AS category
  FROM (SELECT 'Summer vacation' AS name, make_date(y, 7, 15) AS f, make_date(y, 8, 25) AS l FROM {years}
        UNION ALL SELECT 'Christmas vacation', make_date(y, 12, 24), make_date(y + 1, 1, 4) FROM {years}
        {weekly}))"""


def station_position(key: Column) -> tuple[Column, Column]:
    return 50 + F.pmod(key, F.lit(37)) * 0.1, 4 + F.pmod(key, F.lit(53)) * 0.05


def weather_position(key: Column) -> tuple[Column, Column]:
    return 50 + F.pmod(key, F.lit(11)) * 0.33, 4 + F.pmod(key, F.lit(13)) * 0.21


def train_stations(spark: SparkSession, folder: str) -> DataFrame:
    c = table(spark, folder, "customer")
    lat, lng = station_position(F.col("c_custkey"))
    return c.select(
        F.concat(F.lit("S"), F.col("c_custkey").cast("string")).alias("station_code"),
        lat.alias("station_lat"), lng.alias("station_lng"),
    )


def weather_sites(spark: SparkSession, folder: str) -> DataFrame:
    s = table(spark, folder, "supplier")
    lat, lng = weather_position(F.col("s_suppkey"))
    return s.select(
        F.col("s_suppkey").alias("weather_station"), F.col("s_name").alias("stationname"),
        lat.alias("weather_lat"), lng.alias("weather_lng"),
    )


PLACES_SQL = """
trains AS (SELECT 'S' || c_custkey AS station_code, 50 + (c_custkey % 37) * CAST(0.1 AS DOUBLE) AS station_lat,
                  4 + (c_custkey % 53) * CAST(0.05 AS DOUBLE) AS station_lng FROM customer),
sites AS (SELECT s_suppkey AS weather_station, s_name AS stationname, 50 + (s_suppkey % 11) * CAST(0.33 AS DOUBLE) AS weather_lat,
                 4 + (s_suppkey % 13) * CAST(0.21 AS DOUBLE) AS weather_lng FROM supplier)"""

KM_SQL = """2 * 6371.0 * atan2(sqrt(sin(radians(weather_lat - station_lat) / 2) ** 2
    + cos(radians(station_lat)) * cos(radians(weather_lat)) * sin(radians(weather_lng - station_lng) / 2) ** 2),
  sqrt(1 - (sin(radians(weather_lat - station_lat) / 2) ** 2
    + cos(radians(station_lat)) * cos(radians(weather_lat)) * sin(radians(weather_lng - station_lng) / 2) ** 2)))"""


def grouping_set_sql(base: str, dimensions: list[str], chosen: list[str]) -> str:
    """One grouping from its definition: service hours of its own, then their counts."""
    by = "".join(f"{c}, " for c in chosen)
    number = sum(1 << (len(dimensions) - 1 - i) for i, c in enumerate(dimensions) if c not in chosen)
    kinds = {"service_type": "VARCHAR", "service_company": "VARCHAR", "season": "VARCHAR"}
    columns = ", ".join(c if c in chosen else f"CAST(NULL AS {kinds.get(c, 'INT')}) AS {c}" for c in dimensions)
    hours = service_hours_sql(by.replace("hour, ", "")).replace("FROM timed", f"FROM {base}").strip()
    inner = hours[hours.index("(") + 1:-1]
    grouped = f"GROUP BY {', '.join(chosen)}" if chosen else ""
    return f"SELECT {number} AS grouping_id, {columns}, {COUNTS_SQL} FROM ({inner}) {grouped}"


def grouping_sets_sql(base: str, dimensions: list[str], sets: list[list[str]]) -> str:
    return " UNION ALL ".join(grouping_set_sql(base, dimensions, s) for s in sets)
