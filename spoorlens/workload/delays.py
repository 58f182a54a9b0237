"""Delay statistics, times, calendars and intervals."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from spoorlens.functions.values import (
    event_time, is_long_delay, is_month, is_short_delay, season,
)
from spoorlens.operators import calendar, intervals, rollup, states
from spoorlens.operators.intervals import Intervals, Points
from spoorlens.operators.keep_one import append_missing
from spoorlens.operators.skew import keyed_join
from spoorlens.schemas import CALENDAR_COLUMNS, REPORT_COLUMNS
from spoorlens.session import scratch_dir, staged
from spoorlens.workload import roles
from spoorlens.workload.registry import plain, query, r6, rounded, table

# A feed with one entry, which the yearly repetition takes to every later year.
NEW_YEAR_FEED = """BEGIN:VCALENDAR
BEGIN:VEVENT
DTSTART;VALUE=DATE:20190101
SUMMARY:Nieuwjaarsdag (New Year's Day)
END:VEVENT
END:VCALENDAR
"""
LAST_FEED_YEAR = 2030

REPORT_DOUBLES = [
    "hour_share_of_day", *rollup.SHARES, "avg_avg_delay_all_services", "avg_avg_delay_delays_only",
]


def _report_calendar(spark, stops: DataFrame) -> DataFrame:
    feed = spark.createDataFrame([(NEW_YEAR_FEED,)], "text string")
    events = calendar.events_in_text(feed, "text", [F.lit("")])
    years = roles.years_of(stops, "stop_arrival_ts")
    return staged(calendar.full_calendar(events, years, LAST_FEED_YEAR), "calendar")


REPORT_SQL = f"""
WITH {roles.TIMED_SQL}, {roles.service_hours_sql()},
hourly AS (SELECT service_date, hour, {roles.COUNTS_SQL} FROM per_service GROUP BY service_date, hour),
daily AS (SELECT service_date, count(DISTINCT service_rdt_id) AS services_in_day FROM per_service GROUP BY service_date),
years AS (SELECT DISTINCT CAST(year(arr) AS INT) AS y FROM stops WHERE arr IS NOT NULL),
{roles.vacations_sql('years')},
holidays AS (
  SELECT make_date(CAST(g AS INT), 1, 1) AS event_date, 'New Year''s Day' AS name, 'Holiday' AS category
  FROM generate_series(2019, 2030) t(g)
  UNION ALL SELECT * FROM vacations)
SELECT {roles.season_sql('service_date')} AS season, CAST(service_date AS VARCHAR) AS service_date, hour,
  round(services_in_hour / services_in_day + 1.2345e-9, 6) AS hour_share_of_day,
  round(completely_cancelled / services_in_hour + 1.2345e-9, 6) AS pct_completely_cancelled,
  round(partly_cancelled / services_in_hour + 1.2345e-9, 6) AS pct_partly_cancelled,
  round(delayed_count / services_in_hour + 1.2345e-9, 6) AS pct_delayed,
  round(on_time_count / services_in_hour + 1.2345e-9, 6) AS pct_on_time,
  round(short_delay_count / services_in_hour + 1.2345e-9, 6) AS pct_short_delay,
  round(long_delay_count / services_in_hour + 1.2345e-9, 6) AS pct_long_delay,
  avg_avg_delay_all_services, avg_avg_delay_delays_only, services_in_hour, services_in_day,
  completely_cancelled, partly_cancelled, delayed_count, on_time_count, short_delay_count, long_delay_count,
  coalesce(h.name, 'No holiday') AS holiday_name, coalesce(h.category, 'No holiday') AS holiday_category
FROM hourly JOIN daily USING (service_date) LEFT JOIN holidays h ON h.event_date = service_date"""


@query(REPORT_SQL)
def hourly_delay_report(spark, folder):
    return _report(spark, folder, roles.stops(spark, folder), ())


# Every other service a month later, and the first month left out.
@query(REPORT_SQL.replace(roles.service_hours_sql(), """
moved AS (SELECT * REPLACE (CAST(service_date + CASE WHEN service_rdt_id % 2 = 1 THEN 31 ELSE 0 END AS DATE) AS service_date) FROM timed)
,""" + roles.service_hours_sql().replace("FROM timed", "FROM moved WHERE NOT (year(service_date) = 2024 AND month(service_date) = 1)")))
def hourly_delay_report_without_month(spark, folder):
    stops = roles.stops(spark, folder)
    later = F.make_dt_interval(F.when(F.col("service_rdt_id") % 2 == 1, 31).otherwise(0))
    times = {c: F.col(c) + later for c in ("stop_arrival_ts", "stop_departure_ts")}
    return _report(spark, folder, stops.withColumns(times), [(2024, 1)])


def _report(spark, folder, stops: DataFrame, skip_months) -> DataFrame:
    per_service = rollup.service_hours(rollup.timed_stops(stops, skip_months))
    report = rollup.hourly_report(staged(per_service, "service-hours"))
    full = rollup.attach_holidays(report, _report_calendar(spark, stops)).select(*REPORT_COLUMNS)
    return plain(rounded(full, *REPORT_DOUBLES))


@query(f"""
WITH {roles.STOPS_SQL}
SELECT stop_rdt_id, strftime(coalesce(dep, arr), '%Y-%m-%d %H:%M:%S') AS departure_first,
       strftime(coalesce(arr, dep), '%Y-%m-%d %H:%M:%S') AS arrival_first
FROM stops WHERE coalesce(arr, dep) IS NOT NULL""")
def event_time_precedence(spark, folder):
    times = roles.stops(spark, folder).select(
        "stop_rdt_id",
        event_time("stop_arrival_ts", "stop_departure_ts", prefer="departure").alias("departure_first"),
        event_time("stop_arrival_ts", "stop_departure_ts", prefer="arrival").alias("arrival_first"),
    )
    return plain(times.filter(F.col("arrival_first").isNotNull()))


@query(f"""
WITH {roles.TIMED_SQL}, {roles.service_hours_sql()}
SELECT CAST(service_date AS VARCHAR) AS day, hour, service_rdt_id AS service,
       svc_cc AS cancelled, svc_pc AS part_cancelled,
       round(svc_max + 1.2345e-9, 6) AS worst_delay, round(svc_avg + 1.2345e-9, 6) AS mean_delay
FROM per_service""")
def service_hour_rollup(spark, folder):
    per_service = rollup.service_hours(rollup.timed_stops(roles.stops(spark, folder)))
    shown = per_service.withColumn("mean_delay", rollup.mean_delay()).drop("delay_sum", "delay_n")
    return plain(rounded(shown, "worst_delay", "mean_delay"))


@query(f"""
WITH {roles.TIMED_SQL}
SELECT CAST(service_date AS VARCHAR) AS service_date, count(DISTINCT service_rdt_id) AS services_in_day
FROM timed GROUP BY service_date""")
def daily_service_totals(spark, folder):
    days = rollup.services_per_day(rollup.timed_stops(roles.stops(spark, folder)))
    return plain(days.withColumnRenamed("day", "service_date"))


@query(f"""
WITH {roles.TIMED_SQL}
SELECT service_type, count(*) FILTER (WHERE delay > 0 AND delay < 3) AS short_stops,
       count(*) FILTER (WHERE delay > 10) AS long_stops, count(*) FILTER (WHERE delay > 0) AS delayed_stops,
       count(*) FILTER (WHERE delay = 0) AS on_time_stops, count(*) FILTER (WHERE delay < 0) AS early_stops
FROM timed GROUP BY service_type""")
def delay_class_counts(spark, folder):
    stops = rollup.timed_stops(roles.stops(spark, folder), also=["service_type"])
    d = F.col("delay")
    return stops.groupBy("service_type").agg(
        F.count_if(is_short_delay(d)).alias("short_stops"),
        F.count_if(is_long_delay(d)).alias("long_stops"),
        F.count_if(d > 0).alias("delayed_stops"),
        F.count_if(d == 0).alias("on_time_stops"),
        F.count_if(d < 0).alias("early_stops"),
    )


@query(f"""
SELECT {roles.season_sql('o_orderdate')} AS season, CAST(year(o_orderdate) AS INT) AS year, count(*) AS orders
FROM orders GROUP BY 1, 2""")
def season_counts(spark, folder):
    o = table(spark, folder, "orders")
    return o.groupBy(season("o_orderdate").alias("season"), F.year("o_orderdate").alias("year")).agg(
        F.count("*").alias("orders")
    )


@query("""
SELECT CAST(year(o_orderdate) AS INT) AS year, CAST(month(o_orderdate) AS INT) AS month,
       count(*) AS orders, round(sum(o_totalprice), 2) AS total
FROM orders WHERE NOT (year(o_orderdate) = 1997 AND month(o_orderdate) = 12) GROUP BY 1, 2""")
def exclude_month(spark, folder):
    o = table(spark, folder, "orders").filter(~is_month("o_orderdate", 1997, 12))
    return o.groupBy(F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month")).agg(
        F.count("*").alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("total")
    )


EVENT = Points("user_id", "ts")
OUTAGE = Intervals("d_user", "d_start", "d_end")


def _outages(spark, folder) -> DataFrame:
    """Each error event disrupts its user for six hours; the largest have no end."""
    e = table(spark, folder, "events").filter(F.col("event_type") == "error")
    return e.select(
        F.col("event_id").alias("d_id"), F.col("user_id").alias("d_user"), F.col("ts").alias("d_start"),
        F.when(F.col("value") <= 200, F.col("ts") + F.expr("INTERVAL 6 HOURS")).alias("d_end"),
    )


OUTAGES_SQL = """outages AS (
  SELECT event_id AS d_id, user_id AS d_user, ts AS d_start,
         CASE WHEN value <= 200 THEN ts + INTERVAL 6 HOUR END AS d_end
  FROM events WHERE event_type = 'error')"""

INTERVAL_SQL = f"""
WITH {OUTAGES_SQL}
SELECT event_id, user_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, d_id,
       strftime(d_start, '%Y-%m-%d %H:%M:%S') AS d_start, strftime(d_end, '%Y-%m-%d %H:%M:%S') AS d_end
FROM events LEFT JOIN outages ON user_id = d_user AND ts >= d_start AND ts <= d_end"""


def _event_outages(spark, folder, **options):
    e = table(spark, folder, "events").select("event_id", "user_id", "ts")
    joined = intervals.interval_join(e, EVENT, _outages(spark, folder), OUTAGE, **options)
    return plain(joined.drop("d_user"))


@query(INTERVAL_SQL)
def interval_join(spark, folder):
    return _event_outages(spark, folder)


@query(INTERVAL_SQL)
def interval_join_bucketed(spark, folder):
    return _event_outages(spark, folder, bucket_seconds=6 * 3600)


@query(INTERVAL_SQL)
def interval_join_salted(spark, folder):
    """The form for intervals beyond the broadcast bound."""
    return _event_outages(spark, folder, bucket_seconds=6 * 3600, small_rows=0, hot_rows=1000)


@query(f"""
WITH {OUTAGES_SQL}
SELECT event_id, count(d_start) AS active_count, strftime(min(d_start), '%Y-%m-%d %H:%M:%S') AS first_start
FROM events LEFT JOIN outages ON user_id = d_user AND ts >= d_start AND ts <= d_end GROUP BY event_id""")
def interval_active_counts(spark, folder):
    e = table(spark, folder, "events")
    return plain(intervals.active_counts(e, EVENT, "event_id", _outages(spark, folder), OUTAGE))


@query(f"""
WITH years AS (SELECT DISTINCT CAST(year(o_orderdate) AS INT) AS y FROM orders), {roles.vacations_sql('years')},
per_day AS (SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS n FROM orders GROUP BY 1)
SELECT CAST(event_date AS VARCHAR) AS event_date, name, category, coalesce(n, 0) AS orders
FROM vacations LEFT JOIN per_day ON d = event_date""")
def school_vacations(spark, folder):
    """Vacation days of the years of the orders, with the orders of each day."""
    o = table(spark, folder, "orders")
    days = calendar.school_vacations(roles.years_of(o, "o_orderdate"))
    per_day = o.groupBy(F.to_date("o_orderdate").alias("_d")).agg(F.count("*").alias("orders"))
    joined = keyed_join(days, staged(per_day, "per-day"), [("event_date", "_d")]).drop("_d")
    return plain(joined.withColumn("orders", F.coalesce("orders", F.lit(0))))


def _named_orders(spark, folder) -> DataFrame:
    o = table(spark, folder, "orders")
    return o.select(
        F.to_date("o_orderdate").alias("event_date"),
        F.when(F.col("o_orderpriority") == "5-LOW", "").otherwise(
            F.concat_ws("-", F.lit("N"), F.col("o_custkey").cast("string"), "o_orderpriority")
        ).alias("name"),
        F.col("o_orderstatus").alias("category"),
        F.col("o_orderkey").alias("seq"),
    )


NAMED_ORDERS_SQL = """named AS (
  SELECT CAST(o_orderdate AS DATE) AS event_date,
         CASE WHEN o_orderpriority = '5-LOW' THEN '' ELSE 'N-' || o_custkey || '-' || o_orderpriority END AS name,
         o_orderstatus AS category, o_orderkey AS seq FROM orders)"""

REPEAT_SQL = """singles AS (
  SELECT name, min(event_date) AS only_date, arg_min(category, seq) AS category
  FROM {base} GROUP BY name HAVING count(DISTINCT event_date) = 1),
repeats AS (
  SELECT TRY_CAST(g || strftime(only_date, '-%m-%d') AS DATE) AS event_date, name, category
  FROM singles, generate_series(1990, {last}) t(g) WHERE g > year(only_date) AND name <> '')"""


@query(f"""
WITH {NAMED_ORDERS_SQL}, {REPEAT_SQL.format(base='named', last=2005)}
SELECT name, CAST(only_date AS VARCHAR) AS only_date, category FROM singles""")
def singleton_names(spark, folder):
    return plain(calendar.singleton_names(_named_orders(spark, folder)))


@query(f"""
WITH {NAMED_ORDERS_SQL}, {REPEAT_SQL.format(base='named', last=2005)}
SELECT CAST(event_date AS VARCHAR) AS event_date, name, category FROM named
UNION ALL SELECT CAST(event_date AS VARCHAR), name, category FROM repeats WHERE event_date IS NOT NULL""")
def singleton_expand(spark, folder):
    return plain(calendar.repeat_yearly(_named_orders(spark, folder), 2005))


@query("""
WITH base AS (SELECT CAST(o_orderdate AS DATE) AS event_date, o_orderpriority AS name,
                     CASE WHEN o_custkey >= 100 THEN 'Holiday' END AS category, o_orderstatus FROM orders),
old AS (SELECT event_date, name, category FROM base WHERE o_orderstatus = 'F'),
new AS (SELECT DISTINCT event_date, name, category FROM base WHERE o_orderstatus <> 'F')
SELECT CAST(event_date AS VARCHAR) AS event_date, name, category FROM old
UNION ALL SELECT CAST(event_date AS VARCHAR), name, category FROM new
WHERE NOT EXISTS (SELECT 1 FROM old WHERE old.event_date IS NOT DISTINCT FROM new.event_date
  AND old.name IS NOT DISTINCT FROM new.name AND old.category IS NOT DISTINCT FROM new.category)""")
def append_missing_rows(spark, folder):
    o = table(spark, folder, "orders")
    rows = o.select(
        F.to_date("o_orderdate").alias("event_date"),
        F.col("o_orderpriority").alias("name"),
        F.when(F.col("o_custkey") >= 100, "Holiday").alias("category"),
        "o_orderstatus",
    )
    finished = F.col("o_orderstatus") == "F"
    return plain(append_missing(rows.filter(finished), rows.filter(~finished), CALENDAR_COLUMNS))


def _busy_days(spark, folder) -> tuple[DataFrame, DataFrame]:
    """Orders per day, and a calendar of vacations and of days with a very large order."""
    o = table(spark, folder, "orders")
    days = o.groupBy(F.to_date("o_orderdate").alias("service_date")).agg(F.count("*").alias("orders"))
    large = o.filter(F.col("o_totalprice") > 490000).select(
        F.to_date("o_orderdate").alias("event_date"),
        F.lit("Large order").alias("name"), F.lit("Holiday").alias("category"),
    ).distinct()
    return days, large.unionByName(calendar.school_vacations(roles.years_of(o, "o_orderdate")))


BUSY_SQL = f"""
days AS (SELECT CAST(o_orderdate AS DATE) AS service_date, count(*) AS orders FROM orders GROUP BY 1),
years AS (SELECT DISTINCT CAST(year(o_orderdate) AS INT) AS y FROM orders), {roles.vacations_sql('years')},
cal AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS event_date, 'Large order' AS name, 'Holiday' AS category
        FROM orders WHERE o_totalprice > 490000 UNION ALL SELECT * FROM vacations)"""


@query(f"""
WITH {BUSY_SQL}
SELECT CAST(service_date AS VARCHAR) AS service_date, orders,
       coalesce(name, 'No holiday') AS holiday_name, coalesce(category, 'No holiday') AS holiday_category
FROM days LEFT JOIN cal ON event_date = service_date""")
def holiday_attach(spark, folder):
    days, cal = _busy_days(spark, folder)
    return plain(rollup.attach_holidays(days, cal))


@query(f"""
WITH {BUSY_SQL},
one AS (SELECT event_date, string_agg(DISTINCT name, '; ' ORDER BY name) AS name,
               string_agg(DISTINCT category, '; ' ORDER BY category) AS category FROM cal GROUP BY event_date)
SELECT CAST(service_date AS VARCHAR) AS service_date, orders,
       coalesce(name, 'No holiday') AS holiday_name, coalesce(category, 'No holiday') AS holiday_category
FROM days LEFT JOIN one ON event_date = service_date""")
def holiday_attach_collapsed(spark, folder):
    days, cal = _busy_days(spark, folder)
    return plain(rollup.attach_holidays(days, cal, collapse=True))


def _stops_with_customer(spark, folder) -> DataFrame:
    c = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("_cust"),
        F.col("c_mktsegment").alias("service_company"),
        F.col("c_nationkey").alias("station_country"),
    )
    return keyed_join(roles.stops(spark, folder), c, [("service_rdt_id", "_cust")]).drop("_cust")


DIMENSIONS = ["service_type", "service_company", "station_country"]
DIMENSION_SETS = [*([d] for d in DIMENSIONS), DIMENSIONS[:2], []]
TIME_DIMENSIONS = ["hour", "season", "year"]
TIME_SETS = [["hour"], ["season"], ["year"], ["season", "hour"], []]


@query(f"""
WITH {roles.TIMED_SQL},
wide AS (SELECT timed.*, c_mktsegment AS service_company, c_nationkey AS station_country
         FROM timed LEFT JOIN customer ON c_custkey = service_rdt_id)
{roles.grouping_sets_sql('wide', DIMENSIONS, DIMENSION_SETS)}""")
def delay_by_dimension(spark, folder):
    stops = rollup.timed_stops(_stops_with_customer(spark, folder), also=DIMENSIONS)
    counts = rollup.delay_grouping_sets(rollup.service_hours(stops, by=DIMENSIONS), DIMENSION_SETS)
    return rounded(counts, "avg_avg_delay_all_services", "avg_avg_delay_delays_only")


@query(f"""
WITH {roles.TIMED_SQL},
dated AS (SELECT *, {roles.season_sql('service_date')} AS season, CAST(year(service_date) AS INT) AS year FROM timed)
{roles.grouping_sets_sql('dated', TIME_DIMENSIONS, TIME_SETS)}""")
def delay_by_time(spark, folder):
    per_service = rollup.service_hours(rollup.timed_stops(roles.stops(spark, folder))).withColumns(
        {"season": season("day"), "year": F.year("day")}
    )
    counts = rollup.delay_grouping_sets(per_service, TIME_SETS)
    return rounded(counts, "avg_avg_delay_all_services", "avg_avg_delay_delays_only")


@query(f"""
WITH {roles.TIMED_SQL}, {roles.service_hours_sql('service_type,')}
SELECT service_type, {roles.COUNTS_SQL},
  round(sum(svc_cc) / count(service_rdt_id) + 1.2345e-9, 6) AS pct_completely_cancelled,
  round(sum(CASE WHEN svc_cc = 1 THEN 0 ELSE svc_pc END) / count(service_rdt_id) + 1.2345e-9, 6) AS pct_partly_cancelled,
  round(count(*) FILTER (WHERE svc_max > 0) / count(service_rdt_id) + 1.2345e-9, 6) AS pct_delayed,
  round(count(*) FILTER (WHERE svc_max = 0) / count(service_rdt_id) + 1.2345e-9, 6) AS pct_on_time,
  round(count(*) FILTER (WHERE svc_max > 0 AND svc_max < 3) / count(service_rdt_id) + 1.2345e-9, 6) AS pct_short_delay,
  round(count(*) FILTER (WHERE svc_max > 10) / count(service_rdt_id) + 1.2345e-9, 6) AS pct_long_delay
FROM per_service GROUP BY service_type""")
def delay_by_type(spark, folder):
    stops = rollup.timed_stops(roles.stops(spark, folder), also=["service_type"])
    return rounded(
        rollup.delay_by(stops, ["service_type"]),
        *rollup.SHARES, "avg_avg_delay_all_services", "avg_avg_delay_delays_only",
    )


# --- stored states ---------------------------------------------------------------------


@query(f"""
WITH {roles.TIMED_SQL}, {roles.service_hours_sql()}
SELECT CAST(year(service_date) AS INT) AS year, {roles.season_sql('service_date')} AS season, {roles.COUNTS_SQL}
FROM per_service GROUP BY 1, 2""")
def report_from_states(spark, folder):
    """Hourly states of stops without the error events, refreshed for the days on which
    there are any; the yearly report reads states only."""
    stops = roles.stops(spark, folder)
    early = stops.filter(F.col("service_type") != "error")
    out = scratch_dir(spark, "hour-states")
    whole = rollup.timed_stops(stops, also=["service_type"])
    states.write_states(states.hour_states(rollup.service_hours(rollup.timed_stops(early))), out)
    changed = whole.filter(F.col("service_type") == "error").select("day").distinct()
    states.refresh_days(states.hour_states(rollup.service_hours(whole)), out, changed)
    kept = spark.read.parquet(out).withColumn("day", F.col("day").cast("date"))
    report = states.merged(kept, [F.year("day").alias("year"), season("day").alias("season")])
    return rounded(report.drop(*rollup.SHARES), "avg_avg_delay_all_services", "avg_avg_delay_delays_only")


@query(f"""
WITH {roles.TIMED_SQL}
SELECT 'month' AS period, strftime(service_date, '%Y-%m') AS value, count(DISTINCT service_rdt_id) AS different_services FROM timed GROUP BY 2
UNION ALL SELECT 'year', strftime(service_date, '%Y'), count(DISTINCT service_rdt_id) FROM timed GROUP BY 2
UNION ALL SELECT 'day', strftime(service_date, '%Y-%m-%d'), count(DISTINCT service_rdt_id) FROM timed GROUP BY 2""")
def services_per_period(spark, folder):
    """Daily sets of services, stored once and united for months and years."""
    out = scratch_dir(spark, "service-sets")
    stops = rollup.timed_stops(roles.stops(spark, folder))
    states.write_states(states.service_sets(stops), out)
    sets = spark.read.parquet(out)
    tables = [
        states.different_services(sets, [F.date_format("day", pattern).alias("value")]).select(F.lit(name).alias("period"), "value", "different_services")
        for name, pattern in (("day", "yyyy-MM-dd"), ("month", "yyyy-MM"), ("year", "yyyy"))
    ]
    return tables[0].unionByName(tables[1]).unionByName(tables[2])


@query("""
SELECT CAST(o_orderdate AS DATE)::VARCHAR AS day, count(DISTINCT c_name) AS different_services
FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1""")
def named_services_per_day(spark, folder):
    """Customers' names as services, which need numbers of their own."""
    names = table(spark, folder, "customer").select("c_custkey", "c_name")
    orders = table(spark, folder, "orders").select(F.to_date("o_orderdate").alias("day"), "o_custkey")
    stops = keyed_join(orders, names, [("o_custkey", "c_custkey")], how="inner").select("day", F.col("c_name").alias("service"))
    sets = states.service_sets(stops, staged(states.numbered(names, "c_name"), "numbers"))
    return plain(states.different_services(sets, ["day"]))
