"""Readers, writers and whole jobs: written to the scratch folder and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from spoorlens.operators import quality, quarantine, stops as stop_ops
from spoorlens.operators.skew import keyed_join
from spoorlens.plans import incremental, jobs
from spoorlens.session import scratch_dir
from spoorlens.sources import readers, writers
from spoorlens.workload import roles
from spoorlens.workload.locations import nearest_sql, PLANAR_ORDER
from spoorlens.workload.registry import plain, query, r6, rounded, table

ORDERS_SQL = """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders"""


def _orders(spark, folder) -> DataFrame:
    return table(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", F.to_date("o_orderdate").alias("day")
    )


def _typed_again(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("o_orderkey").cast("long"), F.col("o_custkey").cast("long"), "o_orderstatus",
        F.col("o_totalprice").cast("double"), F.col("day").cast("date"),
    )


@query(ORDERS_SQL)
def sink_roundtrip_parquet(spark, folder):
    out = scratch_dir(spark, "parquet")
    writers.write_parquet(_orders(spark, folder), out)
    return plain(readers.read_parquet(spark, out))


@query(ORDERS_SQL)
def sink_roundtrip_csv(spark, folder):
    out = scratch_dir(spark, "csv")
    writers.write_csv(_orders(spark, folder), out, single=False)
    return plain(_typed_again(readers.read_csv(spark, out)))


@query(ORDERS_SQL)
def sink_roundtrip_csv_gz(spark, folder):
    out = scratch_dir(spark, "csv-gz")
    _orders(spark, folder).write.option("header", True).option("compression", "gzip").csv(out)
    return plain(_typed_again(readers.read_csv(spark, f"{out}/*.csv.gz", spread=True)))


@query("SELECT n_regionkey, count(*) AS nations FROM nation GROUP BY 1")
def sink_roundtrip_single_csv(spark, folder):
    out = scratch_dir(spark, "single-csv")
    counts = table(spark, folder, "nation").groupBy("n_regionkey").agg(F.count("*").alias("nations"))
    writers.write_csv(counts, out, single=True)
    return readers.read_csv(spark, f"{out}/part-*.csv").select(
        F.col("n_regionkey").cast("int"), F.col("nations").cast("long")
    )


@query("""
SELECT o_orderkey, o_totalprice, CAST(year(o_orderdate) AS INT) AS year, CAST(month(o_orderdate) AS INT) AS month
FROM orders""")
def sink_roundtrip_partitioned(spark, folder):
    return readers.read_parquet(spark, _partitioned(spark, folder))


@query("""
SELECT o_orderkey, o_totalprice, CAST(year(o_orderdate) AS INT) AS year, CAST(month(o_orderdate) AS INT) AS month
FROM orders WHERE year(o_orderdate) = 1997""")
def sink_roundtrip_one_year(spark, folder):
    """A filter on the folders of a year reads only these."""
    return readers.read_parquet(spark, _partitioned(spark, folder)).filter(F.col("year") == 1997)


def _partitioned(spark, folder) -> str:
    out = scratch_dir(spark, "partitioned")
    o = table(spark, folder, "orders").select(
        "o_orderkey", "o_totalprice", F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month")
    )
    writers.write_parquet(o, out, partitions=["year", "month"], compression="snappy")
    return out


@query("""
SELECT c_custkey AS k, c_name AS name, c_acctbal AS balance, CAST(NULL AS INT) AS nation FROM customer
UNION ALL SELECT s_suppkey, s_name, NULL, s_nationkey FROM supplier""")
def sink_roundtrip_merged_schema(spark, folder):
    out = scratch_dir(spark, "merged")
    c = table(spark, folder, "customer")
    s = table(spark, folder, "supplier")
    c.select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance")) \
        .write.parquet(f"{out}/a")
    s.select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation")) \
        .write.parquet(f"{out}/b")
    return readers.read_parquet(spark, f"{out}/*", merge=True).select("k", "name", "balance", "nation")


@query("""
SELECT c_custkey AS k, c_name AS name, c_acctbal AS balance, CAST(NULL AS INT) AS nation FROM customer
UNION ALL SELECT s_suppkey, s_name, NULL, s_nationkey FROM supplier""")
def union_by_name(spark, folder):
    c = table(spark, folder, "customer").select(
        F.col("c_acctbal").alias("balance"), F.col("c_custkey").alias("k"), F.col("c_name").alias("name"))
    s = table(spark, folder, "supplier").select(
        F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation"), F.col("s_suppkey").alias("k"))
    return c.unionByName(s, allowMissingColumns=True).select("k", "name", "balance", "nation")


MONTHS_SQL = """
SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS readings, count(T) AS with_t, round(sum(o_totalprice), 2) AS total
FROM (SELECT o_orderdate, o_totalprice, CASE WHEN o_orderstatus = 'F' THEN o_custkey END AS T FROM orders) GROUP BY 1"""


@query(MONTHS_SQL)
def monthly_compact(spark, folder):
    """Two input folders with different columns and months, compacted to month folders."""
    a, b, out = (scratch_dir(spark, n) for n in ("readings-a", "readings-b", "months"))
    o = table(spark, folder, "orders").select(
        F.col("o_orderdate").alias("time"), F.col("o_totalprice").alias("Q"), F.col("o_custkey").alias("T"),
        "o_orderstatus",
    )
    finished = F.col("o_orderstatus") == "F"
    o.filter(finished).drop("o_orderstatus").write.parquet(a)
    o.filter(~finished).drop("o_orderstatus", "T").write.parquet(b)
    months = jobs.compact_weather(spark, [a, b], out)
    return _months(months)


def _months(months: DataFrame) -> DataFrame:
    return months.groupBy(F.col("month").cast("string").alias("month")).agg(
        F.count("*").alias("readings"), F.count("T").alias("with_t"), F.round(F.sum("Q"), 2).alias("total")
    )


@query(MONTHS_SQL)
def monthly_refreshed(spark, folder):
    """Month folders from files that come one after another, and of which one is replaced."""
    readings, out, ledger = (scratch_dir(spark, n) for n in ("readings", "months", "ledger"))
    o = table(spark, folder, "orders").select(
        F.col("o_orderdate").alias("time"), F.col("o_totalprice").alias("Q"), F.col("o_custkey").alias("T"), "o_orderstatus",
    )
    finished = F.col("o_orderstatus") == "F"
    a, b = o.filter(finished).drop("o_orderstatus"), o.filter(~finished).drop("o_orderstatus", "T")
    for name, part in (("a", a), ("b", b.filter(F.month("time") < 7)), ("b", b)):
        part.write.mode("overwrite").parquet(f"{readings}/{name}")
        incremental.refresh_months(spark, f"{readings}/*", out, ledger)
    return _months(readers.read_parquet(spark, out, merge=True))


# Rows of a gzipped stop file.
ROWS_A_FILE = 500_000

# --- whole jobs -----------------------------------------------------------------------


def _raw_stations(spark, folder) -> DataFrame:
    """Customers as raw station rows: in debt without coordinates, three rows per code."""
    c = table(spark, folder, "customer")
    lat, lng = roles.station_position(F.col("c_custkey"))
    known = F.col("c_acctbal") >= 0
    return c.select(
        F.col("c_name").alias("id"),
        F.concat(F.lit(" s"), F.floor(F.col("c_custkey") / 3).cast("string"), F.lit(" ")).alias("code"),
        F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("country"),
        F.when(known, lat.cast("string")).otherwise("").alias("geo_lat"),
        F.when(known, lng.cast("string")).otherwise("").alias("geo_lng"),
    )


RAW_STATIONS_SQL = """stations AS (
  SELECT c_name AS id, 'S' || (c_custkey // 3) AS code, 'N' || c_nationkey AS country,
    CASE WHEN c_acctbal >= 0 THEN 50 + (c_custkey % 37) * CAST(0.1 AS DOUBLE) END AS geo_lat,
    CASE WHEN c_acctbal >= 0 THEN 4 + (c_custkey % 53) * CAST(0.05 AS DOUBLE) END AS geo_lng FROM customer)"""


@query(f"""
WITH {RAW_STATIONS_SQL}
SELECT id, code, country, round(geo_lat + 1.2345e-9, 6) AS geo_lat, round(geo_lng + 1.2345e-9, 6) AS geo_lng
FROM (SELECT *, row_number() OVER (PARTITION BY code ORDER BY geo_lat IS NOT NULL DESC, id) AS place FROM stations) WHERE place = 1""")
def station_consolidation(spark, folder):
    raw, out = scratch_dir(spark, "stations-raw"), scratch_dir(spark, "stations")
    writers.write_csv(_raw_stations(spark, folder), raw, single=False)
    return rounded(jobs.consolidate_stations(spark, raw, out)["stations"], "geo_lat", "geo_lng")


def _raw_services(spark, folder, spread: bool = False) -> DataFrame:
    """Events as raw stop-event rows with the file header and text values."""
    e = table(spark, folder, "events")
    if spread:
        # As many for each core, so that none is idle while the last files are read.
        cores = spark.sparkContext.defaultParallelism
        e = e.repartition(cores * max(1, -(-e.count() // (cores * ROWS_A_FILE))))
    kind, value = F.col("event_type"), F.col("value")
    moment = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    user = F.col("user_id").cast("string")
    return e.select(
        user.alias("Service:RDT-ID"),
        F.when(value > 300, "").otherwise(F.date_format("ts", "yyyy-MM-dd")).alias("Service:Date"),
        kind.alias("Service:Type"),
        F.concat(F.lit("C"), user).alias("Service:Company"),
        F.when(kind == "view", F.concat(user, F.lit(".0"))).otherwise(user).alias("Service:Train number"),
        F.when(kind == "error", "true").otherwise("False").alias("Service:Completely cancelled"),
        F.when(kind == "view", "").otherwise(F.when(kind == "signup", "True").otherwise("false")).alias("Service:Partly cancelled"),
        F.floor(value).cast("string").alias("Service:Maximum delay"),
        F.col("event_id").cast("string").alias("Stop:RDT-ID"),
        F.concat(F.lit(" s"), user, F.lit(" ")).alias("Stop:Station code"),
        F.concat(F.lit("Station "), user).alias("Stop:Station name"),
        F.when(kind == "click", "").otherwise(moment(F.col("ts"))).alias("Stop:Arrival time"),
        F.when(kind == "purchase", "").otherwise((value / 20 - 1).cast("string")).alias("Stop:Arrival delay"),
        F.lit("false").alias("Stop:Arrival cancelled"),
        F.when(value < 100, moment(F.col("ts") + F.expr("INTERVAL 5 MINUTES"))).otherwise("").alias("Stop:Departure time"),
        F.when(value > 200, "").otherwise((value / 25).cast("string")).alias("Stop:Departure delay"),
        F.lit("false").alias("Stop:Departure cancelled"),
        F.lit("").alias("Stop:Platform change"),
        F.lit("1").alias("Stop:Planned platform"),
        F.lit("1a").alias("Stop:Actual platform"),
        F.col("props").alias("Extra"),
    )


def _raw_disruptions(spark, folder) -> DataFrame:
    """Error events as disruptions of the user's station and the next one."""
    e = table(spark, folder, "events").filter(F.col("event_type") == "error")
    user = F.col("user_id")
    moment = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    return e.select(
        F.concat(F.lit("s"), user.cast("string"), F.lit(", S"), (user + 1).cast("string"), F.lit(",, ")).alias("rdt_station_codes"),
        F.concat(F.lit("cause "), F.floor(F.col("value")).cast("string")).alias("cause_en"),
        F.lit("statistical").alias("statistical_cause_en"),
        F.lit("group").alias("cause_group"),
        moment(F.col("ts")).alias("start_time"),
        F.when(F.col("value") > 200, "").otherwise(moment(F.col("ts") + F.expr("INTERVAL 6 HOURS"))).alias("end_time"),
    )


SECOND = "date_trunc('second', ts)"
MASTER_SQL = f"""
{RAW_STATIONS_SQL},
one_station AS (SELECT * FROM (SELECT code, country, geo_lat, geo_lng, row_number() OVER (PARTITION BY code
  ORDER BY geo_lat IS NOT NULL DESC, country NULLS LAST, geo_lat, geo_lng) AS place FROM stations) WHERE place = 1),
disruptions AS (
  SELECT DISTINCT 'S' || (user_id + step) AS d_code, 'cause ' || CAST(floor(value) AS BIGINT) AS cause, {SECOND} AS d_start,
    CASE WHEN value <= 200 THEN {SECOND} + INTERVAL 6 HOUR END AS d_end
  FROM events, (VALUES (0), (1)) v(step) WHERE event_type = 'error'),
services AS (
  SELECT event_id, user_id, event_type, value, 'S' || user_id AS s_code, CASE WHEN value <= 300 THEN CAST(ts AS DATE) END AS s_date,
    CASE WHEN event_type <> 'click' THEN {SECOND} END AS arr, CASE WHEN value < 100 THEN {SECOND} + INTERVAL 5 MINUTE END AS dep
  FROM events),
master AS (
  SELECT s.*, coalesce(dep, arr) AS event_ts, country, geo_lat, geo_lng, cause, d_start, d_end FROM services s
  LEFT JOIN one_station ON code = s_code
  LEFT JOIN disruptions ON d_code = s_code AND coalesce(dep, arr) BETWEEN d_start AND d_end)"""


def _master(spark, folder) -> str:
    """Folder of a master table built by the job from raw files."""
    services, stations, disruptions, out = (
        scratch_dir(spark, n) for n in ("services", "stations", "disruptions", "master")
    )
    # Files of even size, as a gzipped one is read by one task. The events are dealt, which
    # take less room than the texts made of them.
    _raw_services(spark, folder, spread=True) \
        .write.option("header", True).option("compression", "gzip").csv(services)
    writers.write_csv(_raw_stations(spark, folder), stations, single=False)
    writers.write_csv(_raw_disruptions(spark, folder), disruptions, single=False)
    jobs.build_master(spark, services, stations, disruptions, out)
    return out


MASTER_ROWS_SQL = f"""
WITH {MASTER_SQL}
SELECT CAST(event_id AS VARCHAR) AS stop_rdt_id, s_code AS stop_station_code, CAST(user_id AS INT) AS service_train_number,
  CAST(floor(value) AS INT) AS service_maximum_delay, event_type = 'error' AS service_completely_cancelled,
  CASE WHEN event_type <> 'view' THEN event_type = 'signup' END AS service_partly_cancelled,
  round(CASE WHEN event_type <> 'purchase' THEN value / 20 - 1 END + 1.2345e-9, 6) AS stop_arrival_delay,
  strftime(event_ts, '%Y-%m-%d %H:%M:%S') AS stop_event_ts, CAST(year(s_date) AS INT) AS year, CAST(month(s_date) AS INT) AS month,
  country AS station_country, round(geo_lat + 1.2345e-9, 6) AS station_geo_lat, cause AS disruption_cause_en,
  strftime(d_start, '%Y-%m-%d %H:%M:%S') AS disruption_start_time_ts FROM master"""


@query(MASTER_ROWS_SQL)
def master_build(spark, folder):
    return _master_rows(spark, _master(spark, folder))


def _master_rows(spark, path: str) -> DataFrame:
    master = rounded(readers.read_parquet(spark, path), "stop_arrival_delay", "station_geo_lat")
    return plain(master.select(
        "stop_rdt_id", "stop_station_code", "service_train_number", "service_maximum_delay",
        "service_completely_cancelled", "service_partly_cancelled", "stop_arrival_delay",
        "stop_event_ts", "year", "month", "station_country", "station_geo_lat",
        "disruption_cause_en", "disruption_start_time_ts",
    ))


@query(MASTER_ROWS_SQL)
def master_refreshed(spark, folder):
    """Master in two runs: the stop files of the second are new, and a third run over the
    same files opens none."""
    services, stations, disruptions, out, ledger = (
        scratch_dir(spark, n) for n in ("services", "stations", "disruptions", "master", "ledger")
    )
    raw = _raw_services(spark, folder)
    first = F.col("Service:Type").isin("view", "click")
    writers.write_csv(_raw_stations(spark, folder), stations, single=False)
    writers.write_csv(_raw_disruptions(spark, folder), disruptions, single=False)
    for name, part in (("early", raw.filter(first)), ("late", raw.filter(~first))):
        part.write.option("header", True).option("compression", "gzip").csv(f"{services}/{name}")
        incremental.refresh_master(spark, f"{services}/*", stations, disruptions, out, ledger)
    idle = incremental.refresh_master(spark, f"{services}/*", stations, disruptions, out, ledger)
    if idle.read or idle.months:
        raise AssertionError(f"files were read again: {idle.read}")
    return _master_rows(spark, out)


@query("""
WITH bad AS (
  SELECT event_type AS file, unnest([
    CASE WHEN value > 250 THEN 'service_train_number:whole number' END,
    CASE WHEN event_type = 'signup' THEN 'service_date:date' END,
    CASE WHEN event_type = 'click' AND value < 50 THEN 'stop_departure_delay:number' END]) AS what
  FROM events WHERE NOT (event_type = 'error' AND value < 20)
  UNION ALL SELECT event_type, ':line' FROM events WHERE event_type = 'error' AND value < 20)
SELECT file, nullif(split_part(what, ':', 1), '') AS "column", split_part(what, ':', 2) AS expected, count(*) AS rejects
FROM bad WHERE what IS NOT NULL GROUP BY ALL""")
def rejected_values(spark, folder):
    """Stop files with spoilt numbers, dates and lines: what the master job rejects."""
    services, stations, disruptions, out, rejects = (
        scratch_dir(spark, n) for n in ("services", "stations", "disruptions", "master", "rejects")
    )
    e = table(spark, folder, "events").select(F.col("event_id").cast("string").alias("_id"), "event_type", "value")
    raw = keyed_join(_raw_services(spark, folder), e, [("Stop:RDT-ID", "_id")], how="inner")
    kind, value = F.col("event_type"), F.col("value")
    spoilt = raw.withColumns({
        "Service:Train number": F.when(value > 250, F.lit("12x")).otherwise(F.col("Service:Train number")),
        "Service:Date": F.when(kind == "signup", F.lit("31.12.2024")).otherwise(F.col("Service:Date")),
        "Stop:Departure delay": F.when((kind == "click") & (value < 50), F.lit("late")).otherwise(F.col("Stop:Departure delay")),
    }).drop("Extra")
    names = [c for c in spoilt.columns if c not in ("_id", "event_type", "value")]
    line = F.concat_ws(",", *[F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in names])
    broken = F.when((kind == "error") & (value < 20), F.concat(line, F.lit(",one,more"))).otherwise(line)
    # Whole lines as one column that the header names: a writer of CSV would not spoil them,
    # but it puts the header first in every file, whatever the number of tasks.
    lines = spoilt.filter(kind.isNotNull()).select(broken.alias(",".join(names)), kind.alias("kind"))
    plain_lines = {"header": True, "sep": "\x01", "quote": "", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    lines.write.options(**plain_lines).partitionBy("kind").csv(services)
    writers.write_csv(_raw_stations(spark, folder), stations, single=False)
    writers.write_csv(_raw_disruptions(spark, folder), disruptions, single=False)
    jobs.build_master(spark, f"{services}/*", stations, disruptions, out, rejects_out=rejects)
    # A kind has a folder with as many files as tasks had rows of it.
    found = readers.read_parquet(spark, rejects).withColumn("file", F.regexp_extract("file", r"([^/=]+)/[^/]+$", 1))
    return quarantine.counts(found)


def _raw_weather(spark, folder) -> DataFrame:
    """View events as readings with a time in epoch milliseconds."""
    e = table(spark, folder, "events").filter(F.col("event_type") == "view")
    station = F.pmod("user_id", F.lit(100))
    lat, lng = roles.weather_position(station)
    # Local wall time to epoch in the session's zone, as the job reads it back there.
    return e.select(
        station.alias("station"), F.unix_millis(F.col("ts").cast("timestamp")).alias("time"),
        lat.alias("lat"), lng.alias("lon"),
        F.concat(F.lit("W"), station.cast("string")).alias("stationname"),
        F.col("value").alias("T"), F.col("props").alias("note"),
    )


@query(f"""
WITH {MASTER_SQL},
located AS (SELECT code, geo_lat, geo_lng FROM one_station WHERE geo_lat IS NOT NULL),
readings AS (SELECT user_id % 100 AS w, 50 + (user_id % 100 % 11) * CAST(0.33 AS DOUBLE) AS w_lat,
  4 + (user_id % 100 % 13) * CAST(0.21 AS DOUBLE) AS w_lng, ts AS w_ts, value AS "T" FROM events WHERE event_type = 'view'),
w_sites AS (SELECT w_lat, w_lng, min(w) AS w FROM readings GROUP BY 1, 2),
mapping AS (SELECT code, w FROM (SELECT code, w, row_number() OVER (PARTITION BY code ORDER BY
  round((geo_lat - w_lat) * (geo_lat - w_lat) + (geo_lng - w_lng) * (geo_lng - w_lng), 9), w) AS place FROM located, w_sites) WHERE place = 1)
SELECT CAST(event_id AS VARCHAR) AS stop_rdt_id, s_code AS stop_station_code, strftime(event_ts, '%Y-%m-%d %H:%M:%S') AS stop_event_ts,
  m.w AS weather_station, r."T" FROM master LEFT JOIN mapping m ON m.code = s_code
  LEFT JOIN readings r ON r.w = m.w AND CAST(w_ts AS DATE) = CAST(event_ts AS DATE) AND hour(w_ts) = hour(event_ts)
WHERE event_ts IS NOT NULL""")
def services_with_weather(spark, folder):
    """Master and consolidated stations from files, weather by the nearest station."""
    stations, readings, out, mapping = (
        scratch_dir(spark, n) for n in ("stations", "readings", "with-weather", "mapping")
    )
    raw = scratch_dir(spark, "stations-raw")
    writers.write_csv(_raw_stations(spark, folder), raw, single=False)
    named = readers.read_csv(spark, raw).select("code", "country", "geo_lat", "geo_lng", "id")
    stop_ops.clean_stations(named).select(
        F.col("station_code").alias("code"), F.col("station_geo_lat").alias("geo_lat"), F.col("station_geo_lng").alias("geo_lng"),
    ).write.parquet(stations)
    _raw_weather(spark, folder).write.parquet(readings)
    done = jobs.attach_weather(spark, _master(spark, folder), stations, readings, out, mapping)["services_with_weather"]
    return plain(done.select("stop_rdt_id", "stop_station_code", "stop_event_ts", "weather_station", "T"))


@query(f"""
WITH {MASTER_SQL},
timed AS (SELECT CAST(coalesce(arr, dep) AS DATE) AS service_date, CAST(hour(coalesce(arr, dep)) AS INT) AS hour, CAST(user_id AS VARCHAR) AS id,
  event_type = 'error' AS cc, CASE WHEN event_type <> 'view' THEN event_type = 'signup' END AS pc,
  coalesce(CASE WHEN event_type <> 'purchase' THEN value / 20 - 1 END, CASE WHEN value <= 200 THEN value / 25 END, 0.0) AS delay
  FROM master WHERE coalesce(arr, dep) IS NOT NULL),
per_service AS (SELECT service_date, hour, id AS service_rdt_id, max(CAST(cc AS INT)) AS svc_cc, max(CAST(pc AS INT)) AS svc_pc,
  max(delay) AS svc_max, avg(delay) AS svc_avg FROM timed GROUP BY ALL),
cal AS (SELECT DISTINCT CAST(ts AS DATE) AS d FROM events WHERE value > 400)
SELECT CAST(service_date AS VARCHAR) AS service_date, hour, {roles.COUNTS_SQL},
  CASE WHEN max(d) IS NULL THEN 'No holiday' ELSE 'Busy day' END AS holiday_name
FROM per_service LEFT JOIN cal ON d = service_date GROUP BY service_date, hour""")
def delay_report_job(spark, folder):
    """Master job, then the report job on its output with a calendar file."""
    holidays, out = (scratch_dir(spark, n) for n in ("holidays", "report"))
    busy = table(spark, folder, "events").filter(F.col("value") > 400).select(
        F.to_date("ts").alias("event_date"), F.lit("Busy day").alias("name"), F.lit("Holiday").alias("category")
    ).distinct()
    writers.write_csv(busy, holidays, single=True)
    report = jobs.delay_report(spark, _master(spark, folder), holidays, out)
    counts = ["services_in_hour", "completely_cancelled", "partly_cancelled", "delayed_count",
              "on_time_count", "short_delay_count", "long_delay_count"]
    return report.select(
        "service_date", F.col("hour").cast("int"), *[F.col(c).cast("long") for c in counts],
        *[r6(F.col(c).cast("double")).alias(c) for c in ("avg_avg_delay_all_services", "avg_avg_delay_delays_only")],
        "holiday_name",
    )


@query("""
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate,
       epoch_us(o_orderdate) AS micros FROM orders""")
def parquet_settings(spark, folder):
    """Every time written as microseconds and read back without a calendar rebase; the
    settings are those of the read itself, in force when it runs."""
    out = scratch_dir(spark, "micros")
    o = table(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    o.withColumn("micros", F.unix_micros(F.to_timestamp(F.concat(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"), F.lit("Z"))))).write.parquet(out)
    back = spark.read.option("datetimeRebaseMode", "CORRECTED").option("int96RebaseMode", "CORRECTED").parquet(out)
    return plain(back)


@query(f"""
WITH {roles.TIMED_SQL}, parts AS ({roles.grouping_sets_sql('timed', ['service_type'], [['service_type'], []])})
SELECT grouping_id, service_type, services_in_hour, delayed_count, long_delay_count, avg_avg_delay_all_services FROM parts""")
def analysis_job(spark, folder):
    """Delays by dimension as the job writes them, from a table of stops."""
    stops, out = scratch_dir(spark, "stops"), scratch_dir(spark, "analysis")
    roles.stops(spark, folder).write.parquet(stops)
    got = jobs.analyse(spark, stops, out)["by_dimension"]
    return rounded(got.select(
        F.col("grouping_id").cast("int"), "service_type",
        *[F.col(c).cast("long") for c in ("services_in_hour", "delayed_count", "long_delay_count")],
        F.col("avg_avg_delay_all_services").cast("double"),
    ), "avg_avg_delay_all_services")
