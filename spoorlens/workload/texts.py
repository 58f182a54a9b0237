"""Cleaning of text columns, code lists, feeds, links and file names."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from spoorlens.functions import values
from spoorlens.functions.text import english_name, event_category, file_name, first_date
from spoorlens.operators import calendar, manifest, weather
from spoorlens.operators.intervals import seconds
from spoorlens.operators.keep_one import keep_one
from spoorlens.operators.stops import explode_codes as split_codes
from spoorlens.plans import jobs
from spoorlens.session import scratch_dir, staged
from spoorlens.workload import roles
from spoorlens.workload.delays import REPEAT_SQL
from spoorlens.workload.registry import plain, query, r6, table


@query("""
SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN CAST(o_custkey AS INT) END AS number,
  CASE WHEN o_orderpriority <> '1-URGENT' THEN o_totalprice END AS price,
  CASE o_orderstatus WHEN 'F' THEN TRUE WHEN 'O' THEN FALSE END AS flag,
  CASE WHEN o_orderpriority NOT IN ('2-HIGH', '3-MEDIUM') THEN strftime(o_orderdate, '%Y-%m-%d') END AS day,
  CASE WHEN o_orderstatus <> 'O' THEN strftime(o_orderdate + INTERVAL 1 SECOND * (o_custkey % 3600), '%Y-%m-%d %H:%M:%S') END AS moment,
  upper(o_orderpriority) AS code, FALSE AS missing_event_ts FROM orders""")
def typed_clean(spark, folder):
    """Orders as raw text with blanks and junk, parsed back."""
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    number = F.col("o_custkey").cast("string")
    moment = F.col("o_orderdate") + F.make_dt_interval(secs=F.pmod("o_custkey", F.lit(3600)))
    raw = table(spark, folder, "orders").select(
        "o_orderkey",
        F.when(status == "F", F.concat(number, F.lit(".0"))).when(status == "O", F.concat(F.lit(" "), number))
        .otherwise(F.concat(F.lit("x"), number)).alias("number"),
        F.when(priority == "1-URGENT", "").otherwise(F.col("o_totalprice").cast("string")).alias("price"),
        F.when(status == "F", "True").when(status == "O", "no").otherwise("").alias("flag"),
        F.when(priority == "2-HIGH", "not a day").when(priority == "3-MEDIUM", "")
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("day"),
        F.when(status == "O", "").otherwise(F.date_format(moment, "yyyy-MM-dd HH:mm:ss")).alias("moment"),
        F.concat(F.lit("  "), F.lower(priority), F.lit(" ")).alias("code"),
    )
    return plain(raw.withColumns({
        "number": values.to_int("number"),
        "price": values.to_double("price"),
        "flag": values.to_flag("flag"),
        "day": values.to_day("day"),
        "moment": values.to_instant("moment"),
        "code": values.station_key("code"),
        "missing_event_ts": F.lit(False),
    }))


@query("""
WITH lists AS (SELECT p_partkey, p_brand || ' , ' || p_type || ',,' || CASE WHEN p_size > 25 THEN p_name ELSE '' END || ', ' AS codes FROM part),
one AS (SELECT p_partkey, upper(unnest(string_split(regexp_replace(codes, '\\s+', '', 'g'), ','))) AS code FROM lists)
SELECT DISTINCT p_partkey, code FROM one WHERE code <> ''""")
def explode_codes(spark, folder):
    lists = table(spark, folder, "part").select(
        "p_partkey",
        F.concat("p_brand", F.lit(" , "), "p_type", F.lit(",,"),
                 F.when(F.col("p_size") > 25, F.col("p_name")).otherwise(""), F.lit(", ")).alias("code"),
    )
    return split_codes(lists, "code").distinct()


@query("""
SELECT DISTINCT event_type, user_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, hour(ts)::INT AS hour, value > 100 AS large, props IS NULL AS bare
FROM events""")
def full_row_dedup(spark, folder):
    e = table(spark, folder, "events")
    return plain(e.select(
        "event_type", "user_id", F.to_date("ts").alias("day"), F.hour("ts").alias("hour"),
        (F.col("value") > 100).alias("large"), F.col("props").isNull().alias("bare"),
    ).distinct())


@query("SELECT event_id, CAST(epoch(date_trunc('second', ts)) AS BIGINT) AS at FROM events")
def epoch_dispatch(spark, folder):
    """Event times as epochs in four units, chosen by event type, and parsed back."""
    e = table(spark, folder, "events")
    s = seconds(e, "ts")
    kind = F.col("event_type")
    epochs = e.select(
        "event_id",
        F.when(kind == "view", s).when(kind == "click", s * 1000 + 7)
        .when(kind == "error", s * 1000000 + 7).otherwise(s * 1000000000 + 7).alias("time"),
    )
    parsed = weather.parse_time(epochs, "time", "at")
    return parsed.select("event_id", F.unix_seconds("at").alias("at"))


@query("""
SELECT p_partkey AS station, p_size AS "time", CAST(NULL AS VARCHAR) AS stationname, p_retailprice AS "T", p_size AS "FF" FROM part""")
def adaptive_projection(spark, folder):
    """Only the known columns that exist are kept, in their fixed order."""
    p = table(spark, folder, "part").select(
        F.col("p_size").alias("FF"), F.col("p_retailprice").alias("T"), F.col("p_size").alias("time"),
        F.col("p_name").alias("unknown"), F.col("p_partkey").alias("station"),
    )
    weather.require_columns(p, ["station", "time"], "weather")
    known = weather.keep_known_columns(p, ["station", "time", "lat", "lon", "T", "T10N", "FF"])
    if "stationname" not in known.columns:
        known = known.withColumn("stationname", F.lit(None).cast("string"))
    return known


# --- calendar feed ------------------------------------------------------------------


def _feed(spark, folder) -> DataFrame:
    """Each order as an iCalendar event, some without a valid date or a summary."""
    o = table(spark, folder, "orders")
    price, status = F.col("o_totalprice"), F.col("o_orderstatus")
    date = F.when(price < 2000, "19990231").otherwise(F.date_format("o_orderdate", "yyyyMMdd"))
    title = F.when(status == "P", "Zomertijd (Summer time)").otherwise(
        F.concat(F.lit("klant "), F.col("o_custkey").cast("string"), F.lit(" ("),
                 F.col("o_orderpriority"), F.lit(" "), F.col("o_custkey").cast("string"), F.lit(") "))
    )
    summary = F.when(price > 490000, "").otherwise(F.concat(F.lit("SUMMARY;LANGUAGE=nl:"), title, F.lit("\r\n")))
    return o.select(
        F.col("o_orderkey"),
        F.concat(
            F.lit("BEGIN:VEVENT\r\nUID:1\r\nDTSTART;VALUE=DATE:"), date, F.lit("T000000\r\n"), summary,
            F.lit("END:VEVENT\r\n"),
        ).alias("text"),
    )


FEED_SQL = r"""feed AS (
  SELECT o_orderkey, 'BEGIN:VEVENT' || chr(10) || 'DTSTART;VALUE=DATE:'
    || CASE WHEN o_totalprice < 2000 THEN '19990231' ELSE strftime(o_orderdate, '%Y%m%d') END || 'T000000' || chr(10)
    || CASE WHEN o_totalprice > 490000 THEN '' ELSE 'SUMMARY;LANGUAGE=nl:' || CASE WHEN o_orderstatus = 'P'
         THEN 'Zomertijd (Summer time)' ELSE 'klant ' || o_custkey || ' (' || o_orderpriority || ' ' || o_custkey || ') ' END || chr(10) END
    || 'END:VEVENT' || chr(10) AS text FROM orders),
parts AS (SELECT o_orderkey AS seq, regexp_extract(text, 'DTSTART[^:]*:.*?(\d{8})', 1) AS d,
                 trim(regexp_extract(text, 'SUMMARY[^:]*:([^\n]*)', 1)) AS title FROM feed),
events_in AS (SELECT seq, TRY_CAST(substr(d, 1, 4) || '-' || substr(d, 5, 2) || '-' || substr(d, 7, 2) AS DATE) AS event_date,
  CASE WHEN regexp_matches(title, '\(([^)]+)\)\s*$') THEN trim(regexp_extract(title, '\(([^)]+)\)\s*$', 1)) ELSE title END AS name FROM parts),
named AS (SELECT seq, event_date, name, CASE WHEN lower(name) IN ('summer time', 'winter time') THEN 'Time change' ELSE 'Holiday' END AS category
  FROM events_in WHERE event_date IS NOT NULL)"""


@query(f"""
WITH {FEED_SQL} SELECT CAST(event_date AS VARCHAR) AS event_date, name, category FROM named""")
def calendar_feed(spark, folder):
    events = calendar.events_in_text(_feed(spark, folder), "text", [F.format_string("%020d", "o_orderkey")])
    return plain(events.drop("seq"))


CALENDAR_SQL = f"""
WITH {FEED_SQL}, {REPEAT_SQL.format(base='named', last=2003)},
years AS (SELECT DISTINCT CAST(year(o_orderdate) AS INT) AS y FROM orders), {roles.vacations_sql('years')},
base AS (SELECT event_date, name, category FROM named
         UNION ALL SELECT event_date, name, category FROM repeats WHERE event_date IS NOT NULL)
SELECT CAST(event_date AS VARCHAR) AS event_date, name, category FROM base
UNION ALL SELECT CAST(event_date AS VARCHAR), name, category FROM vacations v
WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.event_date = v.event_date AND b.name = v.name AND b.category = v.category)"""


@query(CALENDAR_SQL)
def calendar_build(spark, folder):
    events = calendar.events_in_text(_feed(spark, folder), "text", [F.format_string("%020d", "o_orderkey")])
    years = roles.years_of(table(spark, folder, "orders"), "o_orderdate")
    return plain(calendar.full_calendar(staged(events, "events"), years, 2003))


@query(f"SELECT event_date, nullif(name, '') AS name, category FROM ({CALENDAR_SQL})")
def calendar_job(spark, folder):
    """The same from feed files to a calendar file, in which an empty name reads as null."""
    feed, out = scratch_dir(spark, "feed"), scratch_dir(spark, "holidays")
    _feed(spark, folder).select("text").write.text(feed)
    first, last = table(spark, folder, "orders").agg(
        F.year(F.min("o_orderdate")), F.year(F.max("o_orderdate"))
    ).first()
    return plain(jobs.build_calendar(spark, feed, out, 2003, first, last))


@query(r"""
SELECT p_partkey, CASE WHEN p_size > 25 THEN p_name ELSE 'van ' || p_type || ' (x) of ' || p_brand END AS name,
  CASE WHEN p_size > 40 THEN 'Time change' ELSE 'Holiday' END AS category,
  CASE WHEN p_size BETWEEN 1 AND 28 THEN '2020-02-' || lpad(CAST(p_size AS VARCHAR), 2, '0') WHEN p_size = 29 THEN '2020-02-29' END AS day
FROM part""")
def event_text_fields(spark, folder):
    """Name in a closing parenthesis, category by name, and the first eight digits as date."""
    size = F.col("p_size")
    p = table(spark, folder, "part").select(
        "p_partkey", "p_size", "p_name",
        F.when(size > 25, F.concat(F.lit(" iets ("), F.col("p_name"), F.lit(")  ")))
        .otherwise(F.concat(F.lit("van "), F.col("p_type"), F.lit(" (x) of "), F.col("p_brand"), F.lit(" "))).alias("title"),
        F.when(size > 40, "WINTER Time").otherwise("Summer").alias("kind"),
        F.concat(F.lit("x:202002"), F.lpad(size.cast("string"), 2, "0"), F.lit("T20200101")).alias("stamp"),
    )
    return plain(p.select(
        "p_partkey", english_name(F.col("title")).alias("name"),
        event_category(F.col("kind")).alias("category"), first_date(F.col("stamp")).alias("day"),
    ))


# --- links and file names -------------------------------------------------------------

LINKS_SQL = r"""links AS (
  SELECT page_id, regexp_extract(url, '^([a-z]+://[^/?#]*)', 1)
         || unnest(regexp_extract_all(html, '<a\s[^>]*?href="([^"]*)"', 1)) AS link FROM pages)"""


@query(f"WITH {LINKS_SQL} SELECT page_id, link FROM links")
def page_links(spark, folder):
    pages = table(spark, folder, "pages").select("page_id", "url", "html")
    return manifest.page_links(pages).select("page_id", "link")


@query(f"""
WITH {LINKS_SQL}
SELECT file_name, count(*) AS links FROM (SELECT regexp_extract(regexp_extract(link, '^[^?#]*'), '([^/]*)$', 1) AS file_name FROM links
  UNION ALL SELECT regexp_extract(regexp_extract(regexp_extract(url, '^[^?#]*'), '^[a-z]+://[^/]*(.*)$', 1), '([^/]*)$', 1) FROM pages) GROUP BY file_name""")
def link_file_names(spark, folder):
    pages = table(spark, folder, "pages").select("url", "html")
    linked = manifest.page_links(pages).select("file_name")
    own = pages.select(file_name(F.col("url")).alias("file_name"))
    return linked.unionByName(own).groupBy("file_name").agg(F.count("*").alias("links"))


def _download_pages(spark, folder) -> DataFrame:
    """One page per order with links to data files named after its date."""
    o = table(spark, folder, "orders")
    year, day = F.year("o_orderdate"), F.col("o_orderdate")
    whole = year.isin(1996, 1998, 2000) & (F.col("o_orderpriority") == "1-URGENT")
    services = F.when(whole, F.date_format(day, "'services-'yyyy'.csv.gz'")).otherwise(
        F.date_format(day, "'services-'yyyy-MM'.csv.gz'")
    )
    disruptions = F.date_format(day, "'disruptions-'yyyy'.csv'")
    fixed = F.when(year == 1995, manifest.STATIONS_FILE).otherwise(manifest.DISTANCES_FILE)
    link = lambda before, name, after: F.concat(F.lit(f'<a class="x" href="{before}'), name, F.lit(f'{after}">f</a> '))
    return o.select(
        F.concat(F.lit("https://data.example/en/archive/"), F.col("o_orderkey").cast("string")).alias("url"),
        F.concat(
            F.lit('<p><!-- <a href="services-1999.csv.gz">old</a> -->'),
            link("/files/", services, "?v=1"), link("../", disruptions, ""),
            link("https://other.example/", fixed, "#top"), F.lit("</p>"),
        ).alias("html"),
    )


DOWNLOADS_SQL = """files AS (
  SELECT o_orderkey, year(o_orderdate) AS y,
    CASE WHEN year(o_orderdate) IN (1996, 1998, 2000) AND o_orderpriority = '1-URGENT'
      THEN strftime(o_orderdate, 'services-%Y.csv.gz') ELSE strftime(o_orderdate, 'services-%Y-%m.csv.gz') END AS services,
    strftime(o_orderdate, 'disruptions-%Y.csv') AS disruptions FROM orders),
whole AS (SELECT *, max(length(services) = length('services-2000.csv.gz')) OVER (PARTITION BY y) AS has_yearly FROM files WHERE y >= 1996),
chosen AS (SELECT * FROM whole WHERE NOT has_yearly OR length(services) = length('services-2000.csv.gz'))"""


@query(f"""
WITH {DOWNLOADS_SQL}
SELECT CAST(y AS INT) AS year, services AS file_name, 'https://data.example/files/' || services || '?v=1' AS link, o_orderkey::VARCHAR AS page
FROM chosen""")
def manifest_select(spark, folder):
    links = manifest.page_links(_download_pages(spark, folder), holding=manifest.STEMS)
    files = staged(manifest.known_files(links), "files")
    return manifest.service_files(files, first_year=1996).select(
        "year", "file_name", "link", F.regexp_extract("url", r"(\d+)$", 1).alias("page")
    )


@query(f"""
WITH {DOWNLOADS_SQL}
SELECT 'services' AS dataset, 'https://data.example/files/' || services || '?v=1' AS link, services AS file_name FROM chosen
UNION ALL SELECT 'disruptions', 'https://data.example/en/' || disruptions, disruptions FROM files WHERE y >= 1996
UNION ALL SELECT 'stations', 'https://other.example/stations-2023-09.csv#top', 'stations-2023-09.csv'
UNION ALL SELECT 'tariff_distances', 'https://other.example/tariff-distances-2022-01.csv#top', 'tariff-distances-2022-01.csv'""")
def manifest_build(spark, folder):
    return jobs.build_manifest(_download_pages(spark, folder), first_year=1996)
