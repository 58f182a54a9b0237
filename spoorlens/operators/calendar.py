"""Holidays and school vacations as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from spoorlens.functions.text import english_name, event_category, first_date
from spoorlens.operators.keep_one import append_missing
from spoorlens.schemas import CALENDAR_COLUMNS

# --- fixed values: school vacations ---------------------------------------------
VACATION_CATEGORY = "Vacation"
# name, first (month, day), last (month, day), years from first to last
VACATION_RANGES = [
    ("Summer vacation", (7, 15), (8, 25), 0),
    ("Christmas vacation", (12, 24), (1, 4), 1),
]
# name, (month, day) within the Monday-to-Sunday week
VACATION_WEEKS = [
    ("Spring vacation", (2, 15)),
    ("Autumn vacation", (10, 15)),
    ("May vacation", (4, 27)),
]


def events_in_text(df: DataFrame, text: str, order: list[Column]) -> DataFrame:
    """Events of iCalendar text: event_date, name, category and ``seq``, their order.

    Folded lines are joined first. Within an event the last DTSTART and SUMMARY count.
    Events without a valid date are left out; a missing summary gives an empty name.
    """
    unfolded = F.regexp_replace(text, r"\r?\n[ \t]", "")
    blocks = F.regexp_extract_all(
        unfolded, F.lit(r"(?ms)^[ \t]*BEGIN:VEVENT(.*?)^[ \t]*END:VEVENT"), F.lit(1)
    )
    # An event that was begun twice counts from its last beginning.
    inner = F.transform(blocks, lambda b: F.substring_index(b, "BEGIN:VEVENT", -1))

    def last_line(block: Column, pattern: str) -> Column:
        return F.try_element_at(F.regexp_extract_all(block, F.lit(pattern), F.lit(1)), F.lit(-1))

    lines = F.transform(inner, lambda b: F.struct(
        last_line(b, r"(?m)^[ \t]*DTSTART([^\r\n]*)").alias("start"),
        last_line(b, r"(?m)^[ \t]*SUMMARY[^:\r\n]*:([^\r\n]*)").alias("title"),
    ))
    # The value follows the first colon; without one the whole line is searched.
    fields = F.transform(lines, lambda e: F.struct(
        first_date(F.regexp_replace(e["start"], r"^[^:]*:", "")).alias("event_date"),
        english_name(e["title"]).alias("name"),
    ))
    # Parsed inside the array: the filter then applies to finished columns.
    return (
        df.select(F.array(*order).alias("_from"), F.posexplode(fields).alias("_pos", "_event"))
        .filter(F.col("_event.event_date").isNotNull())
        .select(
            "_event.event_date",
            "_event.name",
            event_category(F.col("_event.name")).alias("category"),
            F.struct("_from", "_pos").alias("seq"),
        )
    )


def singleton_names(events: DataFrame) -> DataFrame:
    """Names with one distinct date, that date, and the category seen first.

    One distinct date means that lowest and highest are the same, so no distinct count
    is needed and everything is partly computed before the shuffle.
    """
    return (
        events.groupBy("name")
        .agg(
            F.min("event_date").alias("only_date"),
            F.max("event_date").alias("_last"),
            F.min_by("category", "seq").alias("category"),
        )
        .filter(F.col("only_date") == F.col("_last"))
        .drop("_last")
    )


def repeat_yearly(events: DataFrame, max_year: int) -> DataFrame:
    """``events`` and, for each name that has one date, the same day of later years.

    29 February is kept in leap years only. The new rows cannot collide with given
    ones, as their name has no other date.
    """
    steps = F.sequence(F.lit(1), F.lit(max_year) - F.year("only_date"))
    later = F.add_months(F.col("only_date"), F.col("_step") * 12)
    added = (
        singleton_names(events)
        .filter((F.col("name") != "") & (F.year("only_date") < max_year))
        .withColumn("_step", F.explode(steps))
        .select(later.alias("event_date"), "only_date", "name", "category")
        .filter(F.dayofmonth("event_date") == F.dayofmonth("only_date"))
    )
    return events.select(*CALENDAR_COLUMNS).unionByName(added.select(*CALENDAR_COLUMNS))


def school_vacations(years: DataFrame) -> DataFrame:
    """One row per vacation day for each ``year`` of the input."""

    def day(month: int, dom: int, later: int = 0) -> Column:
        return F.make_date(F.col("year") + later, F.lit(month), F.lit(dom))

    def span(name: str, first: Column, last: Column) -> Column:
        return F.struct(F.lit(name).alias("name"), first.alias("first"), last.alias("last"))

    ranges = [span(n, day(*a), day(*b, later=y)) for n, a, b, y in VACATION_RANGES]
    weeks = []
    for name, inside in VACATION_WEEKS:
        monday = F.trunc(day(*inside), "week")
        weeks.append(span(name, monday, F.date_add(monday, 6)))
    return (
        years.select("year").distinct()
        .select(F.explode(F.array(*ranges, *weeks)).alias("v"))
        .select(
            F.explode(F.sequence("v.first", "v.last")).alias("event_date"),
            F.col("v.name").alias("name"),
            F.lit(VACATION_CATEGORY).alias("category"),
        )
    )


def year_range(spark, first: int, last: int) -> DataFrame:
    return spark.range(first, last + 1).select(F.col("id").cast("int").alias("year"))


def full_calendar(events: DataFrame, years: DataFrame, max_year: int) -> DataFrame:
    """Feed events with yearly repetition, then vacation days that are not there yet."""
    return append_missing(repeat_yearly(events, max_year), school_vacations(years), CALENDAR_COLUMNS)
