import collections
import datetime

from pyspark.sql import functions as F

from conftest import rows
from spoorlens.operators import calendar
from spoorlens.schemas import CALENDAR_COLUMNS
from spoorlens.sources import readers

D = datetime.date
FEED = (
    "BEGIN:VCALENDAR\r\nDTSTART:19990101\r\nSUMMARY:Not an event\r\n"
    "BEGIN:VEVENT\r\nDTSTART;VALUE=DATE:20200101\r\nSUMMARY:Nieuwjaar (New Year)\r\nEND:VEVENT\r\n"
    "BEGIN:VEVENT\r\nDTSTART;TZID=Europe/Amsterdam:20200329T020000\r\nSUMMARY:Zomertijd (Summer TIME)\r\nEND:VEVENT\r\n"
    "BEGIN:VEVENT\r\nSUMMARY:No date\r\nEND:VEVENT\r\n"
    "BEGIN:VEVENT\r\nDTSTART:20200230\r\nSUMMARY:Bad date\r\nEND:VEVENT\r\n"
    "BEGIN:VEVENT\r\nDTSTART:20200427\r\nEND:VEVENT\r\n"
    "BEGIN:VEVENT\r\nDTSTART:20200501\r\nDTSTART:20200505\r\nSUMMARY:a\r\nSUMMARY:Bevrijdings\r\n dag\r\nEND:VEVENT\r\n"
    "BEGIN:VEVENT\r\nDTSTART:20210101\r\nSUMMARY:begun twice\r\nBEGIN:VEVENT\r\nDTSTART:20210202\r\nEND:VEVENT\r\n"
    "BEGIN:VEVENT\r\nDTSTART:20220101\r\nSUMMARY:never ended\r\n"
)
EVENTS = [
    (D(2020, 1, 1), "New Year", "Holiday"),
    (D(2020, 3, 29), "Summer TIME", "Time change"),
    (D(2020, 4, 27), "", "Holiday"),
    (D(2020, 5, 5), "Bevrijdingsdag", "Holiday"),
    (D(2021, 2, 2), "", "Holiday"),
]


def test_feed_text(spark):
    df = spark.createDataFrame([(FEED,)], "text string")
    assert rows(calendar.events_in_text(df, "text", [F.lit("")]), *CALENDAR_COLUMNS) == EVENTS


def test_feed_files(spark, folder):
    for name, text in (("a.ics", FEED), ("b.ics", FEED.replace("\r\n", "\n").replace(":202", ":203"))):
        with open(f"{folder}/{name}", "w", newline="") as fh:
            fh.write(text)
    got = readers.read_ical(spark, f"{folder}/*.ics")
    later = [(D(d.year + 10, d.month, d.day), n, c) for d, n, c in EVENTS]
    assert rows(got, *CALENDAR_COLUMNS) == sorted(EVENTS + later)


def _events(spark, data):
    return spark.createDataFrame([(*r, n) for n, r in enumerate(data)], "event_date date, name string, category string, seq int")


def test_names_with_one_date_are_repeated(spark):
    given = [
        (D(2020, 1, 1), "a", "Holiday"), (D(2020, 1, 1), "a", "Time change"),  # one distinct date, listed twice
        (D(2020, 2, 29), "leap", "Holiday"), (D(2020, 3, 1), "twice", "Holiday"), (D(2021, 3, 1), "twice", "Holiday"),
        (D(2020, 4, 1), "", "Holiday"), (D(2024, 5, 1), "late", "Holiday"), (D(2030, 5, 1), "later", "Holiday"),
    ]
    got = rows(calendar.repeat_yearly(_events(spark, given), 2024))
    added = [(D(y, 1, 1), "a", "Holiday") for y in range(2021, 2025)] + [(D(2024, 2, 29), "leap", "Holiday")]
    assert got == sorted(given + added)


def test_vacation_days(spark):
    got = rows(calendar.school_vacations(calendar.year_range(spark, 2015, 2025)))
    assert len(got) == len(set(got)) == 825
    assert collections.Counter(name for _, name, _ in got) == {
        "Autumn vacation": 77, "Christmas vacation": 132, "May vacation": 77, "Spring vacation": 77, "Summer vacation": 462,
    }
    assert (got[0][0], got[-1][0]) == (D(2015, 2, 9), D(2026, 1, 4))
    weeks = [d for d, name, _ in got if name == "Spring vacation" and d.year == 2024]
    assert weeks == [D(2024, 2, 12) + datetime.timedelta(n) for n in range(7)]


def test_full_calendar_adds_vacations_once(spark):
    given = [(D(2020, 7, 15), "Summer vacation", "Vacation"), (D(2021, 7, 20), "Summer vacation", "Vacation"),
             (D(2020, 7, 16), "Summer vacation", "Holiday")]
    got = rows(calendar.full_calendar(_events(spark, given), calendar.year_range(spark, 2020, 2021), 2021))
    days = rows(calendar.school_vacations(calendar.year_range(spark, 2020, 2021)))
    assert got == sorted(set(days) | set(given))
