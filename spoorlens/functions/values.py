"""Typed parsing, keys, times and ratios.

Spark 4 runs in ANSI mode, where a bad value stops the job; raw files do hold blanks
and junk, so every parse here gives null instead.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# A plain number, of which the whole part is taken: "12", " 12 ", "12.0".
_WHOLE_PART = r"^\s*([+-]?\d+)(?:\.\d*)?\s*$"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _filled(c: str | Column) -> Column:
    """Null for a blank. A cast that fails costs far more than one of null, and files
    leave many values blank."""
    c = _col(c)
    return F.when(c.cast("string") != "", c)


def to_int(c: str | Column) -> Column:
    return _filled(F.regexp_extract(_col(c).cast("string"), _WHOLE_PART, 1)).try_cast("int")


def to_double(c: str | Column) -> Column:
    return _filled(c).try_cast("double")


def to_flag(c: str | Column) -> Column:
    return _filled(c).try_cast("boolean")


def to_day(c: str | Column) -> Column:
    return _filled(c).try_cast("date")


def to_instant(c: str | Column) -> Column:
    return _filled(c).try_cast("timestamp")


def station_key(c: str | Column) -> Column:
    return F.upper(F.trim(_col(c)))


def event_time(arrival: str | Column, departure: str | Column, prefer: str) -> Column:
    """Time of a stop. The stop table prefers departure, the delay report arrival."""
    if prefer not in ("arrival", "departure"):
        raise ValueError(f"prefer must be 'arrival' or 'departure', not {prefer!r}")
    pair = [_col(arrival), _col(departure)]
    return F.coalesce(*(pair if prefer == "arrival" else reversed(pair)))


def delay_minutes(arrival_delay: str | Column, departure_delay: str | Column) -> Column:
    """Arrival delay, else departure delay, else 0: an unknown delay counts as on time."""
    return F.coalesce(_col(arrival_delay), _col(departure_delay), F.lit(0.0)).cast("double")


def share(part: str | Column, whole: str | Column) -> Column:
    """part / whole, and 0.0 where there is nothing to divide by."""
    part, whole = _col(part), _col(whole)
    return F.when(whole > 0, (part / whole).cast("double")).otherwise(F.lit(0.0))


def month_key(ts: str | Column) -> Column:
    return F.date_format(_col(ts), "yyyy-MM")


def season(day: str | Column) -> Column:
    """Season by calendar day, as a number such as 1221 for 21 December."""
    day = _col(day)
    mmdd = F.month(day) * 100 + F.dayofmonth(day)
    return (
        F.when((mmdd >= 1221) | (mmdd <= 319), "winter")
        .when(mmdd <= 620, "spring")
        .when(mmdd <= 922, "summer")
        .when(mmdd <= 1220, "autumn")
    )


def is_month(day: str | Column, year: int, month: int) -> Column:
    day = _col(day)
    return (F.year(day) == year) & (F.month(day) == month)


def is_short_delay(minutes: str | Column) -> Column:
    minutes = _col(minutes)
    return (minutes > 0) & (minutes < 3)


def is_long_delay(minutes: str | Column) -> Column:
    return _col(minutes) > 10


def epoch_to_instant(name: str) -> Column:
    """Long epoch in seconds, milli-, micro- or nanoseconds, told apart by magnitude.

    The bounds keep every unit apart for dates between 1973 and 5138.
    """
    n, size = F.col(name), F.abs(F.col(name))
    whole_micros = F.expr(f"(`{name}` - pmod(`{name}`, 1000)) div 1000")
    return (
        F.when(size < 10**11, F.timestamp_seconds(n))
        .when(size < 10**14, F.timestamp_millis(n))
        .when(size < 10**17, F.timestamp_micros(n))
        .otherwise(F.timestamp_micros(whole_micros))
    )


def all_present(*cols: str) -> Column:
    cond = F.col(cols[0]).isNotNull()
    for c in cols[1:]:
        cond = cond & F.col(c).isNotNull()
    return cond


def any_missing(*cols: str) -> Column:
    return ~all_present(*cols)


def any_present(*cols: str) -> Column:
    if not cols:
        return F.lit(False)
    return F.coalesce(*[F.col(c).cast("string") for c in cols]).isNotNull()
