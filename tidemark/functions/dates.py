"""Date and time expressions.

Timestamps are zone-less unless said otherwise. Differences and cuts do not go
through the session time zone, whose clock changes would bend them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.numbers import rounded

# The hours at which a part of the day ends, with its name.
DAY_PARTS = ((6, "overnight"), (10, "morning rush"), (16, "midday"), (20, "evening rush"))
LAST_DAY_PART = "night"

# Microseconds in each unit of elapsed time.
MICROSECONDS = {"microsecond": 1, "millisecond": 1_000, "second": 1_000_000, "minute": 60_000_000, "hour": 3_600_000_000, "day": 86_400_000_000}


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def micros_between(start: Column | str, end: Column | str) -> Column:
    """Elapsed microseconds between two zone-less timestamps."""
    span = _col(end).cast("timestamp_ntz") - _col(start).cast("timestamp_ntz")
    whole = F.extract(F.lit("DAY"), span) * 86_400 + F.extract(F.lit("HOUR"), span) * 3_600 + F.extract(F.lit("MINUTE"), span) * 60
    return whole.cast("bigint") * 1_000_000 + (F.extract(F.lit("SECOND"), span) * 1_000_000).cast("bigint")


def truncate(unit: str, ts: Column | str) -> Column:
    """The start of the microsecond … year that a zone-less timestamp is in; weeks start on Monday."""
    unit, t = unit.lower(), _col(ts).cast("timestamp_ntz")
    day = F.to_date(t)
    if unit in ("week", "month", "quarter", "year"):
        return F.trunc(day, unit).cast("timestamp_ntz")
    start = day.cast("timestamp_ntz")
    if unit == "day":
        return start
    size = MICROSECONDS[unit]
    into = micros_between(start, t)
    return F.timestamp_add("MICROSECOND", into - into % size, start)


def day_part(ts: Column | str) -> Column:
    """The named part of the day that a timestamp falls in."""
    hour = F.hour(_col(ts))
    out = None
    for bound, name in DAY_PARTS:
        out = F.when(hour < bound, name) if out is None else out.when(hour < bound, name)
    return out.otherwise(LAST_DAY_PART)


def iso_weekday(ts: Column | str) -> Column:
    """Monday is 1, Sunday is 7."""
    return F.weekday(_col(ts)) + 1


def minutes_between(start: Column | str, end: Column | str, places: int = 2) -> Column:
    """Elapsed minutes, rounded."""
    return rounded(micros_between(start, end) / F.lit(60_000_000.0), places)


def plus(ts: Column | str, interval: str) -> Column:
    """``ts`` plus an interval such as ``'12 hours'`` or ``'-6 hours'``."""
    return _col(ts) + F.expr(f"INTERVAL '{interval}'")


def date_add_unit(unit: str, amount: Column | int, value: Column | str) -> Column:
    """``value`` moved by whole units; a timestamp."""
    n = amount if isinstance(amount, Column) else F.lit(amount)
    return F.timestamp_add(unit.upper(), n.cast("int"), _col(value).cast("timestamp_ntz"))


def boundaries_between(unit: str, start: Column | str, end: Column | str) -> Column:
    """How many ``unit`` boundaries lie between two instants; negative if reversed.

    One minute before midnight to one minute after is one day: both sides are
    cut to the unit first, and whole units are counted then.
    """
    unit = unit.lower()
    a, b = (truncate(unit, c) for c in (start, end))
    if unit in ("month", "quarter", "year"):
        months = (F.year(b) - F.year(a)) * 12 + F.month(b) - F.month(a)
        return F.call_function("div", months, F.lit({"month": 1, "quarter": 3, "year": 12}[unit])).cast("bigint")
    return _whole(micros_between(a, b), unit)


def elapsed(unit: str, start: Column | str, end: Column | str) -> Column:
    """How many whole units have passed, cut towards zero."""
    unit = unit.lower()
    if unit in ("month", "quarter", "year"):
        return F.timestamp_diff(unit.upper(), _col(start), _col(end))
    return _whole(micros_between(start, end), unit)


def _whole(micros: Column, unit: str) -> Column:
    """Whole units in a number of microseconds, cut towards zero."""
    size = 7 * MICROSECONDS["day"] if unit == "week" else MICROSECONDS[unit]
    return F.call_function("div", micros, F.lit(size))


def last_day_of(period: str, value: Column | str) -> Column:
    """The last date of the month, quarter or year that ``value`` is in."""
    months = {"month": 1, "quarter": 3, "year": 12}[period]
    first = F.trunc(F.to_date(_col(value)), period)
    return F.date_sub(F.add_months(first, months), 1)


def day_name(value: Column | str, short: bool = True) -> Column:
    """English day name without padding."""
    return F.date_format(_col(value), "EEE" if short else "EEEE")


def month_name(value: Column | str, short: bool = True) -> Column:
    """English month name without padding."""
    return F.date_format(_col(value), "MMM" if short else "MMMM")


def iso_week_start(value: Column | str) -> Column:
    """The Monday of the ISO week."""
    d = F.to_date(_col(value))
    return F.date_sub(d, F.weekday(d))


def week_start(value: Column | str) -> Column:
    """The Sunday that starts the calendar week."""
    d = F.to_date(_col(value))
    return F.date_sub(d, F.dayofweek(d) - 1)


def week_end(value: Column | str) -> Column:
    """The Saturday that ends the calendar week."""
    return F.date_add(week_start(value), 6)


def iso_week_of_year(value: Column | str) -> Column:
    return F.weekofyear(_col(value))


def week_of_year(value: Column | str) -> Column:
    """The week counted from 1 January: days 1 to 7 are week 1, whatever weekday they are."""
    return (F.floor((F.dayofyear(_col(value)) - 1) / 7) + 1).cast("int")


def format_timestamp(ts: Column | str, pattern: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    return F.date_format(_col(ts), pattern)


def timestamp_text(ts: Column | str) -> Column:
    """The shortest text: a fraction only where there is one, no trailing zeros."""
    return _col(ts).cast("timestamp_ntz").cast("string")


def to_zone(ts: Column | str, source: str, target: str) -> Column:
    """Wall-clock time in ``source`` shown as wall-clock time in ``target``."""
    return F.convert_timezone(F.lit(source), F.lit(target), _col(ts))


def utc_now() -> Column:
    """The current instant as zone-less UTC."""
    return F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()).cast("timestamp_ntz")


def local_now() -> Column:
    """The current wall-clock time in the session zone."""
    return F.localtimestamp()


def round_time(unit: str, ts: Column | str) -> Column:
    """Reduce precision by rounding to the nearest unit, half up."""
    half = MICROSECONDS[unit] // 2
    return truncate(unit, F.timestamp_add("MICROSECOND", F.lit(half), _col(ts).cast("timestamp_ntz")))
