"""Small Column builders; all of them stay inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def count_where(condition: Column) -> Column:
    """Aggregate: rows for which the condition holds (a NULL condition does not count)."""
    return F.count_if(condition)


def sum_where(condition: Column, amount: Column) -> Column:
    """Aggregate: sum of the amount over rows for which the condition holds, 0 if there are none."""
    return F.sum(F.when(condition, amount).otherwise(F.lit(0.0)))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Double quotient, NULL where the denominator is 0 (plain division raises in ANSI mode)."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def percent(part: Column, whole: Column) -> Column:
    return F.try_divide((part * 100).cast("double"), whole.cast("double"))


def flag(condition: Column) -> Column:
    """1 / 0 for true / false; NULL stays NULL."""
    return condition.cast("int")


def day_key(day: Column) -> Column:
    """A date as the integer YYYYMMDD, by arithmetic rather than string formatting."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def days_between(start: Column, end: Column) -> Column:
    """Calendar midnights between two dates or timestamps (23:00 to 01:00 the next day is 1)."""
    return F.datediff(F.to_date(end), F.to_date(start))


def hour_number(time: Column, zoned: bool) -> Column:
    """Number of the whole hour a time lies in, free of clock changes in the session's time zone.

    `zoned` tells a timestamp (an instant) from a timestamp without a zone (a wall-clock reading).
    """
    if zoned:
        seconds = F.unix_seconds(time)
        return F.floor(seconds / 3600)
    return F.datediff(F.to_date(time), F.lit("1970-01-01").cast("date")) * 24 + F.hour(time)


def first_word(text: Column) -> Column:
    return F.split(text, " ", 2)[0]


def at_utc_offset(ts: Column, hours: int) -> Column:
    """Wall-clock time `hours` east of UTC, for timestamps without a zone that hold UTC."""
    # POSIX zone names carry the opposite sign: Etc/GMT-3 is three hours east.
    zone = f"Etc/GMT{-hours:+d}" if hours else "Etc/GMT"
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), ts)
