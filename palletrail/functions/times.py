"""Time expressions.

Ledger times are stored in UTC without a zone (TIMESTAMP_NTZ).  Functions that need a
local clock take the zone as an argument and convert explicitly.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, time, timedelta, timezone
from zoneinfo import ZoneInfo

from pyspark.sql import Column, functions as F

from palletrail.config import SHIFTS, SITE_ZONE, Shift

STAMP = "dd.MM.yyyy HH:mm:ss"


def seconds_of_day(when: Column) -> Column:
    return F.hour(when) * 3600 + F.minute(when) * 60 + F.second(when)


def _clock(text: str) -> int:
    at = time.fromisoformat(text)
    return at.hour * 3600 + at.minute * 60 + at.second


def local_time(when: Column, zone: str | None) -> Column:
    """Stored UTC time on the clock of ``zone``; without a zone the stored time itself."""
    if zone is None:
        return when
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), when)


def shift_of(when: Column, shifts: Sequence[Shift] = SHIFTS, zone: str | None = None) -> Column:
    """Shift number of a time of day, NULL between shifts.

    The default reads the stored time as it is; give ``zone`` to use the local clock.
    """
    second = seconds_of_day(local_time(when, zone))
    number = F.lit(None).cast("int")
    for shift in reversed(shifts):
        inside = second.between(_clock(shift.start), _clock(shift.end))
        number = F.when(inside, F.lit(shift.number)).otherwise(number)
    return number


def in_shift(second: Column, shift: Shift) -> Column:
    return second.between(_clock(shift.start), _clock(shift.end))


def iso_day(when: Column) -> Column:
    return F.to_date(when).cast("string")


def day_text(when: Column) -> Column:
    return F.date_format(when, "dd.MM.yyyy")


def stamp_text(when: Column) -> Column:
    return F.date_format(when, STAMP)


def month_key(when: Column) -> Column:
    return F.date_format(when, "yyyy_MM")


def stamp_to_date(text: Column) -> Column:
    """Date of a ``dd.MM.yyyy HH:mm:ss`` text, read by position."""
    iso = F.concat_ws("-", F.substring(text, 7, 4), F.substring(text, 4, 2), F.substring(text, 1, 2))
    return iso.try_cast("date")


def stamp_to_seconds(text: Column) -> Column:
    """Second of the day from the last eight characters, ``HH:mm:ss``."""
    hour, minute, second = (F.substring(text, at, 2).try_cast("int") for at in (-8, -5, -2))
    return hour * 3600 + minute * 60 + second


def week_number(day: Column) -> Column:
    """Week of the year counted from Sunday, with January 1 always in week 1."""
    new_year = F.trunc(day, "year")
    return F.floor((F.dayofyear(day) + F.dayofweek(new_year) - 2) / 7).cast("int") + 1


def utc_window(day: Column, shifts: Sequence[Shift] = SHIFTS, zone: str = SITE_ZONE) -> tuple[Column, Column]:
    """UTC start and end of the shifts of a local day."""
    return tuple(
        F.convert_timezone(F.lit(zone), F.lit("UTC"), day.cast("timestamp_ntz") + F.expr(f"interval {_clock(at)} seconds"))
        for at in (shifts[0].start, shifts[-1].end)
    )


def month_window(day: Column, zone: str = SITE_ZONE) -> tuple[Column, Column, Column]:
    """UTC start and end of the local month around ``day``, and its ``MM.yyyy`` label."""
    first = F.trunc(day, "month").cast("timestamp_ntz")
    last = F.last_day(day).cast("timestamp_ntz") + F.expr("interval 86399 seconds")
    bounds = [F.convert_timezone(F.lit(zone), F.lit("UTC"), at) for at in (first, last)]
    return bounds[0], bounds[1], F.date_format(day, "MM.yyyy")


# The same two windows for a single run, as parameters of a report -------------------


def _to_utc(local: datetime, zone: str) -> datetime:
    return local.replace(tzinfo=ZoneInfo(zone)).astimezone(timezone.utc).replace(tzinfo=None)


def run_window(day: date, shifts: Sequence[Shift] = SHIFTS, zone: str = SITE_ZONE) -> tuple[datetime, datetime]:
    start, end = time.fromisoformat(shifts[0].start), time.fromisoformat(shifts[-1].end)
    return _to_utc(datetime.combine(day, start), zone), _to_utc(datetime.combine(day, end), zone)


def run_month(day: date, zone: str = SITE_ZONE) -> tuple[datetime, datetime, str]:
    first = day.replace(day=1)
    following = (first + timedelta(days=32)).replace(day=1)
    last = datetime.combine(following, time()) - timedelta(seconds=1)
    return _to_utc(datetime.combine(first, time()), zone), _to_utc(last, zone), f"{first:%m.%Y}"
