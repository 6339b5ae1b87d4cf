"""Time keys and ranges.

Observation times are local wall-clock hours. They are kept as
TIMESTAMP_NTZ so that the date and hour keys do not depend on the session
time zone.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_local_time(text: str | Column) -> Column:
    """``2023-01-01T00:00`` (ISO local time, minutes precision) → TIMESTAMP_NTZ."""
    return F.to_timestamp_ntz(_col(text))


def wall_clock(instant: Column, zone: str) -> Column:
    """The TIMESTAMP_NTZ that a clock in ``zone`` shows at a TIMESTAMP,
    whatever the session's zone."""
    micros = F.unix_micros(F.from_utc_timestamp(instant, zone))
    return F.timestamp_add("MICROSECOND", micros, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def date_key(ts: str | Column) -> Column:
    return F.to_date(_col(ts))


def hour_key(ts: str | Column) -> Column:
    return F.hour(_col(ts))


def hour_start(ts: str | Column) -> Column:
    """Start of the hour of a TIMESTAMP_NTZ, as TIMESTAMP_NTZ.

    Built from the date-time fields: ``date_trunc`` and ``date_format``
    convert through the session zone and move wall-clock times that fall
    in a daylight-saving gap.
    """
    t = _col(ts)
    return F.make_timestamp_ntz(F.year(t), F.month(t), F.dayofmonth(t), F.hour(t),
                                F.lit(0), F.lit(0))


def format_local_minute(ts: str | Column) -> Column:
    """``yyyy-MM-ddTHH:mm`` text of a TIMESTAMP_NTZ, zone-free."""
    t = _col(ts)
    return F.format_string("%04d-%02d-%02dT%02d:%02d", F.year(t), F.month(t),
                           F.dayofmonth(t), F.hour(t), F.minute(t))


def ntz_literal(value: dt.datetime | dt.date | str) -> Column:
    """A TIMESTAMP_NTZ literal built from text, so neither the Python
    process's local zone nor the session zone can shift it."""
    if isinstance(value, dt.datetime):
        text = value.isoformat(sep=" ")
    elif isinstance(value, dt.date):
        text = value.isoformat() + " 00:00:00"
    else:
        text = value
    return F.lit(text).cast("timestamp_ntz")


def between_inclusive(ts: str | Column, start: str, end: str) -> Column:
    """SQL ``BETWEEN start AND end`` on a timestamp.

    With date literals the upper bound is midnight at the start of ``end``,
    so most of the last day is excluded (quirk Q8), exactly as in SQL.
    """
    lo = ntz_literal(dt.datetime.fromisoformat(start))
    hi = ntz_literal(dt.datetime.fromisoformat(end))
    return _col(ts).between(lo, hi)


def within_days(ts: str | Column, first_day: str, last_day: str) -> Column:
    """Half-open form covering whole days: ``first_day <= ts < last_day + 1``."""
    lo = dt.datetime.fromisoformat(first_day)
    hi = dt.datetime.fromisoformat(last_day) + dt.timedelta(days=1)
    c = _col(ts)
    return (c >= ntz_literal(lo)) & (c < ntz_literal(hi))
