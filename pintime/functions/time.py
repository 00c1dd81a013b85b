"""Time helpers. Every timestamp stays ``timestamp_ntz`` so results do not
depend on the session time zone."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F


def ts_lit(value: str | date | datetime) -> Column:
    """A ``timestamp_ntz`` literal from ISO text or a naive date/datetime.

    Goes through text on purpose: a Python ``datetime`` literal would be read
    in the driver's local zone and become a zoned timestamp.
    """
    if isinstance(value, datetime):
        text = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    elif isinstance(value, date):
        text = value.strftime("%Y-%m-%d 00:00:00")
    else:
        text = str(value)
    return F.to_timestamp_ntz(F.lit(text))


def interval(delta: timedelta) -> Column:
    """A day-time interval literal (FN-6: ``ts - timedelta``)."""
    return F.lit(delta)


def date_to_ts(c: Column | str) -> Column:
    """FN-1 ``TIMESTAMP(date)``: midnight of the date, zone free."""
    return F.to_timestamp_ntz(F.to_date(c))


def week_ending_monday(d: Column | str) -> Column:
    """Weekly bin label of pandas ``W-MON``: bins run Tue..Mon and carry the
    closing Monday as label. A Monday maps to itself, Tuesday to the next one.
    """
    return F.next_day(F.date_sub(F.to_date(d), 1), "Mon")


def day_bucket(ts: Column | str, days: int) -> Column:
    """Integer time bucket of ``days`` width, counted from 1970-01-01."""
    return F.floor(F.datediff(F.to_date(ts), F.lit("1970-01-01").cast("date")) / F.lit(days)).cast("long")
