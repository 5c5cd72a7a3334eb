"""Date arithmetic on zone-less timestamps, counted in boundaries crossed."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F


def at(moment: datetime | date) -> Column:
    """Literal zone-less timestamp."""
    if not isinstance(moment, datetime):
        moment = datetime(moment.year, moment.month, moment.day)
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def shift(c: Column, delta: timedelta) -> Column:
    if not delta:
        return c
    return c + F.make_dt_interval(
        days=F.lit(delta.days), secs=F.lit(delta.seconds + delta.microseconds / 1e6)
    )


def day_diff(end: Column, start: Column) -> Column:
    """Midnights between the two moments."""
    return F.datediff(end, start)


def hour_diff(end: Column, start: Column) -> Column:
    """Full-hour marks between the two moments (10:59 to 11:01 is one)."""
    return F.datediff(end, start) * 24 + F.hour(end) - F.hour(start)


def in_window(c: Column, lo: Column, hi: Column) -> Column:
    """Half-open [lo, hi)."""
    return (c >= lo) & (c < hi)


def within_days(c: Column, as_of: Column, days: int) -> Column:
    """On or after the date that lies ``days`` before ``as_of``."""
    return c >= F.date_sub(as_of.cast("date"), days).cast("timestamp_ntz")


def send_hour(c: Column, local_hours: int) -> Column:
    return F.hour(shift(c, timedelta(hours=local_hours)))


def send_weekday(c: Column, local_hours: int) -> Column:
    return F.dayname(shift(c, timedelta(hours=local_hours)).cast("date"))
