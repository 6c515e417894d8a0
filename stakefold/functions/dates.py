"""Date and time expressions.

Business times carry no zone.  ``UTC_OFFSET_HOURS`` is a constant of the
business, never read from a clock.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

UTC_OFFSET_HOURS = 8


def hours(n: int | float) -> Column:
    return F.expr(f"INTERVAL '{int(n * 3600)}' SECOND")


def days(n: int) -> Column:
    return F.expr(f"INTERVAL '{int(n)}' DAY")


def to_local(ts: Column) -> Column:
    return ts + hours(UTC_OFFSET_HOURS)


def to_utc(ts: Column) -> Column:
    return ts - hours(UTC_OFFSET_HOURS)


def ts_lit(value: dt.datetime | None) -> Column:
    if value is None:
        return F.lit(None).cast("timestamp_ntz")
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def date_lit(value: dt.date | None) -> Column:
    return F.lit(value).cast("date")


def half_open(ts: Column, lo, hi) -> Column:
    """``lo <= ts < hi``."""
    return (ts >= lo) & (ts < hi)


def closed(ts: Column, lo, hi) -> Column:
    """``lo <= ts <= hi``."""
    return (ts >= lo) & (ts <= hi)


def window(ts: Column, lo: dt.datetime, hi: dt.datetime, ends: str) -> Column:
    """Time-window predicate with literal bounds, so that it reaches the scan.

    ``ends`` is ``"left"`` (half-open) or ``"both"`` (closed); callers must say
    which, because the two are not interchangeable at a period edge.
    """
    if ends == "left":
        return half_open(ts, ts_lit(lo), ts_lit(hi))
    if ends == "both":
        return closed(ts, ts_lit(lo), ts_lit(hi))
    raise ValueError(f"unknown window ends: {ends}")


def hour_rollover(day: Column, clock: Column) -> Column:
    """``HH:MM:SS`` on ``day``; an hour of 24 or more wraps onto the same day."""
    hh = F.left(clock, F.lit(2)).cast("int")
    hh = F.when(hh >= 24, hh - 24).otherwise(hh)
    mm = F.substring(clock, 4, 2).cast("int")
    ss = F.substring(clock, 7, 2).cast("int")
    return day.cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), hh, mm, ss.cast("decimal(18,6)"))


def week_start(day: Column) -> Column:
    """Monday of the week as a date."""
    return F.date_trunc("week", day).cast("date")


def half_week_columns(day: Column) -> tuple[Column, Column]:
    """Half-week settled on ``day``: Mon-Thu settles Fri..Sun, Fri-Sun settles Mon..Thu."""
    monday = week_start(day)
    early = F.weekday(day) < 4
    return (
        F.when(early, F.date_sub(monday, 3)).otherwise(monday),
        F.when(early, F.date_sub(monday, 1)).otherwise(F.date_add(monday, 3)),
    )


def half_week(day: dt.date) -> tuple[dt.date, dt.date]:
    """The same rule for a run parameter."""
    monday = day - dt.timedelta(days=day.weekday())
    if day.weekday() < 4:
        return monday - dt.timedelta(days=3), monday - dt.timedelta(days=1)
    return monday, monday + dt.timedelta(days=3)


def sunday_first_day_number(day: Column) -> Column:
    """1 = Sunday ... 7 = Saturday."""
    return F.dayofweek(day)


def clock_text(ts: Column) -> Column:
    return F.date_format(ts, "HH:mm:ss")


def dotted_date(ts: Column) -> Column:
    return F.date_format(ts, "dd.MM.yyyy")


def cut_seconds(ts: Column) -> Column:
    return F.date_trunc("second", ts).cast("timestamp_ntz")
