"""Time arithmetic on epoch seconds."""

from __future__ import annotations

from enum import Enum

from pyspark.sql import Column
from pyspark.sql import functions as F

HOUR = 3_600
DAY = 24 * HOUR
WEEK = 7 * DAY


class Level(str, Enum):
    """Calendar-aligned reporting windows."""

    LAST_HOUR = "last_hour"
    LAST_DAY = "last_day"
    LAST_WEEK = "last_week"
    LAST_MONTH = "last_month"
    ALLTIME = "alltime"


LEVELS = tuple(level.value for level in Level)


def window_start(level: str | Level, as_of: int, month_days: int = 30) -> int:
    """First second of the window that contains ``as_of``; 0 for all time.

    Windows are multiples of their length since the epoch, so weeks start on
    Thursday and a month is ``month_days`` days. Unknown levels raise.
    """
    level = Level(level)
    if level is Level.ALLTIME:
        return 0
    size = {
        Level.LAST_HOUR: HOUR,
        Level.LAST_DAY: DAY,
        Level.LAST_WEEK: WEEK,
        Level.LAST_MONTH: month_days * DAY,
    }[level]
    return as_of - as_of % size


def window_starts(as_of: int, month_days: int = 30) -> dict[str, int]:
    return {level: window_start(level, as_of, month_days) for level in LEVELS}


def hour_bucket(seconds: Column) -> Column:
    return seconds - seconds % HOUR


def hour_of_day(seconds: Column) -> Column:
    return F.floor((seconds % DAY) / HOUR)


def minute_index(seconds: Column) -> Column:
    return F.floor(seconds / 60).cast("int")


def event_time(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds)


def render_time(seconds: Column) -> Column:
    return F.from_unixtime(seconds)


def day_of(seconds: Column) -> Column:
    return F.to_date(F.timestamp_seconds(seconds))
