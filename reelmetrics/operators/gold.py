"""Second-level rollups: silver counters to serving rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelmetrics.functions.measures import VIEWS_LIKES_MINUTES, count_of
from reelmetrics.functions.timing import LEVELS, Level, window_start, window_starts

WINDOW_LEVELS = tuple(level for level in LEVELS if level != Level.ALLTIME.value)


def _within(silver: DataFrame, start: int, as_of: int | None = None) -> DataFrame:
    """Hours from ``start`` to the one that holds ``as_of``; without it there is no end."""
    rows = silver.where(F.col("hour_timestamp") >= start)
    if as_of is not None:
        rows = rows.where(F.col("hour_timestamp") <= as_of)
    if "event_date" in silver.columns:
        rows = rows.where(F.col("event_date") >= F.to_date(F.timestamp_seconds(F.lit(start))))
    return rows


def _endless(level: str) -> bool:
    return level == Level.ALLTIME.value


def _sums(measures: Sequence[str]):
    return [F.sum(m).alias(m) for m in measures]


def channel_ages(silver: DataFrame) -> DataFrame:
    return silver.groupBy("channel_id", "age").agg(*_sums(VIEWS_LIKES_MINUTES))


def channel_countries(silver: DataFrame) -> DataFrame:
    return silver.groupBy("channel_id", "country").agg(*_sums(VIEWS_LIKES_MINUTES))


def window_totals(
    silver: DataFrame, key: str, level: str, as_of: int, month_days: int = 30
) -> DataFrame:
    """Counters per ``key`` from the start of the window that holds ``as_of`` to its hour.

    All time has no end.
    """
    start = window_start(level, as_of, month_days)
    end = None if Level(level) is Level.ALLTIME else as_of
    return _within(silver, start, end).groupBy(key).agg(*_sums(VIEWS_LIKES_MINUTES))


def window_totals_all(
    silver: DataFrame,
    key: str,
    as_of: int,
    month_days: int = 30,
    levels: Sequence[str] = LEVELS,
) -> DataFrame:
    """Several levels as rows ``(level, key, counters)`` from one scan and exchange.

    Only hours since the earliest of the levels are read.
    """
    starts = {level: window_start(level, as_of, month_days) for level in levels}
    hour = F.col("hour_timestamp")

    def inside(level: str, start: int) -> Column:
        return hour >= start if level == Level.ALLTIME.value else hour.between(start, as_of)

    wide = (
        _within(silver, min(starts.values()), None if Level.ALLTIME.value in starts else as_of)
        .groupBy(key)
        .agg(
            F.max(hour).alias("last_hour_ever"),
            F.max(F.when(hour <= as_of, hour)).alias("last_hour_seen"),
            *(
                F.sum(F.when(inside(level, start), F.col(m)).otherwise(0)).alias(f"{level}__{m}")
                for level, start in starts.items()
                for m in VIEWS_LIKES_MINUTES
            ),
        )
    )
    rows = F.array(
        *(
            F.struct(
                F.lit(level).alias("level"),
                F.lit(start).cast("long").alias("start"),
                *(F.col(f"{level}__{m}").alias(m) for m in VIEWS_LIKES_MINUTES),
            )
            for level, start in starts.items()
        )
    )
    return (
        wide.select(key, "last_hour_seen", "last_hour_ever", F.inline(rows))
        .where(
            F.when(F.col("level") == Level.ALLTIME.value, F.col("last_hour_ever")).otherwise(
                F.col("last_hour_seen")
            )
            >= F.col("start")
        )
        .select("level", key, *VIEWS_LIKES_MINUTES)
    )


def window_totals_served(
    hours: DataFrame, totals: DataFrame, key: str, as_of: int, month_days: int = 30
) -> DataFrame:
    """All levels: the windows from recent hours, all time from the kept totals."""
    alltime = totals.groupBy(key).agg(*_sums(VIEWS_LIKES_MINUTES))
    return window_totals_all(hours, key, as_of, month_days, WINDOW_LEVELS).unionByName(
        alltime.select(F.lit(Level.ALLTIME.value).alias("level"), key, *VIEWS_LIKES_MINUTES)
    )


def window_totals_raw(log: DataFrame, key: str) -> DataFrame:
    """Counters per ``key`` straight from log rows already limited to a window."""
    return (
        log.where(F.col("action").isin("first_views", "likes", "views"))
        .groupBy(key)
        .agg(*(count_of(m) for m in VIEWS_LIKES_MINUTES))
    )


def _levels_from_one_row(totals: DataFrame) -> DataFrame:
    rows = F.array(
        *(
            F.struct(
                F.lit(level).alias("level"),
                *(F.col(f"{level}__{m}").alias(m) for m in VIEWS_LIKES_MINUTES),
            )
            for level in LEVELS
        )
    )
    return totals.select(F.inline(rows))


def history_of_levels(windows: DataFrame, key: str, value: int) -> DataFrame:
    """``history`` from rows ``(level, key, counters)``; a missing level is zero."""
    totals = windows.where(F.col(key) == F.lit(int(value))).agg(
        *(
            F.coalesce(F.sum(F.when(F.col("level") == level, F.col(m))), F.lit(0)).alias(
                f"{level}__{m}"
            )
            for level in LEVELS
            for m in VIEWS_LIKES_MINUTES
        )
    )
    return _levels_from_one_row(totals)


def history(silver: DataFrame, key: str, value: int, as_of: int, month_days: int = 30) -> DataFrame:
    """Five rows for one video or channel; no activity gives zeros."""
    hour = F.col("hour_timestamp")
    totals = silver.where(F.col(key) == F.lit(int(value))).agg(
        *(
            F.coalesce(
                F.sum(F.when((hour >= start) & (F.lit(_endless(level)) | (hour <= as_of)), F.col(m))),
                F.lit(0),
            ).alias(f"{level}__{m}")
            for level, start in window_starts(as_of, month_days).items()
            for m in VIEWS_LIKES_MINUTES
        )
    )
    return _levels_from_one_row(totals)


def history_raw(
    log: DataFrame, key: str, value: int, as_of: int, month_days: int = 30
) -> DataFrame:
    """``history`` straight from the log, in one pass."""
    seconds = F.col("timestamp_seconds")
    totals = log.where(F.col(key) == F.lit(int(value))).agg(
        *(
            count_of(m, (seconds >= start) & (F.lit(_endless(level)) | (seconds <= as_of))).alias(
                f"{level}__{m}"
            )
            for level, start in window_starts(as_of, month_days).items()
            for m in VIEWS_LIKES_MINUTES
        )
    )
    return _levels_from_one_row(totals)
