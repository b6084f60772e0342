"""Rollups of the action log.

Each rollup is one conditional aggregation: counters are partially summed on
the map side, so a single exchange moves at most one row per group and task
however many log rows a group has.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelmetrics.functions import timing
from reelmetrics.functions.measures import (
    VIEWS_LIKES_MINUTES,
    actions_of,
    count_of,
    is_negative,
    is_polar,
    is_positive,
)

SECONDS = "timestamp_seconds"


def union_actions(logs: Sequence[DataFrame]) -> DataFrame:
    """One log from several; columns a log lacks become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), logs)


def between(log: DataFrame, start: int, end: int) -> DataFrame:
    """Rows with ``start <= timestamp_seconds < end``.

    A log partitioned by ``event_date`` is also limited to those dates.
    """
    seconds = F.col(SECONDS)
    rows = log.where((seconds >= start) & (seconds < end))
    if "event_date" in log.columns:
        rows = rows.where(
            F.col("event_date").between(
                timing.day_of(F.lit(start)), timing.day_of(F.lit(max(start, end - 1)))
            )
        )
    return rows


def rolling(log: DataFrame, as_of: int, seconds: int) -> DataFrame:
    """Rows of the last ``seconds`` seconds before ``as_of``, and later ones."""
    rows = log.where(F.col(SECONDS) >= as_of - seconds)
    if "event_date" in log.columns:
        rows = rows.where(F.col("event_date") >= timing.day_of(F.lit(as_of - seconds)))
    return rows


def by_id(frame: DataFrame, column: str, value: int) -> DataFrame:
    return frame.where(F.col(column) == F.lit(int(value)))


def high_water(log: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Newest second, overall or per ``by``."""
    return log.groupBy(*by).agg(F.max(SECONDS).alias("high_water"))


def rollup(log: DataFrame, keys: Sequence[str | Column], measures: Iterable[str]) -> DataFrame:
    """Count each measure's action per ``keys``; only those actions are read."""
    measures = list(measures)
    return (
        log.where(F.col("action").isin(*actions_of(measures)))
        .groupBy(*keys)
        .agg(*(count_of(m) for m in measures))
    )


def _hour() -> Column:
    return timing.hour_bucket(F.col(SECONDS)).alias("hour_timestamp")


def video_hour(log: DataFrame) -> DataFrame:
    return rollup(log, ["video_id", _hour()], VIEWS_LIKES_MINUTES)


def channel_hour(log: DataFrame) -> DataFrame:
    return rollup(log, ["channel_id", _hour()], (*VIEWS_LIKES_MINUTES, "subscribes_count"))


def video_total(log: DataFrame) -> DataFrame:
    """All-time counters, kept so that they need not be summed over all hours."""
    return rollup(log, ["video_id"], VIEWS_LIKES_MINUTES)


def channel_total(log: DataFrame) -> DataFrame:
    return rollup(log, ["channel_id"], (*VIEWS_LIKES_MINUTES, "subscribes_count"))


def ages(log: DataFrame) -> DataFrame:
    age = F.col("user_age").alias("age")
    return rollup(log, ["video_id", "channel_id", age], VIEWS_LIKES_MINUTES)


def countries(log: DataFrame) -> DataFrame:
    country = F.col("user_country").alias("country")
    return rollup(log, ["video_id", "channel_id", country], VIEWS_LIKES_MINUTES)


def interaction(log: DataFrame) -> DataFrame:
    country = F.col("user_country").alias("country")
    hour = timing.hour_of_day(F.col(SECONDS)).alias("hour_offset")
    return rollup(log, ["video_id", "channel_id", country, hour], ["views_count"])


def country_views(log: DataFrame) -> DataFrame:
    return rollup(log, [F.col("user_country").alias("country")], ["views_count"])


def comment_counts(comments: DataFrame) -> DataFrame:
    """Per video: non-neutral, all and positive comments."""
    score = F.col("comment_score")
    return comments.groupBy("video_id").agg(
        F.count_if(is_polar(score)).alias("comments_count"),
        F.count(F.lit(1)).alias("all_comments_count"),
        F.count_if(is_positive(score)).alias("positive_count"),
    )


def comment_polarity(comments: DataFrame) -> DataFrame:
    """Per video: positive and negative comments."""
    score = F.col("comment_score")
    return comments.groupBy("video_id").agg(
        F.count_if(is_positive(score)).alias("positive_count"),
        F.count_if(is_negative(score)).alias("negative_count"),
    )


def video_minute(log: DataFrame) -> DataFrame:
    """Per video and minute of the video: watched minutes and likes."""
    return (
        log.where(F.col("action").isin("views", "likes"))
        .groupBy("video_id", F.col("seconds_offset").alias("minutes_offset"))
        .agg(
            F.count_if(F.col("action") == "views").alias("views_count"),
            F.count_if(F.col("action") == "likes").alias("likes_count"),
        )
    )


def channel_counts(log: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """First views per channel and any further attributes."""
    return (
        log.where(F.col("action") == "first_views")
        .groupBy("channel_id", *by)
        .agg(F.count(F.lit(1)).alias("channel_views"))
    )


def channel_minute(log: DataFrame) -> DataFrame:
    """Watched minutes per channel and minute of the video."""
    return (
        log.where(F.col("action") == "views")
        .groupBy("channel_id", "seconds_offset")
        .agg(F.count(F.lit(1)).alias("weighted_channel_views"))
    )


def video_totals(log: DataFrame) -> DataFrame:
    return rollup(log, ["video_id", "channel_id"], ["views_count"])


def record_counts(log: DataFrame) -> DataFrame:
    """Rows per action and, as action ``all``, of the whole log.

    The total is rolled up from the counts, not from the rows.
    """
    counts = log.groupBy("action").agg(F.count(F.lit(1)).alias("n"))
    return (
        counts.rollup("action")
        .agg(F.sum("n").alias("records"), F.grouping("action").alias("is_total"))
        .select(
            F.when(F.col("is_total") == 1, "all").otherwise(F.col("action")).alias("action"),
            "records",
        )
    )


def record_total(log: DataFrame) -> DataFrame:
    return log.agg(F.count(F.lit(1)).alias("records"))


# Silver table name to its rollup of a bronze log (comments already scored).
SILVER_ROLLUPS = {
    "video_hour": video_hour,
    "channel_hour": channel_hour,
    "video_total": video_total,
    "channel_total": channel_total,
    "ages": ages,
    "countries": countries,
    "interaction": interaction,
    "comment": lambda log: comment_counts(log.where(F.col("action") == "comments")),
    "country_views": country_views,
    "video_minute": video_minute,
}
