"""Combinations of several actions' counts on shared keys, and shares.

Inner, left and full outer joins of per-action counts on the same keys equal
one conditional aggregation followed by a test of the counters: a count of
zero is a missing join partner. That needs one scan and one exchange where
the joins need one of each per action.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from reelmetrics.functions.measures import VIEWS_LIKES_MINUTES
from reelmetrics.operators.rollups import comment_polarity, rollup, video_minute


def anchored(
    log: DataFrame,
    keys: Sequence[str | Column],
    measures: Sequence[str] = VIEWS_LIKES_MINUTES,
    anchor: str = "views_count",
) -> DataFrame:
    """Counts left-joined to the anchor's: groups without it drop out, others keep 0."""
    return rollup(log, keys, measures).where(F.col(anchor) > 0)


def video_minute_anchored(log: DataFrame) -> DataFrame:
    """Per-minute counts anchored on likes."""
    return video_minute(log).where(F.col("likes_count") > 0)


def inner_breakdown(log: DataFrame, channel_id: int, by: str) -> DataFrame:
    """Audience groups of one channel that have all of views, likes and minutes."""
    counts = rollup(log.where(F.col("channel_id") == F.lit(int(channel_id))), ["channel_id", by],
                    VIEWS_LIKES_MINUTES)
    return counts.where(
        (F.col("views_count") > 0) & (F.col("likes_count") > 0) & (F.col("minutes_count") > 0)
    )


def polarity_join(comments: DataFrame) -> DataFrame:
    """Videos that have both positive and negative comments."""
    return comment_polarity(comments).where(
        (F.col("positive_count") > 0) & (F.col("negative_count") > 0)
    )


def histogram_outer(log: DataFrame) -> DataFrame:
    """Views and likes by video and minute of the video; a missing side is NULL."""
    return video_minute(log).select(
        "video_id",
        "minutes_offset",
        F.nullif("views_count", F.lit(0)).alias("views_count"),
        F.nullif("likes_count", F.lit(0)).alias("likes_count"),
    )


def shares(
    counts: DataFrame, by: str, measures: Sequence[str] = VIEWS_LIKES_MINUTES, digits: int = 6
) -> DataFrame:
    """Each group's part of its channel's total; NULL where the total is zero.

    The window holds the aggregated groups of one channel (its ages or
    countries), never log rows.
    """
    channel = W.partitionBy("channel_id")
    return counts.select(
        "channel_id",
        by,
        *(
            F.round(F.try_divide(F.col(m), F.sum(m).over(channel)), digits).alias(
                m.replace("_count", "_share")
            )
            for m in measures
        ),
    )
