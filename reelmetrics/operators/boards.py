"""Leaderboards, peaks and newest rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from reelmetrics.functions.measures import zero_if_null


def top_k(totals: DataFrame, measure: str, key: str, k: int = 10) -> DataFrame:
    """The ``k`` largest by ``measure``, ties to the smaller ``key``, with a rank.

    Each task keeps k rows; the rank is numbered over the k survivors only.
    """
    order = [F.desc(measure), F.asc(key)]
    best = (
        totals.withColumn(measure, zero_if_null(F.col(measure))).orderBy(*order).limit(k)
    )
    return best.withColumn("rank", F.row_number().over(W.orderBy(*order)))


def top_k_per_group(
    totals: DataFrame, group: str, measure: str, key: str, k: int = 10
) -> DataFrame:
    """The ``k`` largest per ``group``.

    The rank filter is pushed below the exchange as a per-task group limit, so
    a group sends at most k rows per task.
    """
    order = W.partitionBy(group).orderBy(F.desc(measure), F.asc(key))
    return totals.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def category_totals(log: DataFrame, videos: DataFrame, key: str) -> DataFrame:
    """First views per category and video or channel.

    The log is counted per video first; only those counts meet the dimension.
    """
    per_video = (
        log.where(F.col("action") == "first_views")
        .groupBy("video_id", *([key] if key != "video_id" else []))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    categories = videos.select(F.col("id").alias("video_id"), "category")
    return (
        per_video.join(categories, "video_id")
        .groupBy("category", key)
        .agg(F.sum("n").alias("view_count"))
    )


def peak_hour(hourly: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Hour of day with most views per ``keys``; ties to the later hour.

    Views are summed over everything but keys and hour first. Count and hour
    (0..23) are packed into one number, which a hash aggregate can maximise
    where a struct would need a sort.
    """
    packed = F.col("views") * 24 + F.col("hour_offset")
    return (
        hourly.groupBy(*keys, "hour_offset")
        .agg(F.sum("views_count").alias("views"))
        .groupBy(*keys)
        .agg((F.max(packed) % 24).alias("max_interaction_time"))
    )


def global_peak(log: DataFrame, actions: Sequence[str], hour: Column) -> DataFrame:
    """The single busiest (hour of day, country)."""
    return (
        log.where(F.col("action").isin(*actions))
        .groupBy(hour.alias("interaction_hour"), "user_country")
        .agg(F.count(F.lit(1)).alias("interaction_count"))
        .orderBy(F.desc("interaction_count"), F.desc("interaction_hour"), F.asc("user_country"))
        .limit(1)
    )


def latest(log: DataFrame, n: int, tie: str) -> DataFrame:
    """The ``n`` newest rows, newest first."""
    return log.orderBy(F.desc("timestamp_seconds"), F.desc(tie)).limit(n)
