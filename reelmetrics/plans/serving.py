"""Serving queries over gold tables or equivalent frames."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelmetrics.functions.timing import DAY, HOUR, WEEK, Level
from reelmetrics.operators import breakdowns, rollups
from reelmetrics.operators.boards import top_k, top_k_per_group
from reelmetrics.operators.gold import history_of_levels
from reelmetrics.operators.rolling import category_counts, rolling_counts
from reelmetrics.operators.rollups import by_id
from reelmetrics.sources.stored import Lake

PERIODS = {"hour": HOUR, "day": DAY, "week": WEEK}


def at_level(gold: DataFrame, level: str) -> DataFrame:
    """The rows of one level; an unknown level raises."""
    return gold.where(F.col("level") == Level(level).value).drop("level")


def top_watched(gold: DataFrame, key: str, level: str, k: int = 10) -> DataFrame:
    return top_k(at_level(gold, level), "views_count", key, k)


def top_liked(gold: DataFrame, key: str, level: str, k: int = 10) -> DataFrame:
    return top_k(at_level(gold, level), "likes_count", key, k)


def video_comments(gold_comments: DataFrame, video_id: int) -> DataFrame:
    return by_id(gold_comments, "video_id", video_id).select(
        F.col("positive_count").alias("comments_positive_count"),
        F.col("comments_count").alias("comments_total_count"),
    )


def channel_rows(gold: DataFrame, channel_id: int) -> DataFrame:
    """Interaction, countries or ages of one channel."""
    return by_id(gold, "channel_id", channel_id)


def video_histogram(video_minutes: DataFrame, video_id: int) -> DataFrame:
    return (
        by_id(video_minutes, "video_id", video_id)
        .select("minutes_offset", "views_count", "likes_count")
        .orderBy("minutes_offset")
    )


def to_json_rows(frame: DataFrame) -> DataFrame:
    """One JSON object per row; NULL fields are left out."""
    return frame.select(F.to_json(F.struct("*")).alias("json"))


class Dashboard:
    """The serving queries of one lake.

    Each query reads the newest publication; with ``state = lake.published()`` all of them read
    that one. Rolling boards end now, or at ``as_of``.
    """

    def __init__(self, lake: Lake, state: dict | None = None):
        self.lake = lake
        self.state = state

    def _gold(self, name: str) -> DataFrame:
        return self.lake.gold(name, self.state).rows()

    def as_of(self) -> DataFrame:
        """The second the published tables stand for; NULL before the first refresh."""
        state = self.lake.published() if self.state is None else self.state
        return self.lake.spark.createDataFrame([(state.get("as_of"),)], "as_of long")

    def top_watched_videos(self, level: str, k: int = 10) -> DataFrame:
        return top_watched(self._gold("video"), "video_id", level, k)

    def top_watched_channels(self, level: str, k: int = 10) -> DataFrame:
        return top_watched(self._gold("channel"), "channel_id", level, k)

    def top_liked_videos(self, level: str, k: int = 10) -> DataFrame:
        return top_liked(self._gold("video"), "video_id", level, k)

    def top_liked_channels(self, level: str, k: int = 10) -> DataFrame:
        return top_liked(self._gold("channel"), "channel_id", level, k)

    def video_history(self, video_id: int) -> DataFrame:
        return history_of_levels(self._gold("video"), "video_id", video_id)

    def channel_history(self, channel_id: int) -> DataFrame:
        return history_of_levels(self._gold("channel"), "channel_id", channel_id)

    def comments(self, video_id: int) -> DataFrame:
        return video_comments(self._gold("comments"), video_id)

    def interaction(self, channel_id: int) -> DataFrame:
        return channel_rows(self._gold("interaction"), channel_id)

    def countries(self, channel_id: int) -> DataFrame:
        return channel_rows(self._gold("countries"), channel_id)

    def ages(self, channel_id: int) -> DataFrame:
        return channel_rows(self._gold("ages"), channel_id)

    def histogram(self, video_id: int) -> DataFrame:
        return video_histogram(self.lake.silver("video_minute").read(), video_id)

    def count(self) -> DataFrame:
        return self.lake.bronze().agg(F.count(F.lit(1)).alias("records"))

    def counts(self) -> DataFrame:
        """Log rows per action and of all actions."""
        return rollups.record_counts(self.lake.bronze())

    def latest(self, n: int = 100) -> DataFrame:
        return self.lake.latest(n)

    def country_shares(self, channel_id: int) -> DataFrame:
        return breakdowns.shares(self.countries(channel_id), "country")

    def age_shares(self, channel_id: int) -> DataFrame:
        return breakdowns.shares(self.ages(channel_id), "age")

    def top_positive_videos(self, k: int = 10) -> DataFrame:
        """Videos with positive and negative comments, by positive ones."""
        counts = self.lake.silver("comment").read().select(
            "video_id",
            "positive_count",
            (F.col("comments_count") - F.col("positive_count")).alias("negative_count"),
        )
        return top_k(counts.where("positive_count > 0 and negative_count > 0"), "positive_count", "video_id", k)

    def peak(self) -> DataFrame:
        """The busiest hour of day and country by first views, from the rollup."""
        return (
            self.lake.silver("interaction")
            .rows()
            .groupBy(F.col("hour_offset").alias("interaction_hour"), F.col("country").alias("user_country"))
            .agg(F.sum("views_count").alias("interaction_count"))
            .orderBy(F.desc("interaction_count"), F.desc("interaction_hour"), F.asc("user_country"))
            .limit(1)
        )

    def channel_views(self) -> DataFrame:
        totals = self.lake.silver("channel_total").read().where("views_count > 0")
        return totals.select("channel_id", F.col("views_count").alias("channel_views"))

    def weighted_views(self, channel_id: int) -> DataFrame:
        """Watched minutes of one channel per minute of the video."""
        return rollups.channel_minute(by_id(self.lake.bronze(), "channel_id", channel_id))

    def _rolling_views(self, period: str, as_of: int | None) -> DataFrame:
        """First views per video of the last hour, day or week; an unknown period raises."""
        start = (int(time.time()) if as_of is None else as_of) - PERIODS[period]
        hours = self.lake.silver("video_hour").rows()
        return rolling_counts(self.lake.bronze(), hours, "video_id", ["views_count"], start)

    def rolling_top_videos(self, period: str, as_of: int | None = None, k: int = 10) -> DataFrame:
        counts = self._rolling_views(period, as_of).withColumnRenamed("views_count", "view_count")
        return top_k(counts, "view_count", "video_id", k)

    def _category_top(self, key: str, period: str, as_of: int | None, k: int) -> DataFrame:
        totals = category_counts(self._rolling_views(period, as_of), self.lake.videos().read(), key)
        return top_k_per_group(totals, "category", "view_count", key, k)

    def top_videos_per_category(self, period: str, as_of: int | None = None, k: int = 10) -> DataFrame:
        return self._category_top("video_id", period, as_of, k)

    def top_channels_per_category(self, period: str, as_of: int | None = None, k: int = 10) -> DataFrame:
        return self._category_top("channel_id", period, as_of, k)
