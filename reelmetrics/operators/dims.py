"""Dimensions carried inside the messages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def videos_dim(parsed: DataFrame) -> DataFrame:
    """Last known attributes of each video.

    Equal attribute rows are folded by a hash aggregate first; only distinct
    versions of a video reach the search for the last one.
    """
    attributes = ("channel_id", "creation_date", "category", "duration")
    versions = (
        parsed.where(F.col("video_object").isNotNull())
        .groupBy("video_id", *(F.col(f"video_object.{a}").alias(a) for a in attributes))
        .agg(F.max("timestamp_seconds").alias("seen"))
    )
    last = versions.groupBy("video_id").agg(
        F.max(F.struct("seen", *attributes)).alias("last")
    )
    return last.select(
        F.col("video_id").alias("id"),
        F.col("last.channel_id").alias("channel_id"),
        F.col("last.creation_date").alias("creation_date"),
        F.col("last.category").alias("category"),
        F.floor(F.col("last.duration") / 60).cast("int").alias("duration_minutes"),
    )


VERSION = ("channel_id", "creation_date", "category", "duration")


def versions_of(log: DataFrame) -> DataFrame:
    """Video versions told by log rows, with the time they were told."""
    told = log.where(F.col("video").isNotNull() & F.col("timestamp_seconds").isNotNull())
    return told.select("video.*", F.col("timestamp_seconds").alias("seen"))


def newest_versions(versions: DataFrame) -> DataFrame:
    """The newest version of every video; of versions of one second the greatest by its attributes.

    Taking the greatest is idempotent and may be done part by part. Equal versions are
    folded by a hash aggregate first, as in ``videos_dim``.
    """
    distinct = versions.groupBy("video_id", *VERSION).agg(F.max("seen").alias("seen"))
    last = distinct.groupBy("video_id").agg(F.max(F.struct("seen", *VERSION)).alias("last"))
    return last.select("video_id", "last.*")


def dimension_of(versions: DataFrame) -> DataFrame:
    """Columns of the video dimension from one version per video."""
    return versions.select(
        F.col("video_id").alias("id"),
        "channel_id",
        "creation_date",
        "category",
        F.floor(F.col("duration") / 60).cast("int").alias("duration_minutes"),
    )


def channels_dim(parsed: DataFrame) -> DataFrame:
    """Channels seen in the log; owner and creation date are not in any message."""
    return parsed.select(F.col("channel_id").alias("id")).distinct().select(
        "id",
        F.lit(None).cast("int").alias("owner_id"),
        F.lit(None).cast("long").alias("creation_date"),
    )
