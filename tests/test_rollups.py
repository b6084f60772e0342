"""Rollups and combined counts on hand-made rows."""

from pyspark.sql import functions as F

from conftest import as_rows
from reelmetrics.operators import boards, breakdowns, rollups

HOUR = 3600


def test_buckets_without_first_views_stay(make_log):
    log = make_log(
        {"action": "likes", "timestamp_seconds": 5},
        {"action": "first_views", "timestamp_seconds": HOUR + 5},
        {"action": "views", "timestamp_seconds": HOUR + 6},
        {"action": "comments", "timestamp_seconds": 7},
    )
    assert as_rows(rollups.video_hour(log)) == [(11, 0, 0, 1, 0), (11, HOUR, 1, 0, 1)]
    keys = ["video_id", (F.col("timestamp_seconds") - F.col("timestamp_seconds") % HOUR).alias("h")]
    assert as_rows(breakdowns.anchored(log, keys)) == [(11, HOUR, 1, 0, 1)]


def test_channel_hour_counts_subscribes(make_log):
    log = make_log({"action": "subscribes", "video_id": None}, {"action": "first_views"})
    assert as_rows(rollups.channel_hour(log)) == [(1, 0, 1, 0, 0, 1)]


def test_interaction_hour_is_whole(make_log):
    log = make_log(
        {"timestamp_seconds": 10 * HOUR + 300}, {"timestamp_seconds": 10 * HOUR + 3000}
    )
    assert as_rows(rollups.interaction(log)) == [(11, 1, "EGYPT", 10, 2)]


def test_peak_hour_is_of_the_channel_not_of_one_video(make_log):
    rows = [{"video_id": 11, "timestamp_seconds": 3 * HOUR}] * 3
    rows += [{"video_id": 12, "timestamp_seconds": 4 * HOUR}] * 2
    rows += [{"video_id": 13, "timestamp_seconds": 4 * HOUR}] * 2
    silver = rollups.interaction(make_log(*rows))
    assert as_rows(boards.peak_hour(silver, ["channel_id", "country"])) == [(1, "EGYPT", 4)]


def test_peak_hour_tie_goes_to_later_hour(make_log):
    silver = rollups.interaction(
        make_log({"timestamp_seconds": 0}, {"timestamp_seconds": 23 * HOUR})
    )
    assert as_rows(boards.peak_hour(silver, ["channel_id", "country"])) == [(1, "EGYPT", 23)]


def test_comment_counts_keep_neutral_apart(make_log):
    log = make_log(*({"action": "comments", "comment_score": s} for s in (0, 0, 1, -1, 1)))
    assert as_rows(rollups.comment_counts(log)) == [(11, 3, 5, 2)]
    assert as_rows(rollups.comment_polarity(log)) == [(11, 2, 1)]
    assert as_rows(breakdowns.polarity_join(log)) == [(11, 2, 1)]


def test_polarity_join_needs_both(make_log):
    log = make_log(
        {"action": "comments", "comment_score": 1},
        {"action": "comments", "comment_score": 1, "video_id": 12},
        {"action": "comments", "comment_score": -1, "video_id": 12},
    )
    assert as_rows(breakdowns.polarity_join(log)) == [(12, 1, 1)]


def test_histogram_outer_marks_missing_sides(make_log):
    log = make_log(
        {"action": "views", "seconds_offset": 1},
        {"action": "likes", "seconds_offset": 2},
        {"action": "views", "seconds_offset": 3},
        {"action": "likes", "seconds_offset": 3},
    )
    assert as_rows(breakdowns.histogram_outer(log)) == [
        (11, 1, 1, None),
        (11, 2, None, 1),
        (11, 3, 1, 1),
    ]


def test_shares_of_zero_total_are_null(spark):
    counts = spark.createDataFrame(
        [(1, "A", 1, 0, 2), (1, "B", 3, 0, 2), (2, "A", 5, 1, 0)],
        "channel_id int, country string, views_count long, likes_count long, minutes_count long",
    )
    assert as_rows(breakdowns.shares(counts, "country")) == [
        (1, "A", 0.25, None, 0.5),
        (1, "B", 0.75, None, 0.5),
        (2, "A", 1.0, 1.0, None),
    ]


def test_record_counts_and_union(make_log):
    views = make_log({"action": "views"}, {"action": "views"}).drop("comment_score")
    likes = make_log({"action": "likes"}).drop("seconds_offset")
    log = rollups.union_actions([views, likes])
    assert as_rows(rollups.record_counts(log)) == [("all", 3), ("likes", 1), ("views", 2)]
    assert as_rows(rollups.record_total(log)) == [(3,)]


def test_between_is_half_open_and_rolling_is_not(make_log):
    log = make_log(*({"timestamp_seconds": s} for s in (9, 10, 19, 20)))
    seconds = "timestamp_seconds"
    assert as_rows(rollups.between(log, 10, 20), seconds) == [(10,), (19,)]
    assert as_rows(rollups.rolling(log, 20, 10), seconds) == [(10,), (19,), (20,)]
    assert as_rows(rollups.high_water(log)) == [(20,)]


def test_hot_group_is_counted_whole(spark):
    """A third of all rows on one key: same counts, one partial row per task."""
    log = spark.range(300_000).select(
        F.lit("first_views").alias("action"),
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 1000).cast("int").alias("video_id"),
        (F.col("id") % 7200).alias("timestamp_seconds"),
    )
    counts = rollups.video_hour(log)
    assert counts.agg(F.sum("views_count")).first()[0] == 300_000
    hot = counts.where("video_id = 7").agg(F.sum("views_count")).first()[0]
    assert hot == log.where("video_id = 7").count() > 100_000
