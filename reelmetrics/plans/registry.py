"""Registered queries: each reads the given tables whole and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelmetrics.functions import timing
from reelmetrics.functions.measures import VIEWS_LIKES_MINUTES
from reelmetrics.functions.text import clean_comment
from reelmetrics.functions.timing import DAY, HOUR, LEVELS, WEEK, window_start, window_starts
from reelmetrics.operators import boards, breakdowns, dims, gold, merges, quality, rollups
from reelmetrics.plans import serving
from reelmetrics.session import shared_dir
from reelmetrics.sources import testbed, wire
from reelmetrics.sources.files import Folder
from reelmetrics.sources.stored import Lake
from reelmetrics.sources.testbed import AS_OF
from reelmetrics.streaming import jobs, windows

Query = Callable[[SparkSession, str], DataFrame]

VIDEO_ID = 55
CHANNEL_ID = 5
COUNTED = ("first_views", "likes", "views")
CHANNEL_COUNTED = (*COUNTED, "subscribes")
PERIODS = serving.PERIODS

QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _log(spark, sf, *kinds, **limits) -> DataFrame:
    return testbed.actions(spark, sf, kinds=kinds or None, **limits)


def _comments(spark, sf) -> DataFrame:
    return testbed.scored_comments(
        _log(spark, sf, "comments"), testbed.document_scores(spark, sf)
    )


# -- ingest and expressions -----------------------------------------------


@query
def parse_actions_json(spark, sf):
    parsed = wire.parse_actions(testbed.wire_messages(spark, sf))
    return parsed.withColumn("category", F.col("video_object.category")).drop("video_object")


@query
def event_time_render(spark, sf):
    seconds = F.col("timestamp_seconds")
    return _log(spark, sf).select(
        "event_id", "timestamp_seconds", timing.render_time(seconds).alias("event_time")
    )


@query
def json_rows(spark, sf):
    return serving.to_json_rows(breakdowns.histogram_outer(_log(spark, sf, "views", "likes")))


def _dedup(layout: str, kinds: tuple[str, ...]) -> Query:
    """Raw keys at hour precision, so that the test events do collide."""

    def run(spark, sf):
        log = _log(spark, sf, *kinds, country=layout == "country").withColumn(
            "timestamp_seconds", timing.hour_bucket(F.col("timestamp_seconds"))
        )
        keys = ("action", *merges.RAW_KEYS[layout])
        return merges.dedup_last_write(log.select(*keys, "user_id", "event_id"), keys, ["event_id"])

    return run


QUERIES["dedup_video_key"] = _dedup("video", ())
QUERIES["dedup_age_key"] = _dedup("age", COUNTED)
QUERIES["dedup_country_key"] = _dedup("country", COUNTED)


@query
def videos_dim(spark, sf):
    # Comments carry no video attributes.
    return dims.videos_dim(
        wire.video_versions(testbed.wire_messages(spark, sf, kinds=CHANNEL_COUNTED))
    )


@query
def channels_dim(spark, sf):
    return dims.channels_dim(_log(spark, sf))


@query
def increment_slice(spark, sf):
    start, end = AS_OF - 2 * WEEK, AS_OF - WEEK
    log = _log(spark, sf, since=start, until=end)
    return rollups.between(log, start, end).select("event_id", "action", "timestamp_seconds")


@query
def high_water_marks(spark, sf):
    return rollups.high_water(_log(spark, sf), ["action"])


@query
def window_bounds(spark, sf):
    """Window starts at the test data's "now" and the actions inside each window."""
    starts = window_starts(AS_OF)
    seconds = F.col("timestamp_seconds")
    counted = _log(spark, sf).agg(
        *(F.count_if(seconds >= start).alias(level) for level, start in starts.items())
    )
    rows = F.array(
        *(
            F.struct(
                F.lit(level).alias("level"),
                F.lit(start).cast("long").alias("window_start"),
                F.col(level).alias("actions"),
            )
            for level, start in starts.items()
        )
    )
    return counted.select(F.inline(rows))


@query
def hour_bucket(spark, sf):
    hour = timing.hour_bucket(F.col("timestamp_seconds")).alias("hour_timestamp")
    return _log(spark, sf).groupBy(hour).agg(F.count(F.lit(1)).alias("actions"))


@query
def hour_of_day(spark, sf):
    hour = timing.hour_of_day(F.col("timestamp_seconds")).alias("hour_offset")
    return _log(spark, sf).groupBy(hour).agg(F.count(F.lit(1)).alias("actions"))


@query
def minute_index(spark, sf):
    minute = timing.minute_index(F.col("position_seconds")).alias("minutes_offset")
    return _log(spark, sf, "views", "likes").select("event_id", "action", minute)


@query
def clean_comments(spark, sf):
    documents = testbed.table(spark, sf, "documents")
    return documents.select("doc_id", clean_comment(F.col("text")).alias("comment"))


@query
def scored_comments(spark, sf):
    return _comments(spark, sf).select("event_id", "video_id", "comment_score")


# -- silver ---------------------------------------------------------------


@query
def silver_video_hour(spark, sf):
    return rollups.video_hour(_log(spark, sf, *COUNTED))


@query
def silver_channel_hour(spark, sf):
    return rollups.channel_hour(_log(spark, sf, *CHANNEL_COUNTED))


@query
def silver_ages(spark, sf):
    return rollups.ages(_log(spark, sf, *COUNTED))


@query
def silver_countries(spark, sf):
    return rollups.countries(_log(spark, sf, *COUNTED, country=True))


@query
def silver_interaction(spark, sf):
    return rollups.interaction(_log(spark, sf, "first_views", country=True))


@query
def country_views(spark, sf):
    return rollups.country_views(_log(spark, sf, "first_views", country=True))


@query
def silver_comments(spark, sf):
    return rollups.comment_counts(_comments(spark, sf))


# -- combined counts ------------------------------------------------------


def _hour():
    return timing.hour_bucket(F.col("timestamp_seconds")).alias("hour_timestamp")


@query
def video_hour_anchored(spark, sf):
    return breakdowns.anchored(_log(spark, sf, *COUNTED), ["video_id", _hour()])


@query
def channel_hour_anchored(spark, sf):
    log = _log(spark, sf, *CHANNEL_COUNTED)
    return breakdowns.anchored(
        log, ["channel_id", _hour()], (*VIEWS_LIKES_MINUTES, "subscribes_count")
    )


@query
def ages_anchored(spark, sf):
    age = F.col("user_age").alias("age")
    return breakdowns.anchored(_log(spark, sf, *COUNTED), ["video_id", "channel_id", age])


@query
def countries_anchored(spark, sf):
    country = F.col("user_country").alias("country")
    log = _log(spark, sf, *COUNTED, country=True)
    return breakdowns.anchored(log, ["video_id", "channel_id", country])


@query
def video_minute_anchored(spark, sf):
    return breakdowns.video_minute_anchored(_log(spark, sf, "views", "likes"))


@query
def channel_countries_inner(spark, sf):
    log = _log(spark, sf, *COUNTED, country=True)
    return breakdowns.inner_breakdown(log, CHANNEL_ID, "user_country")


@query
def channel_ages_inner(spark, sf):
    return breakdowns.inner_breakdown(_log(spark, sf, *COUNTED), CHANNEL_ID, "user_age")


@query
def comments_pos_neg(spark, sf):
    return breakdowns.polarity_join(_comments(spark, sf))


@query
def histogram_outer(spark, sf):
    log = rollups.by_id(_log(spark, sf, "views", "likes"), "video_id", VIDEO_ID)
    return breakdowns.histogram_outer(log)


@query
def country_shares(spark, sf):
    return breakdowns.shares(gold_countries(spark, sf), "country")


@query
def age_shares(spark, sf):
    return breakdowns.shares(gold_ages(spark, sf), "age")


# -- gold -----------------------------------------------------------------


@query
def gold_ages(spark, sf):
    return gold.channel_ages(silver_ages(spark, sf))


@query
def gold_countries(spark, sf):
    return gold.channel_countries(silver_countries(spark, sf))


@query
def gold_interaction(spark, sf):
    return boards.peak_hour(silver_interaction(spark, sf), ["channel_id", "country"])


@query
def gold_comments(spark, sf):
    return silver_comments(spark, sf).select("video_id", "comments_count", "positive_count")


@query
def gold_video_minute(spark, sf):
    return rollups.video_minute(_log(spark, sf, "views", "likes"))


def _window_log(spark, sf, level: str, kinds, as_of: int = AS_OF) -> DataFrame:
    """The part of the log a level needs; the limit reaches the scan."""
    start = window_start(level, as_of)
    return _log(spark, sf, *kinds, since=start or None)


def _gold(entity: str, level: str) -> Query:
    """Through the hourly rollup, as the stored gold tables are built."""

    def run(spark, sf):
        kinds, rollup = {
            "video": (COUNTED, rollups.video_hour),
            "channel": (CHANNEL_COUNTED, rollups.channel_hour),
        }[entity]
        silver = rollup(_window_log(spark, sf, level, kinds))
        return gold.window_totals(silver, f"{entity}_id", level, AS_OF)

    return run


def _board(entity: str, measure: str, level: str) -> Query:
    """Straight from the log: one exchange, then k rows per task."""

    def run(spark, sf):
        totals = gold.window_totals_raw(_window_log(spark, sf, level, COUNTED), f"{entity}_id")
        return boards.top_k(totals, measure, f"{entity}_id")

    return run


for _entity in ("video", "channel"):
    for _level in LEVELS:
        QUERIES[f"gold_{_entity}_{_level}"] = _gold(_entity, _level)
        QUERIES[f"top_watched_{_entity}s_{_level}"] = _board(_entity, "views_count", _level)
        QUERIES[f"top_liked_{_entity}s_{_level}"] = _board(_entity, "likes_count", _level)


def _gold_levels(entity: str) -> Query:
    """All five levels from one scan."""

    def run(spark, sf):
        kinds, rollup = {
            "video": (COUNTED, rollups.video_hour),
            "channel": (CHANNEL_COUNTED, rollups.channel_hour),
        }[entity]
        return gold.window_totals_all(rollup(_log(spark, sf, *kinds)), f"{entity}_id", AS_OF)

    return run


QUERIES["gold_video_levels"] = _gold_levels("video")
QUERIES["gold_channel_levels"] = _gold_levels("channel")


# -- plain counts ---------------------------------------------------------


@query
def channel_views_by_country(spark, sf):
    log = _log(spark, sf, "first_views", country=True)
    return rollups.channel_counts(log, ["user_country"])


@query
def channel_views_by_age(spark, sf):
    return rollups.channel_counts(_log(spark, sf, "first_views"), ["user_age"])


@query
def channel_views(spark, sf):
    return rollups.channel_counts(_log(spark, sf, "first_views"))


@query
def channel_weighted_views(spark, sf):
    return rollups.channel_minute(_log(spark, sf, "views"))


@query
def video_totals(spark, sf):
    return rollups.video_totals(_log(spark, sf, "first_views"))


@query
def record_counts(spark, sf):
    return rollups.record_counts(_log(spark, sf))


@query
def record_total(spark, sf):
    return rollups.record_total(_log(spark, sf))


# -- merges ---------------------------------------------------------------

_CUTS = (AS_OF - 2 * WEEK, AS_OF - WEEK)


def _increments(spark, sf, *kinds) -> list[DataFrame]:
    """The log in three consecutive slices."""
    first, second = _CUTS
    return [
        _log(spark, sf, *kinds, until=first),
        _log(spark, sf, *kinds, since=first, until=second),
        _log(spark, sf, *kinds, since=second),
    ]


def _merged(increments: list[DataFrame], keys, measures) -> DataFrame:
    current = increments[0]
    for increment in increments[1:]:
        current = merges.merge_additive(current, increment, keys, measures)
    return current


@query
def merge_additive_video_hour(spark, sf):
    parts = [rollups.video_hour(part) for part in _increments(spark, sf, *COUNTED)]
    return _merged(parts, ["video_id", "hour_timestamp"], VIEWS_LIKES_MINUTES)


@query
def merge_additive_comments(spark, sf):
    # One frame of scores, so that its exchange is run once and reused.
    scores = testbed.document_scores(spark, sf)
    parts = [
        rollups.comment_counts(testbed.scored_comments(part, scores))
        for part in _increments(spark, sf, "comments")
    ]
    return _merged(parts, ["video_id"], ["comments_count", "all_comments_count", "positive_count"])


@query
def merge_additive_video_minute(spark, sf):
    parts = [rollups.video_minute(part) for part in _increments(spark, sf, "views", "likes")]
    return _merged(parts, ["video_id", "minutes_offset"], ["views_count", "likes_count"])


@query
def merge_overwrite_gold(spark, sf):
    """Yesterday's day table overwritten by today's; yesterday's other videos stay."""
    before = AS_OF - DAY
    old_log = _log(
        spark, sf, *COUNTED, since=window_start("last_day", before), until=before + 1
    )
    current = gold.window_totals(rollups.video_hour(old_log), "video_id", "last_day", before)
    snapshot = QUERIES["gold_video_last_day"](spark, sf)
    return merges.merge_overwrite(current, snapshot, ["video_id"])


# -- boards and peaks -----------------------------------------------------


def _rolling_top(period: str) -> Query:
    def run(spark, sf):
        seconds = PERIODS[period]
        log = rollups.rolling(
            _log(spark, sf, "first_views", since=AS_OF - seconds), AS_OF, seconds
        )
        totals = log.groupBy("video_id").agg(F.count(F.lit(1)).alias("view_count"))
        return boards.top_k(totals, "view_count", "video_id")

    return run


def _category_top(key: str, period: str) -> Query:
    def run(spark, sf):
        seconds = PERIODS[period]
        log = rollups.rolling(
            _log(spark, sf, "first_views", since=AS_OF - seconds), AS_OF, seconds
        )
        totals = boards.category_totals(log, testbed.videos(spark, sf), key)
        return boards.top_k_per_group(totals, "category", "view_count", key)

    return run


for _period in PERIODS:
    QUERIES[f"rolling_top_videos_{_period}"] = _rolling_top(_period)
    QUERIES[f"top_videos_per_category_{_period}"] = _category_top("video_id", _period)
    QUERIES[f"top_channels_per_category_{_period}"] = _category_top("channel_id", _period)


@query
def top_positive_videos(spark, sf):
    return boards.top_k(comments_pos_neg(spark, sf), "positive_count", "video_id")


@query
def global_peak_hour(spark, sf):
    log = _log(spark, sf, "first_views", country=True)
    hour = timing.hour_of_day(F.col("timestamp_seconds"))
    return boards.global_peak(log, ["first_views"], hour)


@query
def global_peak_hour_all_actions(spark, sf):
    kinds = ("first_views", "likes", "subscribes")
    log = _log(spark, sf, *kinds, country=True)
    hour = timing.hour_of_day(F.col("timestamp_seconds"))
    return boards.global_peak(log, kinds, hour)


@query
def latest_actions(spark, sf):
    newest = boards.latest(_log(spark, sf), 100, "event_id")
    return newest.select("event_id", "action", "timestamp_seconds", "channel_id", "video_id")


# -- serving --------------------------------------------------------------


@query
def video_history(spark, sf):
    return gold.history_raw(_log(spark, sf, *COUNTED), "video_id", VIDEO_ID, AS_OF)


@query
def channel_history(spark, sf):
    return gold.history_raw(_log(spark, sf, *COUNTED), "channel_id", CHANNEL_ID, AS_OF)


@query
def video_comments(spark, sf):
    """Only documents that the video's comments cite are scored."""
    own = rollups.by_id(_log(spark, sf, "comments"), "video_id", VIDEO_ID)
    scored = testbed.scored_comments_of(spark, sf, own)
    return serving.video_comments(rollups.comment_counts(scored), VIDEO_ID)


@query
def channel_interaction(spark, sf):
    return serving.channel_rows(gold_interaction(spark, sf), CHANNEL_ID)


@query
def channel_countries(spark, sf):
    return serving.channel_rows(gold_countries(spark, sf), CHANNEL_ID)


@query
def channel_ages(spark, sf):
    return serving.channel_rows(gold_ages(spark, sf), CHANNEL_ID)


@query
def video_histogram(spark, sf):
    return serving.video_histogram(gold_video_minute(spark, sf), VIDEO_ID)


# -- quality --------------------------------------------------------------


@query
def accuracy_countries(spark, sf):
    """A rollup refreshed a day before "now" against the whole log."""
    stale = _log(spark, sf, *COUNTED, until=AS_OF - DAY, country=True)
    refreshed = gold.channel_countries(rollups.countries(stale))
    country = F.col("user_country").alias("country")
    truth = rollups.rollup(
        _log(spark, sf, "first_views", country=True), ["channel_id", country], ["views_count"]
    )
    return quality.accuracy_report(refreshed, truth, ["channel_id", "country"])


@query
def accuracy_summary(spark, sf):
    return quality.accuracy_summary(accuracy_countries(spark, sf))


@query
def freshness_lag(spark, sf):
    return quality.freshness(_log(spark, sf), silver_video_hour(spark, sf))


# -- streaming ------------------------------------------------------------


def _event_stream(spark, sf) -> DataFrame:
    return testbed.shape_events(testbed.event_stream(spark, sf))


@query
def stream_video_hour(spark, sf):
    """The log as a stream, added to a stored rollup batch by batch."""
    root = shared_dir(spark, "stream-video-hour")
    lake = Lake(spark, f"{root}/lake")
    jobs.start_silver(
        _event_stream(spark, sf), lake, f"{root}/checkpoint", tables=("video_hour",)
    ).awaitTermination()
    return lake.silver("video_hour").read()


def hourly_windows(spark, sf, max_files: int = 1000) -> DataFrame:
    root = shared_dir(spark, "stream-hourly-window")
    stream = testbed.shape_events(testbed.event_stream(spark, sf, max_files))
    windows.start_hourly_window(
        stream, "video_id", f"{root}/out", f"{root}/checkpoint"
    ).awaitTermination()
    return windows.hourly_rows(spark, f"{root}/out", "video_id")


@query
def stream_hourly_window(spark, sf):
    """All hours of the log, whatever the order and number of its files."""
    return hourly_windows(spark, sf)


_LAKES: dict[tuple[str, str], str] = {}


def message_lake(spark, sf) -> Lake:
    """A lake fed with the log's messages by the streaming jobs; built once per application."""
    known = (spark.sparkContext.applicationId, sf)
    if known not in _LAKES:
        root = shared_dir(spark, "message-lake")
        lake = Lake(spark, f"{root}/lake").ensure()
        messages = testbed.wire_messages(spark, sf, CHANNEL_COUNTED).select("topic", "value")
        messages.write.partitionBy("topic").text(f"{root}/in")
        for topic in CHANNEL_COUNTED:
            inbox = f"{root}/in/topic={topic}"
            Folder(spark, inbox).create()
            raw = wire.read_actions_stream(spark, "text", topic, path=inbox)
            jobs.start_ingest(raw, lake, topic, f"{root}/ck-{topic}").awaitTermination()
        jobs.start_silver(
            lake.bronze_stream(), lake, f"{root}/ck-silver", tables=("video_hour",)
        ).awaitTermination()
        _LAKES[known] = lake.root
    return Lake(spark, _LAKES[known])


@query
def lake_rolling_day(spark, sf):
    """Top videos of the last day: whole hours from the rollup, the cut hour from the log."""
    return serving.Dashboard(message_lake(spark, sf)).rolling_top_videos("day", AS_OF)


@query
def lake_category_week(spark, sf):
    """Top videos per category of the last week, categories from the stored dimension."""
    return serving.Dashboard(message_lake(spark, sf)).top_videos_per_category("week", AS_OF)


@query
def lake_channel_category_week(spark, sf):
    return serving.Dashboard(message_lake(spark, sf)).top_channels_per_category("week", AS_OF)
