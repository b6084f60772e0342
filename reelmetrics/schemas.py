"""Wire messages, the bronze log and the rollup tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

INT, LONG, STRING = T.IntegerType(), T.LongType(), T.StringType()

# The action topics.
TOPICS = ("views", "first_views", "subscribes", "likes", "comments")

# Which action feeds which counter.
MEASURE_ACTIONS = {
    "views_count": "first_views",
    "likes_count": "likes",
    "minutes_count": "views",
    "subscribes_count": "subscribes",
}


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


VIDEO_OBJECT = _struct(
    ("channel_id", INT), ("creation_date", LONG), ("category", STRING), ("duration", INT)
)

_VIEWER = (
    ("timestamp", LONG),
    ("user_id", INT),
    ("user_country", STRING),
    ("user_age", INT),
    ("channel_id", INT),
    ("video_id", INT),
)

WIRE: dict[str, T.StructType] = {
    "views": _struct(*_VIEWER, ("video_object", VIDEO_OBJECT), ("seconds_offset", INT)),
    "first_views": _struct(*_VIEWER, ("video_object", VIDEO_OBJECT)),
    "subscribes": _struct(*_VIEWER, ("video_object", VIDEO_OBJECT)),
    "likes": _struct(*_VIEWER, ("video_object", VIDEO_OBJECT), ("seconds_offset", INT)),
    "comments": _struct(*_VIEWER, ("comment", STRING)),
}

# Every field any topic may carry; one parse covers a mixed stream.
WIRE_ANY = _struct(
    *_VIEWER, ("video_object", VIDEO_OBJECT), ("seconds_offset", INT), ("comment", STRING)
)

# Fields a topic keeps in the log beyond time, user and channel.
TOPIC_EXTRAS = {
    "views": ("video_id", "seconds_offset"),
    "first_views": ("video_id",),
    "subscribes": (),
    "likes": ("video_id", "seconds_offset"),
    "comments": ("video_id", "comment_score"),
}

# The log. Each action has its own files, partitioned by event_date.
BRONZE = _struct(
    ("action", STRING),
    ("timestamp_seconds", LONG),
    ("event_time", T.TimestampType()),
    ("ingest_time", T.TimestampType()),
    ("user_id", INT),
    ("user_country", STRING),
    ("user_age", INT),
    ("channel_id", INT),
    ("video_id", INT),
    ("seconds_offset", INT),
    ("comment_score", INT),
    ("event_date", T.DateType()),
)

# What a message tells of its video; stored beside the log and read for the dimension alone.
VIDEO_VERSION = _struct(("video_id", INT), *((f.name, f.dataType) for f in VIDEO_OBJECT.fields))

# Messages that could not be decoded.
REJECTS = _struct(("topic", STRING), ("value", STRING), ("ingest_time", T.TimestampType()))


@dataclass(frozen=True)
class TableSpec:
    """A rollup table: key columns, counters and optional disk partitions."""

    name: str
    keys: tuple[tuple[str, T.DataType], ...]
    measures: tuple[str, ...]
    partitions: tuple[str, ...] = ()
    measure_type: T.DataType = LONG

    @property
    def key_names(self) -> list[str]:
        return [name for name, _ in self.keys]

    @property
    def schema(self) -> T.StructType:
        return _struct(*self.keys, *((m, self.measure_type) for m in self.measures))


_COUNTS = ("views_count", "likes_count", "minutes_count")
_VIDEO, _CHANNEL = ("video_id", INT), ("channel_id", INT)
_AGE, _COUNTRY = ("age", INT), ("country", STRING)

# Kept up to date by additive increments.
SILVER = {
    spec.name: spec
    for spec in (
        TableSpec("video_hour", (_VIDEO, ("hour_timestamp", LONG)), _COUNTS, ("event_date",)),
        TableSpec(
            "channel_hour",
            (_CHANNEL, ("hour_timestamp", LONG)),
            (*_COUNTS, "subscribes_count"),
            ("event_date",),
        ),
        TableSpec("video_total", (_VIDEO,), _COUNTS),
        TableSpec("channel_total", (_CHANNEL,), (*_COUNTS, "subscribes_count")),
        TableSpec("ages", (_VIDEO, _CHANNEL, _AGE), _COUNTS),
        TableSpec("countries", (_VIDEO, _CHANNEL, _COUNTRY), _COUNTS),
        TableSpec(
            "interaction", (_VIDEO, _CHANNEL, _COUNTRY, ("hour_offset", LONG)), ("views_count",)
        ),
        TableSpec(
            "comment", (_VIDEO,), ("comments_count", "all_comments_count", "positive_count")
        ),
        TableSpec("country_views", (_COUNTRY,), ("views_count",)),
        TableSpec(
            "video_minute", (_VIDEO, ("minutes_offset", INT)), ("views_count", "likes_count")
        ),
    )
}

# Published as whole snapshots.
GOLD = {
    spec.name: spec
    for spec in (
        TableSpec("video", (("level", STRING), _VIDEO), _COUNTS, ("level",)),
        TableSpec("channel", (("level", STRING), _CHANNEL), _COUNTS, ("level",)),
        TableSpec("ages", (_CHANNEL, _AGE), _COUNTS),
        TableSpec("countries", (_CHANNEL, _COUNTRY), _COUNTS),
        TableSpec("interaction", (_CHANNEL, _COUNTRY), ("max_interaction_time",)),
        TableSpec("comments", (_VIDEO,), ("comments_count", "positive_count")),
    )
}
