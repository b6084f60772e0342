"""Action messages: subscribe, decode, separate the malformed ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelmetrics.functions import timing
from reelmetrics.functions.text import lexicon_score
from reelmetrics.schemas import BRONZE, TOPIC_EXTRAS, TOPICS, VIDEO_OBJECT, WIRE_ANY

_REJECT = "malformed"


def kafka_options(
    servers: str, topic: str, starting: str = "earliest", max_per_trigger: int | None = None
) -> dict[str, str]:
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
    }
    if max_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    return options


def read_actions_stream(
    spark: SparkSession,
    source: str,
    topic: str,
    path: str | None = None,
    servers: str | None = None,
    starting: str = "earliest",
    max_per_trigger: int | None = None,
) -> DataFrame:
    """Stream of raw messages as ``(topic, value)``.

    ``source`` is ``kafka`` (needs ``servers`` and the connector on the class
    path) or ``text``: a folder of files with one JSON message per line.
    """
    if topic not in TOPICS:
        raise ValueError(f"unknown topic {topic!r}, expected one of {TOPICS}")
    if source == "kafka":
        reader = spark.readStream.format("kafka").options(
            **kafka_options(servers, topic, starting, max_per_trigger)
        )
        raw = reader.load()
    elif source == "text":
        reader = spark.readStream.format("text")
        if max_per_trigger is not None:
            reader = reader.option("maxFilesPerTrigger", max_per_trigger)
        raw = reader.load(path)
    else:
        raise ValueError(f"unknown source {source!r}")
    return raw.select(F.lit(topic).alias("topic"), F.col("value").cast("string").alias("value"))


_VERSION_FIELDS = ("timestamp", "video_id", "video_object")


def decode(raw: DataFrame) -> DataFrame:
    """Add the struct ``message`` and the flag ``malformed`` to ``(topic, value)``.

    A row is malformed if the text is not JSON, a field has the wrong type, a
    field its topic needs is missing (country and age too: they are rollup keys), or
    the topic is unknown.
    """
    corrupt = T.StructField("_corrupt", T.StringType())
    schema = T.StructType([*WIRE_ANY.fields, corrupt])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    # As a generator's output the parsed message is computed once per row; as a
    # plain column it would be parsed again in every filter and projection.
    parsed = F.explode(F.array(F.from_json("value", schema, options))).alias("message")
    message = F.col("message")
    ok = (
        F.col("topic").isin(*TOPICS)
        & message.isNotNull()
        & message["_corrupt"].isNull()
        & message["timestamp"].isNotNull()
        & message["channel_id"].isNotNull()
        & message["user_country"].isNotNull()
        & message["user_age"].isNotNull()
        & ((F.col("topic") == "subscribes") | message["video_id"].isNotNull())
        & (~F.col("topic").isin("views", "likes") | message["seconds_offset"].isNotNull())
        & ((F.col("topic") != "comments") | message["comment"].isNotNull())
    )
    return raw.select("topic", "value", parsed).withColumn(
        _REJECT, ~F.coalesce(ok, F.lit(False))
    )


def quarantine(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split raw messages into decoded good ones and raw bad ones."""
    decoded = decode(raw)
    good = decoded.where(~F.col(_REJECT)).select("topic", "message")
    bad = decoded.where(_REJECT).select("topic", "value")
    return good, bad


def _kept(field: str) -> Column:
    """A message field where its topic keeps it, NULL elsewhere."""
    keepers = [topic for topic in TOPICS if field in TOPIC_EXTRAS[topic]]
    return F.when(F.col("topic").isin(*keepers), F.col(f"message.{field}")).alias(field)


def parse_actions(raw: DataFrame) -> DataFrame:
    """Typed log rows of the well-formed messages, with the comment text."""
    good, _ = quarantine(raw)
    return good.select(*_typed())


def _typed() -> list[Column | str]:
    """Log columns of a decoded message, with the comment text."""
    return [
        F.col("topic").alias("action"),
        F.col("message.timestamp").alias("timestamp_seconds"),
        "message.user_id",
        "message.user_country",
        "message.user_age",
        "message.channel_id",
        _kept("video_id"),
        _kept("seconds_offset"),
        F.when(F.col("topic") == "comments", F.col("message.comment")).alias("comment"),
        "message.video_object",
    ]


def video_versions(raw: DataFrame) -> DataFrame:
    """``(video_id, timestamp_seconds, video_object)`` of every message that describes a video.

    Subscriptions describe one too, although the log keeps no video of theirs. Only these
    fields are parsed; messages without a video, object or time tell nothing.
    """
    schema = T.StructType([f for f in WIRE_ANY.fields if f.name in _VERSION_FIELDS])
    parsed = raw.where(F.col("topic").isin(*TOPICS)).select(
        F.explode(F.array(F.from_json("value", schema))).alias("message")
    )
    return parsed.select(
        "message.video_id", F.col("message.timestamp").alias("timestamp_seconds"), "message.video_object"
    ).dropna()


def with_times(actions: DataFrame) -> DataFrame:
    """Event time from the message, ingest time from the running batch."""
    seconds = F.col("timestamp_seconds")
    return actions.withColumns(
        {
            "event_time": timing.event_time(seconds),
            "ingest_time": F.current_timestamp(),
            "event_date": timing.day_of(seconds),
        }
    )


def ingest_rows(raw: DataFrame, scorer=lexicon_score) -> DataFrame:
    """One decoding for log, rejects and dimension: ``kind`` good or bad, the log columns, ``video``, ``value``.

    ``video`` is what the message tells of its video (subscriptions too), ``value`` the text of a bad message. A bad
    row has no event_date. ``scorer`` is None for topics without comments: a Python scorer would be sent all rows.
    """
    bad = F.col(_REJECT)
    typed = decode(raw).select(
        F.when(bad, "bad").otherwise("good").alias("kind"),
        *_typed(),
        F.col("message.video_id").alias("_described"),
        F.when(bad, F.col("value")).alias("value"),
    )
    described = F.col("_described").isNotNull() & F.col("video_object").isNotNull()
    told = F.struct(F.col("_described").alias("video_id"), *(F.col(f"video_object.{f.name}") for f in VIDEO_OBJECT.fields))
    score = F.lit(None).cast("int") if scorer is None else F.when(F.col("action") == "comments", scorer(F.col("comment")))
    rows = with_times(typed.withColumn("comment_score", score))
    rows = rows.withColumn("event_date", F.when(F.col("kind") == "good", F.col("event_date")))
    return rows.select("kind", *BRONZE.names, F.when(described, told).alias("video"), "value")


def to_bronze(actions: DataFrame, scorer=lexicon_score) -> DataFrame:
    """Log rows in bronze layout: comments scored in place, their text dropped."""
    scored = actions.withColumn(
        "comment_score",
        F.when(F.col("action") == "comments", scorer(F.col("comment"))),
    )
    return with_times(scored).select(*BRONZE.names)
