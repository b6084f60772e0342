"""Messages: decode, reject, score."""

import json

import pytest
from pyspark.sql import types as T

from conftest import as_rows
from reelmetrics.functions.text import LABEL_SCORES, clean_comment, lexicon_score, model_score
from reelmetrics.operators import dims
from reelmetrics.schemas import TOPICS, VIDEO_OBJECT, WIRE
from reelmetrics.sources import wire

VIDEO = {"channel_id": 1, "creation_date": 7, "category": "Music", "duration": 125}
BASE = {
    "timestamp": 1_700_000_000,
    "user_id": 100_001,
    "user_country": "Egypt",
    "user_age": 20,
    "channel_id": 1,
    "video_id": 12,
}


def message(topic, **changes):
    body = dict(BASE)
    if topic != "comments":
        body["video_object"] = VIDEO
    if topic in ("views", "likes"):
        body["seconds_offset"] = 3
    if topic == "comments":
        body["comment"] = "the la and"
    body.update(changes)
    return topic, json.dumps({k: v for k, v in body.items() if v is not ...})


@pytest.fixture(scope="module")
def raw(spark):
    def build(*messages):
        return spark.createDataFrame(list(messages), "topic string, value string")

    return build


def test_schemas_cover_every_topic():
    assert set(WIRE) == set(TOPICS)
    assert WIRE["views"]["video_object"].dataType == VIDEO_OBJECT
    assert "seconds_offset" not in WIRE["first_views"].names
    assert WIRE["comments"].names[-1] == "comment"
    assert WIRE["likes"]["timestamp"].dataType == T.LongType()


def test_topics_keep_their_fields(raw):
    parsed = wire.parse_actions(raw(*(message(t) for t in TOPICS)))
    assert as_rows(parsed, "action", "video_id", "seconds_offset", "comment") == [
        ("comments", 12, None, "the la and"),
        ("first_views", 12, None, None),
        ("likes", 12, 3, None),
        ("subscribes", None, None, None),
        ("views", 12, 3, None),
    ]


def test_bronze_layout(raw):
    bronze = wire.to_bronze(wire.parse_actions(raw(message("comments"), message("likes"))))
    rows = as_rows(bronze.selectExpr("action", "comment_score", "cast(event_date as string)",
                                     "cast(event_time as string)", "ingest_time > event_time"))
    assert rows == [
        ("comments", 1, "2023-11-14", "2023-11-14 22:13:20", True),
        ("likes", None, "2023-11-14", "2023-11-14 22:13:20", True),
    ]
    assert "comment" not in bronze.columns


def test_malformed_messages_are_set_apart(raw):
    bad = [
        ("likes", "{not json"),
        ("likes", None),
        ("likes", ""),
        message("likes", timestamp="noon"),
        message("likes", timestamp=...),
        message("views", seconds_offset=...),
        message("first_views", video_id=...),
        message("comments", comment=...),
        message("first_views", channel_id=None),
        message("likes", user_country=...),
        message("views", user_age=None),
        ("shares", message("likes")[1]),
    ]
    good, rejected = wire.quarantine(raw(message("subscribes", video_id=...), *bad))
    assert as_rows(good.select("topic")) == [("subscribes",)]
    assert as_rows(rejected) == sorted(bad, key=repr)


def test_videos_and_channels_from_messages(raw):
    newer = {**VIDEO, "category": "Horror"}
    parsed = wire.parse_actions(
        raw(
            message("views"),
            message("likes", timestamp=BASE["timestamp"] + 1, video_object=newer),
            message("views", timestamp=BASE["timestamp"] - 1),
            message("comments", channel_id=4),
        )
    )
    assert as_rows(dims.videos_dim(parsed)) == [(12, 1, 7, "Horror", 2)]
    assert as_rows(dims.channels_dim(parsed), "id") == [(1,), (4,)]


def test_subscriptions_describe_videos(raw):
    newer = {**VIDEO, "category": "Horror"}
    given = raw(
        message("views"),
        message("subscribes", timestamp=BASE["timestamp"] + 5, video_object=newer),
        message("comments"),
        ("likes", "{not json"),
    )
    assert as_rows(dims.videos_dim(wire.video_versions(given))) == [(12, 1, 7, "Horror", 2)]


def test_clean_comment(spark):
    frame = spark.createDataFrame([("it's \"so\" good",), ("",), (None,)], "c string")
    assert as_rows(frame.select(clean_comment(frame.c))) == [
        ('""',),
        ('"its so good"',),
        (None,),
    ]


TEXTS = ["the la and", "and und", "", "THE dog and", "thethe", "der  der und", "et\nthe", "la"]


def brute_force(text: str) -> int:
    tokens = text.lower().split(" ")
    total = sum(t in ("the", "der", "la", "le") for t in tokens)
    total -= sum(t in ("and", "und", "de", "et") for t in tokens)
    return (total > 0) - (total < 0)


def test_lexicon_equals_brute_force(spark):
    frame = spark.createDataFrame([(t,) for t in TEXTS], "c string")
    found = as_rows(frame.select("c", lexicon_score(frame.c)))
    assert found == sorted(((t, brute_force(t)) for t in TEXTS), key=repr)


def test_model_scorer_batches_and_matches(spark):
    def load():
        def classify(texts):
            assert isinstance(texts, list) and 0 < len(texts) <= 3
            return ["positive" if t.startswith("t") else "neutral" for t in texts]

        return classify

    frame = spark.createDataFrame([(t,) for t in TEXTS * 3 + [None]], "c string")
    scorer = model_score(load, batch_size=3)
    found = as_rows(frame.select("c", scorer(frame.c)))
    expected = [(t, int(t.startswith("t"))) for t in TEXTS * 3] + [(None, None)]
    assert found == sorted(expected, key=repr)
    assert set(LABEL_SCORES.values()) == {1, 0, -1}


def test_kafka_options():
    assert wire.kafka_options("a:1", "likes", "latest", 1000) == {
        "kafka.bootstrap.servers": "a:1",
        "subscribe": "likes",
        "startingOffsets": "latest",
        "maxOffsetsPerTrigger": "1000",
    }


def test_unknown_topic_or_source_is_refused(spark):
    with pytest.raises(ValueError):
        wire.read_actions_stream(spark, "text", "commments", path="/tmp")
    with pytest.raises(ValueError):
        wire.read_actions_stream(spark, "socket", "likes")
