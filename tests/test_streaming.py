"""Streams equal batch, survive restarts and replays."""

import json
import os
import time

import pytest
from pyspark.sql import functions as F

from conftest import as_rows
from reelmetrics.operators import rollups
from reelmetrics.plans.refresh import refresh_gold
from reelmetrics.plans.serving import Dashboard
from reelmetrics.schemas import SILVER, TOPICS
from reelmetrics.session import shared_dir
from reelmetrics.sources import testbed, wire
from reelmetrics.sources.stored import Lake
from reelmetrics.sources.testbed import AS_OF
from reelmetrics.streaming import jobs, windows


@pytest.fixture(scope="module")
def messages(spark, sf_dir):
    """Messages of the test log per topic."""
    rows = testbed.wire_messages(spark, sf_dir).orderBy("event_id").collect()
    return {topic: [r.value for r in rows if r.topic == topic] for topic in TOPICS}


def drop(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as out:
        out.write("\n".join(lines) + "\n")


def ingest(spark, lake, inbox, root):
    for topic in TOPICS:
        raw = wire.read_actions_stream(
            spark, "text", topic, path=f"{inbox}/{topic}", max_per_trigger=1
        )
        jobs.start_bronze(raw, lake, topic, f"{root}/ck-bronze-{topic}").awaitTermination()
        jobs.start_rejects(raw, lake, topic, f"{root}/ck-rejects-{topic}").awaitTermination()


def roll_up(spark, lake, root):
    jobs.start_silver(lake.bronze_stream(), lake, f"{root}/ck-silver").awaitTermination()


def test_messages_to_gold(spark, sf_dir, tmp_path, messages):
    lake = Lake(spark, f"{tmp_path}/lake").ensure()
    inbox, root = f"{tmp_path}/in", str(tmp_path)
    for topic, lines in messages.items():
        half = len(lines) // 2
        drop(f"{inbox}/{topic}", "a.json", [*lines[:half], "{broken"])
    ingest(spark, lake, inbox, root)
    roll_up(spark, lake, root)
    first = lake.silver("video_hour").read().agg(F.sum("views_count")).first()[0]
    assert 0 < first < len(messages["first_views"])

    # A restart goes on where the checkpoint stands.
    for topic, lines in messages.items():
        drop(f"{inbox}/{topic}", "b.json", lines[len(lines) // 2 :])
    ingest(spark, lake, inbox, root)
    roll_up(spark, lake, root)
    roll_up(spark, lake, root)

    log = lake.bronze()
    assert log.count() == sum(map(len, messages.values()))
    assert as_rows(lake.rejects().select("topic", "value")) == sorted((t, "{broken") for t in TOPICS)
    for name, rollup in rollups.SILVER_ROLLUPS.items():
        columns = SILVER[name].schema.names
        assert as_rows(lake.silver(name).read(), *columns) == as_rows(rollup(log), *columns), name

    # The same board as straight from the given tables.
    from reelmetrics.plans.registry import QUERIES

    refresh_gold(lake, AS_OF)
    board = Dashboard(lake)
    for level in ("last_day", "alltime"):
        assert as_rows(board.top_watched_videos(level)) == as_rows(
            QUERIES[f"top_watched_videos_{level}"](spark, sf_dir)
        )
    assert as_rows(board.countries(5)) == as_rows(QUERIES["channel_countries"](spark, sf_dir))
    assert as_rows(board.comments(55)) == as_rows(QUERIES["video_comments"](spark, sf_dir))
    assert as_rows(board.count()) == [(1000,)]


def test_replayed_batch_changes_nothing(spark, tmp_path, make_log):
    lake = Lake(spark, str(tmp_path / "lake"))
    batch = make_log({}, {"action": "likes"}, {"action": "comments", "comment_score": 1})
    jobs.add_increments(lake, batch, "w", 0)
    before = {name: as_rows(lake.silver(name).read()) for name in SILVER}
    jobs.add_increments(lake, batch, "w", 0)
    assert {name: as_rows(lake.silver(name).read()) for name in SILVER} == before
    jobs.add_increments(lake, batch, "w", 1)
    assert as_rows(lake.silver("country_views").read()) == [("EGYPT", 2)]


def test_batch_that_failed_half_way_is_completed(spark, tmp_path, make_log):
    lake = Lake(spark, str(tmp_path / "lake"))
    batch = make_log({}, {})
    jobs.add_increments(lake, batch, "w", 0, tables=("video_hour", "ages"))
    jobs.add_increments(lake, batch, "w", 0)
    assert as_rows(lake.silver("video_hour").read(), "views_count") == [(2,)]
    assert as_rows(lake.silver("country_views").read()) == [("EGYPT", 2)]


def test_gold_is_published_on_ticks(spark, tmp_path, make_log):
    lake = Lake(spark, str(tmp_path / "lake")).ensure()
    lake.silver("video_hour").add(rollups.video_hour(make_log({}, {})), "w", 0)
    query = jobs.start_gold(lake, str(tmp_path / "ck"), period="1 second", clock=lambda: 60.0)
    deadline = time.time() + 60
    while query.lastProgress is None and query.isActive and time.time() < deadline:
        time.sleep(0.5)
    query.stop()
    assert query.exception() is None
    board = Dashboard(lake)
    assert as_rows(board.top_watched_videos("last_hour")) == [(11, 2, 0, 0, 1)]


def event_files(spark, folder, *files):
    schema = "action string, video_id int, timestamp_seconds long"
    os.makedirs(folder, exist_ok=True)
    for i, rows in enumerate(files):
        lines = [json.dumps(dict(zip(("action", "video_id", "timestamp_seconds"), r)))
                 for r in rows]
        drop(folder, f"{i}.json", lines)
        os.utime(f"{folder}/{i}.json", (1_000 + i, 1_000 + i))
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(folder)


def run(stream, root):
    (
        stream.writeStream.format("parquet")
        .option("path", f"{root}/out")
        .option("checkpointLocation", f"{root}/ck")
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{root}/out")


def test_hourly_window_closes_with_the_watermark(spark, tmp_path):
    hour = 3600
    stream = event_files(
        spark,
        f"{tmp_path}/in",
        [("first_views", 11, 5), ("likes", 11, 6), ("first_views", 12, hour + 1)],
        [("views", 11, 4 * hour)],
        [("views", 11, 4 * hour + 1)],
        [("first_views", 11, 7)],  # its hour has been closed two batches ago
    )
    found = run(windows.hourly_window(stream, "video_id", "1 hour"), tmp_path)
    assert as_rows(found) == [(11, 0, 1, 1, 0), (12, hour, 1, 0, 0)]


def test_hourly_window_loses_nothing_without_watermark(spark, tmp_path):
    hour = 3600
    files = [
        [("first_views", 11, 5 * hour), ("likes", 11, 6)],
        [("views", 11, 40 * hour)],
        [("first_views", 11, 7), ("likes", 12, hour)],
    ]
    stream = event_files(spark, f"{tmp_path}/in", *files)
    windows.start_hourly_window(
        stream, "video_id", f"{tmp_path}/out", f"{tmp_path}/ck"
    ).awaitTermination()
    found = windows.hourly_rows(spark, f"{tmp_path}/out", "video_id")
    assert as_rows(found, "video_id", "hour_timestamp", "views_count", "likes_count", "minutes_count") == [
        (11, 0, 1, 1, 0), (11, 40 * hour, 0, 0, 1), (11, 5 * hour, 1, 0, 0), (12, hour, 0, 1, 0),
    ]


def test_hourly_window_is_the_same_for_any_file_limit(spark, sf_dir, tmp_path):
    from reelmetrics.plans.registry import hourly_windows

    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    events.repartition(6).write.parquet(f"{tmp_path}/events.parquet")
    found = [as_rows(hourly_windows(spark, str(tmp_path), limit)) for limit in (1, 3, 1000)]
    assert found[0] == found[1] == found[2] and len(found[0]) > 500


def test_dedup_stream_keeps_the_first(spark, tmp_path):
    stream = event_files(
        spark,
        f"{tmp_path}/in",
        [("likes", 11, 100)],
        [("likes", 11, 100), ("likes", 12, 100)],
    ).withColumn("event_time", F.timestamp_seconds("timestamp_seconds"))
    found = run(windows.dedup_stream(stream, ["video_id", "timestamp_seconds"]), tmp_path)
    assert as_rows(found, "video_id") == [(11,), (12,)]


def test_shared_dir_follows_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    first, second = shared_dir(spark, "x"), shared_dir(spark, "x")
    assert first.startswith(f"{base}/x-") and first != second
