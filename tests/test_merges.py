"""Incremental equals batch, snapshots, last write wins."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import as_rows
from reelmetrics.operators import merges, rollups
from reelmetrics.schemas import SILVER


@pytest.fixture(scope="module")
def log(spark):
    """Some thousand rows over all actions, from one generator."""
    n = F.col("id")
    h = F.pmod(F.xxhash64(n), F.lit(1_000_003))
    action = F.element_at(
        F.array(*map(F.lit, ("views", "first_views", "likes", "subscribes", "comments"))),
        (h % 5 + 1).cast("int"),
    )
    return (
        spark.range(4_000)
        .select(
            action.alias("action"),
            (1_700_000_000 + h % 90_000).alias("timestamp_seconds"),
            (11 + h % 17).cast("int").alias("video_id"),
            (1 + h % 3).cast("int").alias("channel_id"),
            F.element_at(F.array(F.lit("EGYPT"), F.lit("CHINA")), (h % 2 + 1).cast("int")).alias(
                "user_country"
            ),
            (10 + h % 9).cast("int").alias("user_age"),
            (h % 7).cast("int").alias("seconds_offset"),
            (h % 3 - 1).cast("int").alias("comment_score"),
            n.alias("event_id"),
        )
        .cache()
    )


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("name", sorted(rollups.SILVER_ROLLUPS))
def test_any_split_merges_to_the_whole(spark, log, name, seed):
    spec, rollup = SILVER[name], rollups.SILVER_ROLLUPS[name]
    slices = random.Random(seed).randint(2, 4)
    part = F.pmod(F.xxhash64(F.col("event_id"), F.lit(seed)), F.lit(slices))
    current = rollup(log.where(part == 0))
    for i in range(1, slices):
        increment = rollup(log.where(part == i))
        current = merges.merge_additive(current, increment, spec.key_names, spec.measures)
    assert as_rows(current, *spec.schema.names) == as_rows(rollup(log), *spec.schema.names)


def test_missing_counters_add_as_zero(spark):
    current = spark.createDataFrame([(1, None), (2, 4)], "video_id int, likes_count long")
    increment = spark.createDataFrame([(1, 3), (2, None), (3, None)], current.schema)
    merged = merges.merge_additive(current, increment, ["video_id"], ["likes_count"])
    assert as_rows(merged) == [(1, 3), (2, 4), (3, 0)]


def test_subscribes_add_per_increment(make_log):
    first = rollups.channel_hour(make_log({"action": "subscribes"}))
    second = rollups.channel_hour(make_log({"action": "subscribes"}, {"action": "subscribes"}))
    spec = SILVER["channel_hour"]
    merged = merges.merge_additive(first, second, spec.key_names, spec.measures)
    assert as_rows(merged, "subscribes_count") == [(3,)]


def test_overwrite_keeps_rows_the_snapshot_lacks(spark):
    current = spark.createDataFrame([(1, 5), (2, 6)], "video_id int, views_count long")
    snapshot = spark.createDataFrame([(2, 1), (3, 9)], current.schema)
    assert as_rows(merges.merge_overwrite(current, snapshot, ["video_id"])) == [
        (1, 5),
        (2, 1),
        (3, 9),
    ]


def test_last_write_wins(make_log):
    log = make_log(
        {"timestamp_seconds": 5, "user_id": 1},
        {"timestamp_seconds": 5, "user_id": 2},
        {"timestamp_seconds": 6, "user_id": 3},
    )
    kept = merges.dedup_last_write(log, merges.RAW_KEYS["video"], ["event_id"])
    assert as_rows(kept, "timestamp_seconds", "user_id") == [(5, 2), (6, 3)]


def test_overwrite_matches_null_keys(spark):
    current = spark.createDataFrame([(None, 1), (1, 1)], "k int, n int")
    given = spark.createDataFrame([(None, 5)], "k int, n int")
    assert as_rows(merges.merge_overwrite(current, given, ["k"])) == [(1, 1), (None, 5)]


def test_numeric_dedup_is_a_hash_aggregate(spark):
    rows = [(1, 3, 10), (1, 4, 20), (2, None, 30), (2, 1, None), (3, None, 40)]
    frame = spark.createDataFrame(rows, "key int, event_id long, user_id int")
    kept = merges.dedup_last_write(frame, ["key"], ["event_id"])
    assert as_rows(kept, "key", "event_id", "user_id") == [(1, 4, 20), (2, 1, None), (3, None, 40)]
    text = kept._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in text and "Sort" not in text


def test_hot_key_dedup(spark):
    n = F.col("id")
    log = spark.range(100_000).select(
        F.when(n % 3 == 0, 1).otherwise(n % 50).alias("key"), n.alias("event_id")
    )
    kept = merges.dedup_last_write(log, ["key"], ["event_id"])
    expected = {r.key: r.m for r in log.groupBy("key").agg(F.max("event_id").alias("m")).collect()}
    assert dict(as_rows(kept)) == expected
