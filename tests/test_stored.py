"""Stored tables: once-only increments, folds, snapshots, layouts."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from conftest import as_rows
from reelmetrics.operators import rollups
from reelmetrics.operators.gold import window_totals_served
from reelmetrics.plans.refresh import refresh_gold
from reelmetrics.plans.serving import Dashboard
from reelmetrics.schemas import BRONZE, GOLD, SILVER
from reelmetrics.sources.stored import LAYOUTS, ORIGINS, Lake, StoredTable
from reelmetrics.sources.wire import with_times

HOUR = 3600


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "lake"))


def test_ensure_creates_empty_tables_once(lake):
    lake.ensure()
    for name, spec in SILVER.items():
        assert lake.silver(name).read().schema.names == spec.schema.names
    for name in GOLD:
        assert lake.gold(name).rows().count() == 0
    assert lake.silver("ages").ensure()._newest() == 0


def test_a_replayed_batch_counts_once(lake, make_log):
    table = lake.silver("video_hour")
    assert table.add(rollups.video_hour(make_log({})), "w", 0)
    assert table.add(rollups.video_hour(make_log({}, {})), "w", 1)
    assert not table.add(rollups.video_hour(make_log({}, {})), "w", 1)
    assert not table.add(rollups.video_hour(make_log({})), "w", 0)
    assert table.add(rollups.video_hour(make_log({})), "other", 0)
    assert as_rows(table.read(), "views_count") == [(4,)]


def test_a_batch_lost_before_its_commit_is_rewritten(lake, make_log):
    table = lake.silver("video_hour")
    table._write(rollups.video_hour(make_log({}, {}, {})), "w-0000000000")
    assert table.read().count() == 0
    assert table.add(rollups.video_hour(make_log({})), "w", 0)
    assert as_rows(table.read(), "views_count") == [(1,)]


def test_folding_keeps_the_sums(lake, make_log):
    table = lake.silver("video_hour")
    for batch in range(5):
        increment = make_log({"timestamp_seconds": batch % 2 * HOUR}, {"action": "likes"})
        table.add(rollups.video_hour(increment), "w", batch)
    before = as_rows(table.read())
    table.tidy(increments=3, folds=1)
    assert len(table._manifest()["parts"]) == 1
    assert as_rows(table.read()) == before
    assert not table.add(rollups.video_hour(make_log({})), "w", 4)
    for batch in range(5, 9):
        table.add(rollups.video_hour(make_log({})), "w", batch)
    table.tidy(increments=3, folds=1)
    assert len(table._manifest()["parts"]) == 2
    table.tidy(increments=3, folds=1)
    assert len(table._manifest()["parts"]) == 1
    total = table.read().agg(F.sum("views_count")).first()[0]
    assert total == 5 + 4
    table.vacuum()
    assert table.read().agg(F.sum("views_count")).first()[0] == total


def test_a_lost_checkpoint_is_refused_until_the_table_is_cleared(lake, make_log):
    table = lake.silver("ages")
    table.add(rollups.ages(make_log({})), "stream.run1", 0)
    with pytest.raises(RuntimeError, match="rebuild"):
        table.add(rollups.ages(make_log({}, {})), "stream.run2", 0)
    table.clear()
    assert table.add(rollups.ages(make_log({}, {})), "stream.run2", 0)
    assert as_rows(table.read(), "views_count") == [(2,)]


def test_tables_answer_sql(spark, lake, make_log):
    lake.ensure().bulk_append(bronze_rows(make_log({}, {"user_country": "CHINA"})), "first_views")
    lake.silver("countries").add(rollups.countries(lake.bronze()), "w", 0)
    lake.register_views()
    counted = spark.sql("SELECT country, sum(views_count) FROM silver_countries GROUP BY country")
    raw = spark.sql("SELECT user_country, count(*) FROM bronze GROUP BY user_country")
    assert as_rows(counted) == as_rows(raw) == [("CHINA", 1), ("EGYPT", 1)]


def test_publish_replaces(spark, lake):
    table = lake.gold("comments")
    schema = "video_id int, comments_count long, positive_count long"
    table.publish(spark.createDataFrame([(1, 2, 1), (2, 3, 3)], schema))
    table.publish(spark.createDataFrame([(2, 4, 3)], schema))
    assert as_rows(table.rows()) == [(2, 4, 3)]


def test_manifest_survives_two_handles(spark, lake, make_log):
    lake.silver("ages").add(rollups.ages(make_log({})), "w", 0)
    again = StoredTable(spark, f"{lake.root}/silver", SILVER["ages"])
    assert as_rows(again.read()) == [(11, 1, 30, 1, 0, 0)]


def bronze_rows(log):
    return with_times(log).select(*BRONZE.names)


def test_bulk_append_and_pruning(lake, make_log):
    log = make_log(*({"timestamp_seconds": s, "action": a} for s in (5, 86_405, 200_000)
                     for a in ("likes", "views")))
    lake.ensure()
    for layout in ("video", "age"):
        for action in ("likes", "views"):
            lake.bulk_append(bronze_rows(log), action, layout)
    assert lake.bronze().count() == 12
    day = rollups.between(lake.bronze(), 86_400, 172_800)
    assert day.count() == 4
    assert {r.event_date for r in day.collect()} == {date(1970, 1, 2)}
    likes = day.where("action = 'likes'")
    assert likes.count() == 2
    plan = likes._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == len(ORIGINS)  # other actions' folders are not read
    assert "PartitionFilters: [isnotnull(event_date" in plan
    assert "PushedFilters: [IsNotNull(timestamp_seconds)" in plan


@pytest.mark.parametrize("layout", LAYOUTS)
def test_layouts_sort_within_files(lake, make_log, layout):
    rows = [{"video_id": 11 + i * 7 % 5, "user_age": 10 + i * 3 % 4, "timestamp_seconds": i}
            for i in range(40)]
    lake.ensure().bulk_append(bronze_rows(make_log(*rows)), "first_views", layout)
    stored = [tuple(r) for r in lake.bronze().select(*LAYOUTS[layout]).collect()]
    assert len(stored) == 40 and stored == sorted(stored)


def test_gold_reads_only_the_days_of_its_windows(lake, make_log):
    days = [86_400 * d for d in (1, 40, 99, 100)]
    lake.silver("video_hour").add(
        rollups.video_hour(make_log(*({"timestamp_seconds": s} for s in days))), "w", 0
    )
    silver = lake.silver("video_hour")
    served = window_totals_served(silver.rows(), silver.rows(), "video_id", 100 * 86_400)
    plan = served._jdf.queryExecution().executedPlan().toString()
    assert "(event_date#" in plan and ">= 1970-04-01)" in plan.split("PartitionFilters")[1]
    counted = {r.level: r.views_count for r in served.collect()}
    assert counted == {
        "last_hour": 1, "last_day": 1, "last_week": 2, "last_month": 2, "alltime": 4
    }


def test_gold_from_increments_and_dashboard(lake, make_log):
    as_of = 10 * HOUR + 100
    log = [
        {"timestamp_seconds": 10 * HOUR, "user_country": "EGYPT"},
        {"timestamp_seconds": 9 * HOUR, "user_country": "EGYPT"},
        {"timestamp_seconds": 9 * HOUR, "user_country": "CHINA", "video_id": 12},
        {"action": "likes", "timestamp_seconds": 9 * HOUR, "seconds_offset": 4},
        {"action": "views", "timestamp_seconds": 9 * HOUR, "seconds_offset": 4},
        {"action": "comments", "timestamp_seconds": 9 * HOUR, "comment_score": 1},
        {"action": "comments", "timestamp_seconds": 9 * HOUR, "comment_score": -1},
    ]
    for batch, rows in enumerate((log[:3], log[3:])):
        for name, rollup in rollups.SILVER_ROLLUPS.items():
            lake.silver(name).add(rollup(make_log(*rows)), "w", batch)
    refresh_gold(lake, as_of)
    board = Dashboard(lake)
    assert as_rows(board.top_watched_videos("last_hour")) == [(11, 1, 0, 0, 1)]
    assert as_rows(board.top_watched_videos("last_day"), "video_id", "views_count") == [
        (11, 2),
        (12, 1),
    ]
    assert as_rows(board.top_liked_channels("alltime"), "channel_id", "likes_count") == [(1, 1)]
    assert as_rows(board.video_history(11))[-2:] == [("last_month", 2, 1, 1), ("last_week", 2, 1, 1)]
    assert as_rows(board.channel_history(7), "views_count") == [(0,)] * 5
    assert as_rows(board.comments(11)) == [(1, 2)]
    assert as_rows(board.interaction(1)) == [(1, "CHINA", 9), (1, "EGYPT", 10)]
    assert as_rows(board.countries(1)) == [(1, "CHINA", 1, 0, 0), (1, "EGYPT", 2, 1, 1)]
    assert as_rows(board.ages(1)) == [(1, 30, 3, 1, 1)]
    assert as_rows(board.histogram(11)) == [(4, 1, 1)]

    refresh_gold(lake, as_of + HOUR)
    assert board.top_watched_videos("last_hour").count() == 0
