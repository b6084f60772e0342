import pytest

from conftest import as_rows
from reelmetrics.functions.timing import DAY, HOUR, LEVELS, window_start
from reelmetrics.operators import gold, rollups
from reelmetrics.plans import serving
from reelmetrics.sources import testbed
from reelmetrics.sources.testbed import AS_OF

COUNTS = ["views_count", "likes_count", "minutes_count"]


@pytest.fixture(scope="module")
def log(spark, sf_dir):
    return testbed.actions(spark, sf_dir, country=True).cache()


@pytest.mark.parametrize("key,rollup", [("video_id", rollups.video_hour),
                                        ("channel_id", rollups.channel_hour)])
def test_gold_equals_the_log(log, key, rollup):
    silver = rollup(log)
    every_level = gold.window_totals_all(silver, key, AS_OF)
    for level in LEVELS:
        through_silver = as_rows(gold.window_totals(silver, key, level, AS_OF), key, *COUNTS)
        assert as_rows(serving.at_level(every_level, level), key, *COUNTS) == through_silver
        start = window_start(level, AS_OF)
        raw = gold.window_totals_raw(log.where(log.timestamp_seconds >= start), key)
        counted = [row for row in through_silver if any(row[1:])]
        assert as_rows(raw, key, *COUNTS) == counted


@pytest.mark.parametrize(
    "key,hours,totals",
    [("video_id", rollups.video_hour, rollups.video_total),
     ("channel_id", rollups.channel_hour, rollups.channel_total)],
)
@pytest.mark.parametrize("month_days", [28, 30])
def test_kept_totals_serve_all_time(log, key, hours, totals, month_days):
    from_hours = gold.window_totals_all(hours(log), key, AS_OF, month_days)
    served = gold.window_totals_served(hours(log), totals(log), key, AS_OF, month_days)
    assert as_rows(served) == as_rows(from_hours)


@pytest.mark.parametrize("key,value,rollup", [("video_id", 55, rollups.video_hour),
                                              ("channel_id", 5, rollups.channel_hour),
                                              ("video_id", 9999, rollups.video_hour)])
def test_three_ways_to_a_history_agree(log, key, value, rollup):
    silver = rollup(log)
    raw = as_rows(gold.history_raw(log, key, value, AS_OF))
    assert len(raw) == 5
    assert as_rows(gold.history(silver, key, value, AS_OF)) == raw
    levels = gold.window_totals_all(silver, key, AS_OF)
    assert as_rows(gold.history_of_levels(levels, key, value)) == raw


def test_unknown_video_has_zero_history(log):
    rows = as_rows(gold.history_raw(log, "video_id", 9999, AS_OF), *COUNTS)
    assert rows == [(0, 0, 0)] * 5


def test_rows_leave_the_window(make_log):
    silver = rollups.video_hour(make_log({"timestamp_seconds": 10 * HOUR + 5}))
    assert gold.window_totals(silver, "video_id", "last_hour", 10 * HOUR + 900).count() == 1
    assert gold.window_totals(silver, "video_id", "last_hour", 11 * HOUR).count() == 0
    levels = gold.window_totals_all(silver, "video_id", 11 * HOUR)
    assert "last_hour" not in {r.level for r in levels.collect()}


def test_month_days(make_log):
    as_of = 59 * DAY
    silver = rollups.video_hour(make_log({"timestamp_seconds": 40 * DAY}))
    assert gold.window_totals(silver, "video_id", "last_month", as_of).count() == 1
    assert gold.window_totals(silver, "video_id", "last_month", as_of, month_days=28).count() == 0


def test_unknown_level_is_refused(spark):
    frame = spark.createDataFrame([("last_day", 1)], "level string, video_id int")
    with pytest.raises(ValueError):
        serving.at_level(frame, "day")


def test_json_rows_leave_nulls_out(spark):
    frame = spark.createDataFrame([(1, None), (2, 3)], "a int, b int")
    assert as_rows(serving.to_json_rows(frame)) == [('{"a":1}',), ('{"a":2,"b":3}',)]
