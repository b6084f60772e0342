import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import as_rows
from reelmetrics.functions import timing
from reelmetrics.functions.timing import DAY, window_start
from reelmetrics.sources.testbed import AS_OF


def test_window_starts_are_aligned():
    assert window_start("last_hour", AS_OF) == 1_706_655_600
    assert window_start("last_day", AS_OF) == 1_706_572_800
    assert window_start("last_week", AS_OF) % (7 * DAY) == 0
    assert window_start("last_month", AS_OF) == 1_705_536_000
    assert window_start("alltime", AS_OF) == 0


def test_month_length_is_a_parameter():
    as_of = 59 * DAY
    assert window_start("last_month", as_of) == 30 * DAY
    assert window_start("last_month", as_of, month_days=28) == 56 * DAY


def test_unknown_level_raises():
    with pytest.raises(ValueError):
        window_start("hour", AS_OF)


def test_columns(spark):
    frame = spark.createDataFrame([(90_061,), (86_399,)], "s long")
    s = F.col("s")
    rows = as_rows(
        frame.select(
            "s",
            timing.hour_bucket(s),
            timing.hour_of_day(s),
            timing.minute_index(s),
            timing.render_time(s),
            timing.day_of(s).cast("string"),
        )
    )
    assert rows == [
        (86_399, 82_800, 23, 1_439, "1970-01-01 23:59:59", "1970-01-01"),
        (90_061, 90_000, 1, 1_501, "1970-01-02 01:01:01", "1970-01-02"),
    ]


@given(st.integers(0, 4_000_000_000), st.sampled_from(timing.LEVELS[:-1]), st.integers(1, 31))
def test_a_window_holds_its_as_of(as_of, level, month_days):
    size = {
        "last_hour": timing.HOUR,
        "last_day": DAY,
        "last_week": timing.WEEK,
        "last_month": month_days * DAY,
    }[level]
    start = window_start(level, as_of, month_days)
    assert start % size == 0 and start <= as_of < start + size
