from pyspark.sql import functions as F

from conftest import as_rows
from reelmetrics.operators import boards


def totals(spark, rows, schema="video_id int, views_count long"):
    return spark.createDataFrame(rows, schema)


def test_ties_go_to_the_smaller_id(spark):
    tied = totals(spark, [(v, 5) for v in range(22, 10, -1)])
    found = boards.top_k(tied, "views_count", "video_id").collect()
    assert [r.video_id for r in found] == list(range(11, 21))
    assert [r["rank"] for r in found] == list(range(1, 11))


def test_sorted_before_limited(spark):
    frame = totals(spark, [(v, v) for v in range(100)]).repartition(8)
    found = boards.top_k(frame, "views_count", "video_id", 3).collect()
    assert [r.video_id for r in found] == [99, 98, 97]


def test_missing_count_is_zero(spark):
    frame = totals(spark, [(1, None), (2, 1)])
    assert as_rows(boards.top_k(frame, "views_count", "video_id")) == [(1, 0, 2), (2, 1, 1)]


def test_top_k_per_group_equals_brute_force(spark):
    rows = [(f"c{v % 3}", v, (v * 37) % 11) for v in range(120)]
    frame = totals(spark, rows, "category string, video_id int, view_count long").repartition(8)
    found = as_rows(
        boards.top_k_per_group(frame, "category", "view_count", "video_id", 4).select(
            "category", "video_id", "rank"
        )
    )
    expected = []
    for category in ("c0", "c1", "c2"):
        ranked = sorted((r for r in rows if r[0] == category), key=lambda r: (-r[2], r[1]))
        expected += [(category, r[1], i + 1) for i, r in enumerate(ranked[:4])]
    assert found == sorted(expected, key=repr)


def test_category_totals_count_before_joining(spark, make_log):
    videos = spark.createDataFrame([(11, "Music"), (12, "Music")], "id int, category string")
    log = make_log({"video_id": 11}, {"video_id": 12}, {"video_id": 12}, {"action": "likes"})
    assert as_rows(boards.category_totals(log, videos, "channel_id")) == [("Music", 1, 3)]
    assert as_rows(boards.category_totals(log, videos, "video_id")) == [
        ("Music", 11, 1),
        ("Music", 12, 2),
    ]


def test_latest(make_log):
    log = make_log(*({"timestamp_seconds": s} for s in (3, 9, 9, 1)))
    assert [r.event_id for r in boards.latest(log, 3, "event_id").collect()] == [2, 1, 0]


def test_global_peak(make_log):
    log = make_log(
        {"timestamp_seconds": 0},
        {"timestamp_seconds": 3600, "user_country": "CHINA"},
        {"timestamp_seconds": 3601, "user_country": "CHINA"},
        {"timestamp_seconds": 1, "action": "views"},
        {"timestamp_seconds": 2, "action": "views"},
    )
    hour = F.floor(F.col("timestamp_seconds") / 3600)
    assert as_rows(boards.global_peak(log, ["first_views"], hour)) == [(1, "CHINA", 2)]
