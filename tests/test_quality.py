from conftest import as_rows
from reelmetrics.operators import quality, rollups

SCHEMA = "channel_id int, country string, views_count long"
KEYS = ["channel_id", "country"]


def test_accuracy_over_compared_pairs_only(spark):
    gold = spark.createDataFrame([(1, "A", 8), (2, "A", 12), (3, "A", 1)], SCHEMA)
    truth = spark.createDataFrame([(1, "A", 10), (2, "A", 10), (4, "A", 5)], SCHEMA)
    report = quality.accuracy_report(gold, truth, KEYS)
    assert as_rows(report) == [
        (1, "A", 10, 8, 0.2, 0.2),
        (2, "A", 10, 12, -0.2, 0.2),
        (3, "A", None, 1, None, None),
        (4, "A", 5, None, 1.0, 1.0),
    ]
    assert as_rows(quality.accuracy_summary(report)) == [(2, 0.0, 0.2)]


def test_samples_repeat(spark):
    pairs = spark.createDataFrame([(i, "A", i) for i in range(500)], SCHEMA)
    first = as_rows(quality.sample_pairs(pairs, KEYS, 10))
    assert first == as_rows(quality.sample_pairs(pairs.repartition(7), KEYS, 10))
    assert 20 < len(first) < 90
    assert quality.sample_pairs(pairs, KEYS, 1).count() == 500


def test_freshness(make_log):
    log = make_log({"timestamp_seconds": 7300}, {"action": "comments", "timestamp_seconds": 9000})
    silver = rollups.video_hour(log)
    assert as_rows(quality.freshness(log, silver)) == [(7300, 7200, 0)]
    more = log.unionByName(make_log({"timestamp_seconds": 15_000}))
    assert as_rows(quality.freshness(more, silver)) == [(15_000, 7200, 7200)]
