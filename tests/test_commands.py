"""The command line, from messages to answers."""

import json

import pytest

from reelmetrics.__main__ import main
from reelmetrics.plans import audit
from reelmetrics.sources.stored import Lake


def body(**changes):
    base = {"timestamp": 36_000, "user_id": 100_001, "user_country": "Egypt", "user_age": 20,
            "channel_id": 1, "video_id": 12}
    return json.dumps({**base, **changes})


def answers(capsys, *argv):
    capsys.readouterr()
    main(list(argv))
    return [json.loads(line) for line in capsys.readouterr().out.splitlines() if line[:1] == "{"]


def test_messages_to_answers(spark, tmp_path, capsys):
    root, inbox = str(tmp_path / "lake"), tmp_path / "in"
    inbox.mkdir()
    (inbox / "a.json").write_text("\n".join([body(), body(timestamp=36_001), "junk"]))
    main(["--root", root, "bronze", "first_views", "--path", str(inbox)])
    main(["--root", root, "silver"])
    main(["--root", root, "gold", "--as-of", "36100"])
    assert answers(capsys, "--root", root, "query", "top_watched_videos", "last_hour") == [
        {"video_id": 12, "views_count": 2, "likes_count": 0, "minutes_count": 0, "rank": 1}
    ]
    assert answers(capsys, "--root", root, "query", "count") == [{"records": 2}]
    assert answers(capsys, "--root", root, "query", "countries", "1") == [
        {"channel_id": 1, "country": "Egypt", "views_count": 2, "likes_count": 0,
         "minutes_count": 0}
    ]
    assert answers(capsys, "--root", root, "audit") == [
        {"compared_pairs": 1, "mean_signed_error": 0.0, "mean_absolute_error": 0.0}
    ]

    # A new view makes the published table stale until the next refresh.
    (inbox / "b.json").write_text(body(timestamp=40_000))
    main(["--root", root, "bronze", "first_views", "--path", str(inbox)])
    assert answers(capsys, "--root", root, "audit") == [
        {"compared_pairs": 1, "mean_signed_error": 0.333333, "mean_absolute_error": 0.333333}
    ]
    lake = Lake(spark, root)
    assert audit.lag(lake).first().asDict() == {
        "log_high_water": 40_000, "rollup_high_water": 36_000, "lag_seconds": 3_600
    }


def test_unknown_query_or_level_is_refused(tmp_path, spark):
    with pytest.raises(SystemExit):
        main(["--root", str(tmp_path), "query", "everything"])
    with pytest.raises(ValueError):
        main(["--root", str(tmp_path / "lake"), "query", "top_watched_videos", "hour"])
