from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]
os.environ.setdefault("PYTHONPATH", ROOT)

from reelmetrics.session import local_session  # noqa: E402

LOG_SCHEMA = (
    "action string, timestamp_seconds long, video_id int, channel_id int, user_country string, "
    "user_age int, seconds_offset int, comment_score int, user_id int, event_id long"
)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        "tests", 4, spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared"))
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir() -> str:
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def make_log(spark):
    """Log rows from dicts; fields left out get plain defaults."""

    def build(*rows: dict):
        defaults = {
            "action": "first_views",
            "timestamp_seconds": 0,
            "video_id": 11,
            "channel_id": 1,
            "user_country": "EGYPT",
            "user_age": 30,
            "seconds_offset": None,
            "comment_score": None,
            "user_id": 1,
        }
        full = [{**defaults, "event_id": i, **row} for i, row in enumerate(rows)]
        names = [part.split()[0] for part in LOG_SCHEMA.split(", ")]
        return spark.createDataFrame([tuple(r[n] for n in names) for r in full], LOG_SCHEMA)

    return build


def as_rows(frame, *columns):
    """All rows as sorted tuples."""
    chosen = frame.select(*columns) if columns else frame
    return sorted((tuple(r) for r in chosen.collect()), key=repr)
