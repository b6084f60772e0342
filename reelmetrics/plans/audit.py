"""Audit of a lake: published tables against its own log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelmetrics.operators import quality, rollups
from reelmetrics.sources.stored import Lake

PAIR = ["channel_id", "country"]


def audit_countries(lake: Lake, one_in: int = 1) -> DataFrame:
    """Error of the published country counts; ``one_in`` samples the pairs."""
    country = F.col("user_country").alias("country")
    truth = rollups.rollup(lake.bronze(), ["channel_id", country], ["views_count"])
    published = lake.gold("countries").rows()
    if one_in > 1:
        truth = quality.sample_pairs(truth, PAIR, one_in)
        published = quality.sample_pairs(published, PAIR, one_in)
    return quality.accuracy_report(published, truth, PAIR)


def lag(lake: Lake) -> DataFrame:
    """How far the hourly rollup is behind the log."""
    return quality.freshness(lake.bronze(), lake.silver("video_hour").rows())
