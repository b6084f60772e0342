"""Gold snapshots from the silver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from reelmetrics.operators import boards, gold
from reelmetrics.operators.merges import sum_measures
from reelmetrics.schemas import SILVER
from reelmetrics.sources.stored import Lake


def gold_snapshots(lake: Lake, as_of: int, month_days: int = 30) -> dict[str, DataFrame]:
    """Every gold table as of ``as_of``.

    Counters are sums of silver counters, so unmerged parts are read and no
    log row is touched; windows read the days they cover.
    """
    silver = {name: lake.silver(name).rows() for name in SILVER}
    return {
        "video": gold.window_totals_served(
            silver["video_hour"], silver["video_total"], "video_id", as_of, month_days
        ),
        "channel": gold.window_totals_served(
            silver["channel_hour"], silver["channel_total"], "channel_id", as_of, month_days
        ),
        "ages": gold.channel_ages(silver["ages"]),
        "countries": gold.channel_countries(silver["countries"]),
        "interaction": boards.peak_hour(silver["interaction"], ["channel_id", "country"]),
        "comments": sum_measures(
            silver["comment"], ["video_id"], ["comments_count", "positive_count"]
        ),
    }


def refresh_gold(lake: Lake, as_of: int, month_days: int = 30) -> None:
    """Publish all gold tables together; rows that left a window vanish."""
    lake.publish(gold_snapshots(lake, as_of, month_days), as_of)
