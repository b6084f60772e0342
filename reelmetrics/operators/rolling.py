"""Rolling windows from two levels: whole hours from a rollup, cut hours from the log."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelmetrics.functions import timing
from reelmetrics.functions.measures import actions_of
from reelmetrics.functions.timing import HOUR
from reelmetrics.operators.merges import sum_measures
from reelmetrics.operators.rollups import between
from reelmetrics.schemas import MEASURE_ACTIONS


def rolling_counts(
    log: DataFrame,
    hours: DataFrame,
    key: str,
    measures: Sequence[str],
    start: int,
    end: int | None = None,
) -> DataFrame:
    """Counters per ``key`` of ``start <= time < end``; without ``end`` everything from ``start`` on.

    ``hours`` has additive counters per key and ``hour_timestamp``. Only the hours that the window
    cuts are counted from the log: two at most, whatever the length of the window, none if it is aligned.
    """
    first = start + -start % HOUR
    last = None if end is None else max(first, end - end % HOUR)
    hour = F.col("hour_timestamp")
    whole = hours.where(hour >= first if last is None else (hour >= first) & (hour < last))
    if "event_date" in hours.columns:
        whole = whole.where(F.col("event_date") >= timing.day_of(F.lit(first)))
        if last is not None:
            whole = whole.where(F.col("event_date") <= timing.day_of(F.lit(last)))
    parts = [whole.select(key, *measures)]
    cut = [(start, first), (last, end)] if end is None or end > first else [(start, end)]
    for low, high in cut:
        if low is not None and low < high:
            parts.append(_ones(between(log, low, high), key, measures))
    summed = sum_measures(reduce(DataFrame.unionByName, parts), [key], measures)
    return summed.where(" or ".join(f"{m} > 0" for m in measures))


def _ones(log: DataFrame, key: str, measures: Sequence[str]) -> DataFrame:
    """Log rows as counters of one, to be added up together with a rollup's."""
    action = F.col("action")
    return log.where(action.isin(*actions_of(measures))).select(
        key, *((action == MEASURE_ACTIONS[m]).cast("long").alias(m) for m in measures)
    )


def category_counts(per_video: DataFrame, videos: DataFrame, key: str) -> DataFrame:
    """First views per category and video, or channel of the dimension, from counts per video."""
    told = videos.select(F.col("id").alias("video_id"), "category", *(["channel_id"] if key == "channel_id" else []))
    return (
        per_video.join(told, "video_id")
        .groupBy("category", key)
        .agg(F.sum("views_count").alias("view_count"))
    )
