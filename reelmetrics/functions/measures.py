"""Conditional counters shared by all rollups."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from reelmetrics.schemas import MEASURE_ACTIONS

VIEWS_LIKES_MINUTES = ("views_count", "likes_count", "minutes_count")


def actions_of(measures: Iterable[str]) -> list[str]:
    """Actions that must be read to compute ``measures``."""
    return [MEASURE_ACTIONS[m] for m in measures]


def count_of(measure: str, when: Column | None = None) -> Column:
    """Rows of the action behind ``measure``, optionally only where ``when``."""
    hit = F.col("action") == MEASURE_ACTIONS[measure]
    return F.count_if(hit if when is None else hit & when).alias(measure)


def zero_if_null(column: Column) -> Column:
    return F.coalesce(column, F.lit(0))


def is_positive(score: Column) -> Column:
    return score == 1


def is_negative(score: Column) -> Column:
    return score == -1


def is_polar(score: Column) -> Column:
    return score != 0
