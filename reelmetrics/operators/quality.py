"""Audit of rollups against the log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelmetrics.functions.measures import VIEWS_LIKES_MINUTES, actions_of
from reelmetrics.functions.timing import hour_bucket


def accuracy_report(
    gold: DataFrame, truth: DataFrame, keys: Sequence[str], measure: str = "views_count"
) -> DataFrame:
    """Relative error ``(truth - gold) / truth`` per key, signed and absolute.

    Keys on one side only stay in the report; without a truth there is no error.
    """
    pairs = truth.select(*keys, F.col(measure).alias("truth")).join(
        gold.select(*keys, F.col(measure).alias("gold")), list(keys), "full"
    )
    error = F.try_divide(F.col("truth") - F.coalesce("gold", F.lit(0)), F.col("truth"))
    return pairs.select(
        *keys,
        "truth",
        "gold",
        F.round(error, 6).alias("signed_error"),
        F.round(F.abs(error), 6).alias("absolute_error"),
    )


def accuracy_summary(report: DataFrame) -> DataFrame:
    """Mean errors over the pairs that could be compared."""
    return report.where(F.col("truth").isNotNull() & F.col("gold").isNotNull()).agg(
        F.count(F.lit(1)).alias("compared_pairs"),
        F.round(F.avg("signed_error"), 6).alias("mean_signed_error"),
        F.round(F.avg("absolute_error"), 6).alias("mean_absolute_error"),
    )


def sample_pairs(frame: DataFrame, keys: Sequence[str], one_in: int) -> DataFrame:
    """A repeatable sample of keys, for a cheap spot check."""
    return frame.where(F.pmod(F.xxhash64(*keys), F.lit(one_in)) == 0)


def freshness(log: DataFrame, silver: DataFrame) -> DataFrame:
    """Newest counted second of the log, newest hour of the rollup, and how many seconds
    of whole hours the rollup lacks: 0 once it holds every counted row."""
    newest = silver.agg(F.max("hour_timestamp").alias("rollup_high_water")).scalar()
    counted = log.where(F.col("action").isin(*actions_of(VIEWS_LIKES_MINUTES)))
    return counted.agg(F.max("timestamp_seconds").alias("log_high_water")).select(
        "log_high_water",
        newest.alias("rollup_high_water"),
        (hour_bucket(F.col("log_high_water")) - newest).alias("lag_seconds"),
    )
