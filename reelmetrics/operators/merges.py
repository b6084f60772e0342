"""Upserts of increments and snapshots, and last-write-wins keys."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType


def sum_measures(frame: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Add up counters per key; a missing counter counts as zero."""
    return frame.groupBy(*keys).agg(
        *(F.sum(F.coalesce(F.col(m), F.lit(0))).alias(m) for m in measures)
    )


def merge_additive(
    current: DataFrame, increment: DataFrame, keys: Sequence[str], measures: Sequence[str]
) -> DataFrame:
    """Matched keys add their counters, new keys are inserted.

    Sums are associative, so any split of a log into increments gives the
    rollup of the whole log.
    """
    columns = [*keys, *measures]
    both = current.select(*columns).unionByName(increment.select(*columns))
    return sum_measures(both, keys, measures)


def merge_overwrite(current: DataFrame, snapshot: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Matched keys take the snapshot's row, others stay, new keys are inserted.

    A NULL in a key matches a NULL.
    """
    given = snapshot.select(*(F.col(k).alias(f"_{k}") for k in keys))
    same = reduce(lambda a, b: a & b, (current[k].eqNullSafe(given[f"_{k}"]) for k in keys))
    return current.join(given, same, "left_anti").unionByName(snapshot)


def dedup_last_write(frame: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row per key by ``order``.

    With one number to order by and numbers to keep this is a hash aggregate: a hot
    key sends one row per task and nothing is sorted. A row whose order is NULL stays only
    where its key has no other. Otherwise rows are ranked, and the rank filter is pushed below
    the exchange as a per-task group limit.
    """
    kept = [c for c in frame.columns if c not in {*keys, *order}]
    kinds = {f.name: f.dataType for f in frame.schema.fields}
    if len(order) == 1 and all(isinstance(kinds[c], NumericType) for c in (*order, *kept)):
        last = F.coalesce(F.col(order[0]), F.lit(-(2**63)))
        best = [F.max_by(c, last).alias(c) for c in kept]
        found = frame.groupBy(*keys).agg(*best, F.max(order[0]).alias(order[0]))
        return found.select(*frame.columns)
    newest = W.partitionBy(*keys).orderBy(*(F.desc(c) for c in order))
    return (
        frame.withColumn("_age", F.row_number().over(newest)).where(F.col("_age") == 1).drop("_age")
    )


# Primary keys of the raw action tables, by clustering.
RAW_KEYS = {
    "video": ("video_id", "channel_id", "timestamp_seconds"),
    "age": ("channel_id", "user_age", "video_id", "timestamp_seconds"),
    "country": ("channel_id", "user_country", "video_id", "timestamp_seconds"),
}
