"""Native stateful variants: windowed counts and stream deduplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from reelmetrics.functions.measures import VIEWS_LIKES_MINUTES, actions_of, count_of
from reelmetrics.functions.timing import HOUR
from reelmetrics.sources.files import Folder


def hourly_window(stream: DataFrame, key: str, watermark: str | None = None) -> DataFrame:
    """Counters per ``key`` and hour of event time.

    ``watermark`` states the disorder of the source: rows later than that are not
    counted, and hours behind it leave the state. Without one no row is lost and the
    state keeps every hour; that needs update or complete mode.
    """
    timed = stream if "event_time" in stream.columns else stream.withColumn(
        "event_time", F.timestamp_seconds("timestamp_seconds")
    )
    counted = timed.where(F.col("action").isin(*actions_of(VIEWS_LIKES_MINUTES)))
    if watermark:
        counted = counted.withWatermark("event_time", watermark)
    return (
        counted.groupBy(F.window("event_time", "1 hour"), key)
        .agg(*(count_of(m) for m in VIEWS_LIKES_MINUTES))
        .select(
            key,
            F.unix_seconds("window.start").alias("hour_timestamp"),
            *VIEWS_LIKES_MINUTES,
        )
    )


def start_hourly_window(stream: DataFrame, key: str, path: str, checkpoint: str) -> StreamingQuery:
    """Count every micro-batch by ``key`` and hour, in a folder of its own.

    Counters are additive, so a batch is counted by itself: any disorder gives all hours and nothing
    is kept in state. A replayed batch overwrites its folder.
    """

    def write(rows: DataFrame, batch: int) -> None:
        hourly_window(rows, key).write.mode("overwrite").parquet(f"{path}/batch={batch}")

    return (
        stream.writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(write)
        .start()
    )


def hourly_rows(spark: SparkSession, path: str, key: str, closed_before: int | None = None) -> DataFrame:
    """Sums of the batches per key and hour; ``closed_before`` leaves out hours that end after that second.

    A source that never gave a batch has no rows.
    """
    keys = [key, "hour_timestamp"]
    fields = [T.StructField(key, T.IntegerType()), *(T.StructField(n, T.LongType()) for n in ("hour_timestamp", *VIEWS_LIKES_MINUTES))]
    Folder(spark, path).create()
    rows = spark.read.schema(T.StructType(fields)).parquet(path)
    if closed_before is not None:
        rows = rows.where(F.col("hour_timestamp") + HOUR <= closed_before)
    return rows.groupBy(*keys).agg(*(F.sum(m).alias(m) for m in VIEWS_LIKES_MINUTES))


def dedup_stream(stream: DataFrame, keys: Sequence[str], watermark: str = "2 hours") -> DataFrame:
    """One row per key within the watermark; the first to arrive stays."""
    return stream.withWatermark("event_time", watermark).dropDuplicatesWithinWatermark(list(keys))


def sent_once(messages: DataFrame, within: str) -> DataFrame:
    """Messages ``(topic, value)`` without those already sent within that time of arrival.

    The watermark is the time of arrival, so no message is ever late, whatever its own time, and the
    state holds 16 bytes of hash for every message of that time. Messages without text are one message.
    """
    arrived = messages.withColumns(
        {"event_time": F.current_timestamp(), "message_key": F.unhex(F.md5("value"))}
    )
    return dedup_stream(arrived, ["topic", "message_key"], within).select(*messages.columns)
