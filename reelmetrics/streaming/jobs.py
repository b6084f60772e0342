"""Streaming jobs: messages to bronze, bronze to silver increments."""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from reelmetrics.functions.text import lexicon_score
from reelmetrics.operators.dims import versions_of
from reelmetrics.operators.merges import RAW_KEYS
from reelmetrics.operators.rollups import SILVER_ROLLUPS
from reelmetrics.plans.refresh import refresh_gold
from reelmetrics.sources.files import Folder
from reelmetrics.sources.stored import LOOKUPS, Lake
from reelmetrics.sources.wire import ingest_rows
from reelmetrics.streaming.windows import sent_once

SILVER_PERIOD = "300 seconds"
GOLD_PERIOD = "600 seconds"

# Bronze columns the rollups read.
_ROLLUP_COLUMNS = (
    "action",
    "timestamp_seconds",
    "user_country",
    "user_age",
    "channel_id",
    "video_id",
    "seconds_offset",
    "comment_score",
    "video",
)


def _trigger(period: str | None) -> dict:
    """A fixed period, or all that is available and stop."""
    return {"processingTime": period} if period else {"availableNow": True}


def start_ingest(
    raw: DataFrame,
    lake: Lake,
    topic: str,
    checkpoint: str,
    period: str | None = None,
    scorer=lexicon_score,
    once_within: str | None = None,
    kinds: Sequence[str] = ("good", "bad"),
) -> StreamingQuery:
    """One topic's messages to its log folder, well-formed and malformed ones by one decoding.

    A micro-batch is one folder, written hidden and renamed when whole; a replayed batch finds it
    there and adds nothing. Rows are grouped by day first, so a batch makes about as many files as
    it has days. Counts of messages and rejects are observed by the same job and kept in
    ``lake.ingest_counts()``. ``once_within`` drops messages that were already sent within that time of arrival.
    """
    messages = raw.where(F.col("topic") == topic)
    if once_within:
        messages = sent_once(messages, once_within)
    rows = ingest_rows(messages, scorer if topic == "comments" else None)
    if len(kinds) == 1:
        rows = rows.where(F.col("kind") == kinds[0])
    folder = Folder(lake.spark, lake.log_path(topic, "stream"))
    counts = Folder(lake.spark, lake.counts_path())

    def write(batch: DataFrame, batch_id: int) -> None:
        writer = writer_name(lake, checkpoint)
        _own_log(folder, writer, kinds)
        name = f"{writer}-{batch_id:010d}"
        if folder.has_folder(f"batch={name}"):
            return
        seen = Observation()
        observed = batch.observe(
            seen,
            F.count(F.lit(1)).alias("messages"),
            F.count_if(F.col("kind") == "bad").alias("rejects"),
        )
        hidden = f"_writing-{uuid.uuid4().hex}"
        (
            observed.drop("action")
            .hint("rebalance", "kind", "event_date")
            .sortWithinPartitions("kind", "event_date", *RAW_KEYS["video"])
            .write.options(**LOOKUPS)
            .partitionBy("kind", "event_date")
            .parquet(f"{folder.path}/{hidden}")
        )
        # The plan of an empty batch is cut short and observes nothing.
        found = seen.get if folder.matching(f"{hidden}/kind=*") else {"messages": 0, "rejects": 0}
        counts.delete(f"{topic}-{name}.json")
        counts.write_new(f"{topic}-{name}.json", json.dumps({"topic": topic, "batch": name, **found}))
        folder.rename(hidden, f"batch={name}")

    return (
        rows.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**_trigger(period))
        .start()
    )


def _own_log(folder: Folder, writer: str, kinds: Sequence[str]) -> None:
    """Refuse a second run: its batch ids mean other messages, and the log holds the first run's."""
    run = writer.split(".")[1]
    names = folder.names()
    for kind in kinds:
        mark = f"_run-{kind}"
        if mark not in names:
            folder.write_new(mark, run)
        elif folder.read(mark) != run:
            raise RuntimeError(
                f"{folder.path} was fed by another run: its checkpoint is gone. Start again in an empty "
                "folder, or delete the mark to go on where the source's offsets say."
            )


def start_bronze(
    raw: DataFrame,
    lake: Lake,
    topic: str,
    checkpoint: str,
    period: str | None = None,
    scorer=lexicon_score,
) -> StreamingQuery:
    """``start_ingest`` of the well-formed messages alone."""
    return start_ingest(raw, lake, topic, checkpoint, period, scorer, kinds=("good",))


def start_rejects(
    raw: DataFrame, lake: Lake, topic: str, checkpoint: str, period: str | None = None
) -> StreamingQuery:
    """``start_ingest`` of the malformed messages alone."""
    return start_ingest(raw, lake, topic, checkpoint, period, kinds=("bad",))


def add_increments(
    lake: Lake, batch: DataFrame, writer: str, batch_id: int, tables=tuple(SILVER_ROLLUPS)
) -> None:
    """Roll one batch up into every silver table, each exactly once.

    A batch for several tables is read once; the cache is only a saving, a lost
    block is recomputed from the batch's input.
    """
    rows = batch.select(*(c for c in _ROLLUP_COLUMNS if c in batch.columns))
    if len(tables) > 1:
        rows = rows.persist()
    try:
        for name in tables:
            lake.silver(name).add(SILVER_ROLLUPS[name](rows), writer, batch_id)
        if "video" in rows.columns:
            lake.videos().add(versions_of(rows), f"{writer}-{batch_id:010d}")
    finally:
        if len(tables) > 1:
            rows.unpersist()


def compact(lake: Lake, increments: int = 48, folds: int = 16) -> None:
    """Fold increments of the rollups and parts of the dimension; a job of its own, beside the streams."""
    for name in SILVER_ROLLUPS:
        table = lake.silver(name)
        if table.by_day:
            table.compact_days(increments)
        else:
            table.tidy(increments, folds)
    lake.videos().compact()


def writer_name(lake: Lake, checkpoint: str) -> str:
    """A writer is a checkpoint path, its run the query id kept in the checkpoint."""
    run = json.loads(Folder(lake.spark, checkpoint).read("metadata"))["id"]
    return f"{hashlib.md5(checkpoint.encode()).hexdigest()[:12]}.{run}"


def start_silver(
    bronze: DataFrame,
    lake: Lake,
    checkpoint: str,
    period: str | None = None,
    tables=tuple(SILVER_ROLLUPS),
) -> StreamingQuery:
    """Keep the silver tables up to date with the bronze stream."""

    def add(batch: DataFrame, batch_id: int) -> None:
        add_increments(lake, batch, writer_name(lake, checkpoint), batch_id, tables)

    return (
        bronze.writeStream.foreachBatch(add)
        .option("checkpointLocation", checkpoint)
        .trigger(**_trigger(period))
        .start()
    )


def start_gold(
    lake: Lake,
    checkpoint: str,
    period: str = GOLD_PERIOD,
    clock: Callable[[], float] = time.time,
    month_days: int = 30,
) -> StreamingQuery:
    """Publish the gold tables every ``period``.

    The ticks come from Spark's rate source, not from new data: windows move on
    even when no message arrives.
    """
    ticks = lake.spark.readStream.format("rate").option("rowsPerSecond", 1).load()
    return (
        ticks.writeStream.foreachBatch(
            lambda _, batch_id: refresh_gold(lake, int(clock()), month_days)
        )
        .option("checkpointLocation", checkpoint)
        .trigger(**_trigger(period))
        .start()
    )
