"""Stored tables: the bronze log, additive rollups and published snapshots.

A rollup table is a set of immutable parts, one per increment. Counters are
additive, so reading is a union of the parts and a sum, and adding an
increment never rewrites what is stored. The newest numbered manifest names
the live parts and the last batch of each writer: a replayed batch overwrites
its own part or is skipped, and is never counted twice. One writer adds; folding
may run beside it.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamReader

from reelmetrics.functions.timing import day_of
from reelmetrics.operators.merges import RAW_KEYS, sum_measures
from reelmetrics.operators.rollups import union_actions
from reelmetrics.schemas import BRONZE, GOLD, REJECTS, SILVER, TOPICS, VIDEO_VERSION, TableSpec
from reelmetrics.sources.dimension import VideoDimension
from reelmetrics.sources.files import Folder

ORIGINS = ("stream", "bulk")

# Bloom filters of the looked-up columns, sized by the values that a row group has. Files are sorted by one
# key order; lookups by another column skip row groups by these.
LOOKUPS = {
    "parquet.bloom.filter.adaptive.enabled": "true",
    **{f"parquet.bloom.filter.enabled#{c}": "true" for c in ("video_id", "channel_id")},
}

# The folder names the action, so files do not hold it.
_ON_DISK = T.StructType([f for f in BRONZE.fields if f.name != "action"])
# Folders above the days: a batch of messages with its good and bad ones, or a load.
_ABOVE = {"stream": ("batch", "kind"), "bulk": ("load",)}

# Sort orders inside bronze files, one per access path. File statistics then
# let a lookup skip row groups, which replaces one copy of the log per path.
LAYOUTS = RAW_KEYS


class StoredTable:
    """One rollup or snapshot table below ``root``."""

    def __init__(self, spark: SparkSession, root: str, spec: TableSpec):
        self.spark = spark
        self.spec = spec
        self.path = f"{root.rstrip('/')}/{spec.name}"
        self._log = Folder(spark, f"{self.path}/_manifests")

    # -- manifest ---------------------------------------------------------

    def _newest(self) -> int:
        return max((int(n[:-5]) for n in self._log.names() if n[0].isdigit()), default=-1)

    def _state(self) -> dict:
        newest = self._newest()
        return json.loads(self._log.read(f"{newest:010d}.json")) if newest >= 0 else {}

    def _manifest(self) -> dict:
        return {"parts": [], "batches": {}, "days": {}} | self._state()

    @property
    def by_day(self) -> bool:
        return "event_date" in self.spec.partitions

    def _commit(self, change: Callable[[dict], None]) -> None:
        """Apply ``change`` to the newest manifest; if another job was faster, to that job's."""
        for _ in range(20):
            newest, manifest = self._newest(), self._state()
            change(manifest)
            try:
                self._log.write_new(f"{newest + 1:010d}.json", json.dumps(manifest))
            except FileExistsError:
                continue
            if newest > 0:
                self._log.delete(f"{newest - 1:010d}.json")
            return
        raise RuntimeError(f"{self.path} is committed to all the time")

    def ensure(self) -> StoredTable:
        """Create the table, empty, unless it exists."""
        if self._newest() < 0:
            self._commit(lambda manifest: None)
        return self

    # -- reading ----------------------------------------------------------

    def rows(self) -> DataFrame:
        """All parts unmerged: enough for any further sum, without an exchange."""
        manifest = self._manifest()
        days = [f"part={part}/event_date={day}" for day, part in manifest["days"].items()]
        return self._stored([*days, *(f"part={p}" for p in manifest["parts"])])

    def _stored(self, folders: list[str]) -> DataFrame:
        fields = [*self.spec.schema.fields]
        if self.by_day:
            fields.append(T.StructField("event_date", T.DateType()))
        if not folders:
            return self.spark.createDataFrame([], T.StructType(fields))
        found = (
            self.spark.read.schema(T.StructType([*fields, T.StructField("part", T.StringType())]))
            .option("basePath", self.path)
            .parquet(*(f"{self.path}/{folder}" for folder in folders))
        )
        return found.select(*(f.name for f in fields))

    def read(self) -> DataFrame:
        """One row per key."""
        return sum_measures(self.rows(), self._disk_keys(), self.spec.measures).select(
            *self.spec.schema.names
        )

    def _disk_keys(self) -> list[str]:
        extra = ["event_date"] if "event_date" in self.spec.partitions else []
        return [*self.spec.key_names, *extra]

    # -- writing ----------------------------------------------------------

    def _write(self, frame: DataFrame, part: str) -> None:
        if "event_date" in self.spec.partitions and "event_date" not in frame.columns:
            frame = frame.withColumn("event_date", day_of(F.col("hour_timestamp")))
        frame = frame.select(
            *(F.col(f.name).cast(f.dataType) for f in self.spec.schema.fields),
            *(p for p in self.spec.partitions if p not in self.spec.schema.names),
        )
        if self.spec.partitions:
            # Few files per partition value, large values split over tasks.
            frame = frame.hint("rebalance", *self.spec.partitions)
        # Sorted by key, so that a lookup skips row groups.
        inner = [k for k in self.spec.key_names if k not in self.spec.partitions]
        frame = frame.sortWithinPartitions(*self.spec.partitions, *inner)
        writer = frame.write.mode("overwrite")
        if self.spec.partitions:
            writer = writer.partitionBy(*self.spec.partitions)
        writer.parquet(f"{self.path}/part={part}")

    def add(self, increment: DataFrame, writer: str, batch_id: int) -> bool:
        """Add an increment's counters once; False if it is already in.

        ``writer`` is ``name`` or ``name.run``. Batch ids of another run of the
        same writer mean other rows, so a second run is refused.
        """
        manifest = self._manifest()
        name = writer.split(".")[0]
        if any(w != writer and w.split(".")[0] == name for w in manifest["batches"]):
            raise RuntimeError(
                f"{self.path} was fed by another run of {name}: its checkpoint is gone. "
                "clear() the table and rebuild it from the log."
            )
        if batch_id <= manifest["batches"].get(writer, -1):
            return False
        part = f"{writer}-{batch_id:010d}"
        self._write(increment, part)

        def added(manifest: dict) -> None:
            manifest.setdefault("parts", []).append(part)
            manifest.setdefault("batches", {})[writer] = batch_id

        self._commit(added)
        return True

    def fold(self, keep: int = 0) -> None:
        """Merge the parts after the first ``keep`` into one.

        Keeping earlier folds spares rewriting the bulk of a large table.
        """
        manifest = self._manifest()
        kept, merged = manifest["parts"][:keep], manifest["parts"][keep:]
        if len(merged) < 2:
            return
        part = self._merged([f"part={p}" for p in merged], "fold")

        def replaced(manifest: dict) -> None:
            later = [p for p in manifest["parts"] if p not in {*kept, *merged}]
            manifest["parts"] = [*kept, part, *later]

        self._commit(replaced)

    def _merged(self, folders: list[str], kind: str) -> str:
        """A new part with the sums of what is stored in some folders."""
        folded = sum_measures(self._stored(folders), self._disk_keys(), self.spec.measures)
        part = f"{kind}-{uuid.uuid4().hex}"
        self._write(folded.select(*self.spec.schema.names), part)
        return part

    def compact_days(self, increments: int = 0) -> None:
        """Once there are more increments, move them into the days they touch; other days keep their files.

        A day is one folder, the manifest says of which part. Only touched days are read and written again.
        """
        manifest = self._manifest()
        merged = manifest["parts"]
        if len(merged) <= increments:
            return
        folder = Folder(self.spark, self.path)
        touched = {n.partition("=")[2] for p in merged for n in folder.matching(f"part={p}/event_date=*")}
        before = {day: part for day, part in manifest["days"].items() if day in touched}
        kept = [f"part={part}/event_date={day}" for day, part in before.items()]
        part = self._merged([*kept, *(f"part={p}" for p in merged)], "days")

        def replaced(manifest: dict) -> None:
            if {d: p for d, p in manifest.get("days", {}).items() if d in touched} != before:
                raise RuntimeError(f"{self.path} is compacted by another job")
            manifest["parts"] = [p for p in manifest["parts"] if p not in merged]
            manifest.setdefault("days", {}).update(dict.fromkeys(touched, part))

        self._commit(replaced)

    def tidy(self, increments: int = 48, folds: int = 16) -> None:
        """Fold new increments once there are many, and the folds once they are.

        A row is so rewritten about once per tier, not once per increment. Tables by day have
        ``compact_days`` too, which leaves closed days alone.
        """
        parts = self._manifest()["parts"]
        folded = sum(p.startswith("fold-") for p in parts)
        if folded > folds:
            self.fold()
        elif len(parts) - folded > increments:
            self.fold(keep=folded)

    def clear(self) -> None:
        """Empty the table and forget its writers, before a rebuild."""
        self._commit(lambda manifest: manifest.update(parts=[], batches={}, days={}))

    def vacuum(self) -> None:
        """Delete parts no manifest entry names. Run it while nobody reads."""
        manifest = self._manifest()
        live = {f"part={p}" for p in manifest["parts"]}
        days = {(f"part={part}", f"event_date={day}") for day, part in manifest["days"].items()}
        folder = Folder(self.spark, self.path)
        for name in folder.names():
            if not name.startswith("part=") or name in live:
                continue
            if not any(part == name for part, _ in days):
                folder.delete(name)
                continue
            for day in folder.matching(f"{name}/event_date=*"):
                if (name, day) not in days:
                    folder.delete(f"{name}/{day}")


class PublishedTable(StoredTable):
    """A serving table. One file names the live parts of all serving tables and the second they stand for.

    ``state`` pins a reader to one publication: tables read with it never mix two of them.
    """

    def __init__(self, spark: SparkSession, root: str, spec: TableSpec, state: dict | None = None):
        super().__init__(spark, root, spec)
        self._log = Folder(spark, f"{root.rstrip('/')}/_published")
        self._pinned = state

    def _manifest(self) -> dict:
        state = self._state() if self._pinned is None else self._pinned
        part = state.get("tables", {}).get(self.spec.name)
        return {"parts": [part] if part else [], "batches": {}, "days": {}}

    def _named(self, parts: dict[str, str], more: dict) -> None:
        def named(state: dict) -> None:
            state.setdefault("tables", {}).update(parts)
            state.update(more)

        self._commit(named)

    def prepare(self, snapshot: DataFrame) -> str:
        """Write a snapshot that nobody reads yet."""
        part = f"snapshot-{uuid.uuid4().hex}"
        self._write(snapshot, part)
        return part

    def publish(self, snapshot: DataFrame) -> None:
        """Replace the content by ``snapshot``; keys it lacks are gone."""
        self._named({self.spec.name: self.prepare(snapshot)}, {})

    def clear(self) -> None:
        self._commit(lambda state: state.get("tables", {}).pop(self.spec.name, None))


class Lake:
    """The tables of one deployment.

    The log has one folder per action and origin: streamed messages below
    ``batch=/kind=/event_date=``, bulk loads below ``load=/event_date=``. A batch or
    load is written hidden and renamed once it is whole, so it is seen whole and once.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def log_path(self, action: str, origin: str) -> str:
        return f"{self.root}/bronze/{origin}/{action}"

    def _files(self, reader: DataFrameReader | DataStreamReader, action: str, origin: str) -> DataFrame:
        above = [T.StructField(name, T.StringType()) for name in _ABOVE[origin]]
        more = [T.StructField("video", VIDEO_VERSION)] if origin == "stream" else []
        rows = reader.schema(T.StructType([*_ON_DISK.fields, *more, *above])).parquet(
            self.log_path(action, origin)
        )
        rows = rows.where("kind = 'good'") if origin == "stream" else rows
        return rows.withColumn("action", F.lit(action)).drop(*_ABOVE[origin])

    def _log(self, reader: DataFrameReader | DataStreamReader) -> DataFrame:
        """All log folders as one; a filter on action drops whole folders."""
        return union_actions([self._files(reader, a, o) for a in TOPICS for o in ORIGINS])

    def bronze(self) -> DataFrame:
        return self._log(self.spark.read).select(*BRONZE.names)

    def bronze_stream(self, max_files: int = 1000) -> DataFrame:
        """The log as a stream, with ``video``; ``max_files`` per folder bound one micro-batch."""
        log = self._log(self.spark.readStream.option("maxFilesPerTrigger", max_files))
        return log.select(*BRONZE.names, "video")

    def rejects(self) -> DataFrame:
        fields = [f for f in REJECTS.fields if f.name != "topic"]
        above = [T.StructField(name, T.StringType()) for name in _ABOVE["stream"]]
        reader = self.spark.read.schema(T.StructType([*fields, *above]))
        return union_actions(
            [
                reader.parquet(self.log_path(topic, "stream"))
                .where("kind = 'bad'")
                .select(F.lit(topic).alias("topic"), *(f.name for f in fields))
                for topic in TOPICS
            ]
        )

    def counts_path(self) -> str:
        return f"{self.root}/bronze/counts"

    def ingest_counts(self) -> DataFrame:
        """Messages and rejects of every ingested batch."""
        schema = "topic string, batch string, messages long, rejects long"
        return self.spark.read.schema(schema).json(self.counts_path())

    def days(self) -> list[str]:
        """Days that have log files, newest first; only folder names are read."""
        log = Folder(self.spark, f"{self.root}/bronze")
        names = {
            *log.matching("stream/*/batch=*/kind=good/event_date=*"),
            *log.matching("bulk/*/load=*/event_date=*"),
        }
        return sorted((name.partition("=")[2] for name in names), reverse=True)

    def latest(self, n: int) -> DataFrame:
        """The ``n`` newest log rows, newest first; ties by the other columns.

        Days are counted from the newest on until they hold ``n`` rows; only those are read.
        """
        log = self.bronze()
        rows = log.where("false")
        for count, day in enumerate(self.days(), 1):
            rows = log.where(F.col("event_date") >= F.lit(day).cast("date"))
            # Twice as many days at a time, so that a thin log is not counted day by day.
            if count & (count - 1) == 0 and rows.limit(n).count() >= n:
                break
        order = ["timestamp_seconds", *(c for c in BRONZE.names if c not in ("timestamp_seconds", "ingest_time"))]
        return rows.orderBy(*(F.desc(c) for c in order)).limit(n)

    def videos(self) -> VideoDimension:
        return VideoDimension(self.spark, f"{self.root}/silver/videos")

    def silver(self, name: str) -> StoredTable:
        return StoredTable(self.spark, f"{self.root}/silver", SILVER[name])

    def gold(self, name: str, state: dict | None = None) -> PublishedTable:
        return PublishedTable(self.spark, f"{self.root}/gold", GOLD[name], state)

    def published(self) -> dict:
        """The present publication: ``as_of`` and the live part of every serving table."""
        return self.gold(next(iter(GOLD)))._state()

    def publish(self, snapshots: dict[str, DataFrame], as_of: int) -> None:
        """Replace serving tables together: all are written first, then one file names them all."""
        parts = {name: self.gold(name).prepare(snapshot) for name, snapshot in snapshots.items()}
        self.gold(next(iter(parts)))._named(parts, {"as_of": as_of})

    def register_views(self) -> None:
        """Temporary views ``bronze``, ``silver_*`` and ``gold_*`` of the present content."""
        self.bronze().createOrReplaceTempView("bronze")
        for name in SILVER:
            self.silver(name).read().createOrReplaceTempView(f"silver_{name}")
        for name in GOLD:
            self.gold(name).rows().createOrReplaceTempView(f"gold_{name}")

    def ensure(self) -> Lake:
        """Create what is missing, empty."""
        for topic in TOPICS:
            for origin in ORIGINS:
                Folder(self.spark, self.log_path(topic, origin)).create()
        Folder(self.spark, self.counts_path()).create()
        self.videos().ensure()
        for name in SILVER:
            self.silver(name).ensure()
        for name in GOLD:
            self.gold(name).ensure()
        return self

    def bulk_append(
        self, actions: DataFrame, action: str, layout: str = "video", load: str | None = None
    ) -> bool:
        """Append bronze rows of one action in batch; False if the load of that name is already in.

        Rows are rebalanced by day: adaptive execution gives a hot day several
        tasks and packs small days together. Without a name every call is a load of its own.
        """
        folder = Folder(self.spark, self.log_path(action, "bulk"))
        name = f"load={load or uuid.uuid4().hex}"
        if folder.has_folder(name):
            return False
        hidden = f"_writing-{uuid.uuid4().hex}"
        (
            actions.where(F.col("action") == action)
            .select(*_ON_DISK.names)
            .hint("rebalance", "event_date")
            .sortWithinPartitions("event_date", *LAYOUTS[layout])
            .write.options(**LOOKUPS)
            .partitionBy("event_date")
            .parquet(f"{folder.path}/{hidden}")
        )
        folder.rename(hidden, name)
        return True
