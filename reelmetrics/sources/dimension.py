"""The stored video dimension: newest known attributes of every video.

A part holds the newest version of each video of one increment. Taking the newest is
idempotent: a part written twice, or read beside the merged one that replaces it, changes
nothing, so neither replays nor compaction need a manifest.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from reelmetrics.operators.dims import dimension_of, newest_versions
from reelmetrics.schemas import VIDEO_VERSION
from reelmetrics.sources.files import Folder

_SCHEMA = T.StructType([*VIDEO_VERSION.fields, T.StructField("seen", T.LongType())])
_MERGED = "_merged.json"


class VideoDimension:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path
        self._folder = Folder(spark, path)

    def ensure(self) -> None:
        self._folder.create()

    def _parts(self) -> list[str]:
        return sorted(name for name in self._folder.names() if name.startswith("part="))

    def versions(self) -> DataFrame:
        """All stored versions; a video may have one in each part."""
        return self.spark.read.schema(_SCHEMA).parquet(self.path)

    def read(self) -> DataFrame:
        """One row per video: id, channel, creation, category and minutes of its newest version."""
        return dimension_of(newest_versions(self.versions()))

    def add(self, versions: DataFrame, part: str) -> None:
        """Store the newest of ``versions`` per video; a replay overwrites its own part."""
        newest_versions(versions).select(*_SCHEMA.names).write.mode("overwrite").parquet(
            f"{self.path}/part={part}"
        )

    def compact(self) -> None:
        """Merge all parts into one. They go with the next call, when nobody reads them any more."""
        gone = set(json.loads(self._folder.read(_MERGED))) if _MERGED in self._folder.names() else set()
        merged = [name for name in self._parts() if name not in gone]
        if len(merged) > 1:
            paths = [f"{self.path}/{name}" for name in merged]
            found = newest_versions(self.spark.read.schema(_SCHEMA).parquet(*paths))
            found.select(*_SCHEMA.names).write.parquet(f"{self.path}/part=merged-{uuid.uuid4().hex}")
        for name in gone:
            self._folder.delete(name)
        self._folder.delete(_MERGED)
        self._folder.write_new(_MERGED, json.dumps(merged if len(merged) > 1 else []))
