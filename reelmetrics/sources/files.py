"""Small files on the table file system (HDFS, object store or local)."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


class Folder:
    """A folder reached through Spark's own Hadoop configuration."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm = spark._jvm
        self.path = path.rstrip("/")
        self._fs = self._hadoop(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _hadoop(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def names(self) -> list[str]:
        root = self._hadoop(self.path)
        if not self._fs.exists(root):
            return []
        return [status.getPath().getName() for status in self._fs.listStatus(root)]

    def create(self) -> None:
        self._fs.mkdirs(self._hadoop(self.path))

    def has_folder(self, name: str) -> bool:
        child = self._hadoop(f"{self.path}/{name}")
        return self._fs.exists(child) and self._fs.getFileStatus(child).isDirectory()

    def matching(self, pattern: str) -> list[str]:
        """Names of the last part of all paths below the folder that fit a glob pattern."""
        found = self._fs.globStatus(self._hadoop(f"{self.path}/{pattern}"))
        return [status.getPath().getName() for status in found or []]

    def rename(self, name: str, to: str) -> None:
        """One step on HDFS and local disks; an object store needs a committer that makes renames atomic."""
        target = self._hadoop(f"{self.path}/{to}")
        if self._fs.exists(target) or not self._fs.rename(self._hadoop(f"{self.path}/{name}"), target):
            raise FileExistsError(f"{self.path}/{to}")

    def read(self, name: str) -> str:
        stream = self._fs.open(self._hadoop(f"{self.path}/{name}"))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write_new(self, name: str, text: str) -> None:
        """Create ``name`` in one step: readers see all of it or nothing."""
        hidden = self._hadoop(f"{self.path}/.{name}-{uuid.uuid4().hex}")
        stream = self._fs.create(hidden, False)
        stream.write(bytearray(text, "utf-8"))
        stream.close()
        target = self._hadoop(f"{self.path}/{name}")
        if self._fs.exists(target) or not self._fs.rename(hidden, target):
            self._fs.delete(hidden, False)
            raise FileExistsError(f"{self.path}/{name}")

    def delete(self, name: str) -> None:
        self._fs.delete(self._hadoop(f"{self.path}/{name}"), True)
