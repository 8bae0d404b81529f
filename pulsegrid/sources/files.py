"""Folders of a table through Hadoop's file system API: any store that Spark reads works, also from a cluster's driver."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Folder:
    """A path and the file system it lies in. Only names pass through the driver, never data."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm = spark.sparkContext._jvm
        self.path = path.rstrip("/")
        self._path = self._jvm.org.apache.hadoop.fs.Path(self.path)
        self._fs = self._path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")

    def folders(self, name: str = "") -> list[str]:
        """Names of the folders in `name`, sorted; none if there is no such folder."""
        at = self._at(name) if name else self._path
        if not self._fs.exists(at):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(at) if s.isDirectory())

    def make(self) -> str:
        """The path, with a folder there."""
        self._fs.mkdirs(self._path)
        return self.path

    def has(self, name: str) -> bool:
        return self._fs.exists(self._at(name))

    def remove(self, name: str) -> bool:
        """Whether there was something to remove."""
        return self._fs.delete(self._at(name), True)
