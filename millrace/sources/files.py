"""Small files of any file system that Spark reaches, through Hadoop's own client: listings, state and checksums."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Entry:
    path: str
    size: int
    modified: dt.datetime


class FileStore:
    """A folder. Paths are relative to it."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._jvm = spark.sparkContext._jvm

    def _at(self, path: str = ""):
        full = self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{path}" if path else self.root)
        return full.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), full

    def list(self) -> list[Entry]:
        """Every file at any depth, hidden and empty ones too."""
        fs, top = self._at()
        if not fs.exists(top):
            return []
        base, found, each = fs.makeQualified(top).toString().rstrip("/"), [], fs.listFiles(top, True)
        while each.hasNext():
            s = each.next()
            when = dt.datetime.fromtimestamp(s.getModificationTime() / 1000, dt.timezone.utc).replace(tzinfo=None)
            found.append(Entry(s.getPath().toString()[len(base) + 1 :], s.getLen(), when))
        return sorted(found, key=lambda e: e.path)

    def read(self, path: str) -> bytes | None:
        fs, full = self._at(path)
        if not fs.exists(full):
            return None
        stream = fs.open(full)
        try:
            return bytes(stream.readAllBytes())
        finally:
            stream.close()

    def write(self, path: str, data: bytes) -> None:
        fs, full = self._at(path)
        stream = fs.create(full, True)
        try:
            stream.write(bytearray(data))
        finally:
            stream.close()

    def delete(self) -> None:
        """The folder and all in it, if it is there."""
        fs, top = self._at()
        fs.delete(top, True)


def checksums(spark: SparkSession, path: str) -> DataFrame:
    """(path, sha256) of files, computed where they are read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return found.select("path", F.sha2("content", 256).alias("sha256"))


def write_json(df: DataFrame, path: str) -> None:
    """A result as JSON lines."""
    df.coalesce(1).write.mode("overwrite").json(path)
