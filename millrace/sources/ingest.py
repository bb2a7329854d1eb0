"""Incremental ingestion: relational sources by range-partitioned reads, landed files, boundary-delimited text, watermarks
as timestamps, date-partitioned Parquet sinks and the guard against empty initial loads."""

from __future__ import annotations

import datetime as dt
import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .files import FileStore

#: Divisions that are never ingested, and spellings of a missing watermark.
EXCLUDED_DIVISIONS = ["Human Resources", "Facility Operations"]
NO_WATERMARK = (None, "", "None", "null")
BOUNDARY = "DOCUMENT BOUNDARY"


class IngestError(RuntimeError):
    """An ingestion that must not be taken for a success."""


def watermark(value: str | dt.datetime | None) -> dt.datetime | None:
    """A stored watermark as a UTC time; None for a full load."""
    if value in NO_WATERMARK:
        return None
    when = value if isinstance(value, dt.datetime) else dt.datetime.fromisoformat(str(value))
    return when.astimezone(dt.timezone.utc).replace(tzinfo=None) if when.tzinfo else when


def newer(column: Column, since: dt.datetime | None) -> Column:
    """Strictly after the watermark; everything without one."""
    return F.lit(True) if since is None else column > F.lit(since)


def division_filter(df: DataFrame, column: str = "corporate_division", excluded: list[str] | None = None) -> DataFrame:
    """Excluded divisions go, and so do rows without one."""
    return df.where(~F.col(column).isin(excluded or EXCLUDED_DIVISIONS))


def write_mode(since: dt.datetime | None) -> str:
    return "overwrite" if since is None else "append"


def partitions_for(low: int, high: int, per: int = 500, most: int = 8) -> int:
    """How many range partitions to read ids low..high in."""
    return max(1, min(most, (high - low) // per))


def bounds(df: DataFrame, id_col: str = "id") -> tuple[int, int] | None:
    """Least and greatest id; None without rows."""
    low, high = df.agg(F.min(id_col), F.max(id_col)).first()
    return None if low is None else (low, high)


def read_jdbc(spark: SparkSession, url: str, table: str, *, since: dt.datetime | None = None, id_col: str = "id", ts_col: str = "created_at", division_col: str = "corporate_division", properties: dict[str, str] | None = None) -> DataFrame | None:
    """The new rows of a table, read in ranges of ids; None if there are none. Filters reach the database."""
    properties = properties or {}
    new = lambda df: division_filter(df, division_col).where(newer(F.col(ts_col), since))
    found = bounds(new(spark.read.jdbc(url, table, properties=properties)).select(id_col), id_col)
    if found is None:
        return None
    low, high = found
    return new(spark.read.jdbc(url, table, column=id_col, lowerBound=low, upperBound=high + 1, numPartitions=partitions_for(low, high), properties=properties))


def with_date_parts(df: DataFrame, ts_col: str = "created_at") -> DataFrame:
    """year, month and day as strings, the sink's partition columns."""
    return df.withColumns({"year": F.date_format(ts_col, "yyyy"), "month": F.date_format(ts_col, "MM"), "day": F.date_format(ts_col, "dd")})


def max_watermark(df: DataFrame, ts_col: str = "created_at") -> dt.datetime | None:
    return df.agg(F.max(ts_col)).first()[0]


def guard(rows: int, since: dt.datetime | None) -> bool:
    """Whether the watermark may advance. No rows are an error for an initial load and nothing new for another."""
    if rows:
        return True
    if since is None:
        raise IngestError("the initial load found nothing")
    return False


@dataclass
class WatermarkStore:
    """The watermark of each stream, in a folder of any file system that Spark reaches."""

    files: FileStore

    def get(self, stream: str) -> dt.datetime | None:
        found = self.files.read(f"{stream}.json")
        return watermark(json.loads(found)["watermark"]) if found else None

    def put(self, stream: str, value: dt.datetime) -> None:
        self.files.write(f"{stream}.json", json.dumps({"stream": stream, "watermark": value.isoformat()}).encode())


#: Rows of a date that one task writes.
ROWS_A_TASK = 1_000_000


def ingest(source: DataFrame, path: str, store: WatermarkStore, stream: str, *, ts_col: str = "created_at", division_col: str | None = "corporate_division") -> int:
    """New rows of ``source`` added under ``path``, by date; the watermark advances to the newest of them.

    The watermark is read back from what was written, so the source is read once. A load's rows go to a folder named after the
    watermark that it starts from; if the load dies before the watermark advances, the next one starts from the same and
    replaces them, so no row counts twice.
    """
    since = store.get(stream)
    new = source.where(newer(F.col(ts_col), since))
    new = division_filter(new, division_col) if division_col else new
    name = "initial" if since is None else f"{since:%Y%m%dT%H%M%S%f}"
    batch = f"{path}/_landing/{name}"
    new.write.mode("overwrite").parquet(batch)
    landed = source.sparkSession.read.schema(source.schema).parquet(batch)
    rows, top = landed.agg(F.count("*"), F.max(ts_col)).first()
    if guard(rows, since):
        if write_mode(since) == "overwrite":
            FileStore(source.sparkSession, f"{path}/data").delete()
        # a busy day is written by several tasks
        spread = F.pmod(F.xxhash64(*landed.columns), F.lit(max(1, -(-rows // ROWS_A_TASK))))
        dated = with_date_parts(landed, ts_col).repartition("year", "month", "day", spread)
        dated.write.mode("overwrite").partitionBy("year", "month", "day").parquet(f"{path}/data/load={name}")
        store.put(stream, top)
    return rows


def landed_files(spark: SparkSession, path: str, since: dt.datetime | None = None) -> DataFrame:
    """(path, modificationTime, length, content) of files changed after the watermark, at any depth."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return found.where(newer(F.col("modificationTime"), since))


def land(spark: SparkSession, source: str, target: FileStore, since: dt.datetime | None = None, *, at_once: int = 256) -> int:
    """Copies changed files byte by byte, keeping their relative paths; returns how many, under the guard. The listing is the
    driver's; the files are copied in pieces where tasks run, ``at_once`` tasks at most, and a repeated task writes the same."""
    new = [f.path for f in FileStore(spark, source).list() if since is None or f.modified > since]
    if new:
        goal, tasks = target.root, min(at_once, len(new))

        def copy(batches):
            import pyarrow as pa
            from pyarrow import fs

            (one, top), (two, under) = (fs.FileSystem.from_uri(x) for x in (source.rstrip("/"), goal))
            for batch in batches:
                sizes = []
                for path in batch.column("path").to_pylist():
                    two.create_dir(f"{under}/{path}".rpartition("/")[0], recursive=True)
                    size = 0
                    with one.open_input_stream(f"{top}/{path}", compression=None) as taken, two.open_output_stream(f"{under}/{path}", compression=None) as given:
                        while piece := taken.read(1 << 20):
                            size += given.write(piece)
                    sizes.append(size)
                yield pa.RecordBatch.from_arrays([batch.column("path"), pa.array(sizes, pa.int64())], names=["path", "size"])

        listed = spark.createDataFrame([(x,) for x in new], "path string").repartition(tasks, "path")
        copied = listed.mapInArrow(copy, "path string, size long").agg(F.count("*")).first()[0]
        if copied != len(new):
            raise IngestError(f"{copied} of {len(new)} files were copied")
    guard(len(new), since)
    return len(new)


def has_file_delta(spark: SparkSession, path: str, since: dt.datetime | None = None, *, deep: bool = False) -> bool:
    """Whether a file with an ending changed after the watermark, in the folder itself or at any depth."""
    return any("." in f.path.rpartition("/")[2] and (deep or "/" not in f.path) and (since is None or f.modified > since) for f in FileStore(spark, path).list())


def has_delta(df: DataFrame, since: dt.datetime | None, ts_col: str) -> bool:
    """Whether anything is newer; reads no more than it takes to find a row."""
    return not df.where(newer(F.col(ts_col), since)).limit(1).isEmpty()


def boundary_documents(spark: SparkSession, path: str, marker: str = BOUNDARY) -> DataFrame:
    """(path, seq, text): documents of landed text files, apart by a marker line among blank lines; no empty tail."""
    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")
    parts = F.split("value", rf"\n*[^\n]*{marker}[^\n]*\n*", -1)
    docs = files.select("path", F.posexplode(F.filter(F.transform(parts, F.btrim), lambda x: x != "")).alias("seq", "text"))
    return docs


def s3_options(endpoint: str, key: str, secret: str) -> dict[str, str]:
    """Settings of an object store, for the session's builder."""
    return {
        "spark.hadoop.fs.s3a.endpoint": endpoint, "spark.hadoop.fs.s3a.access.key": key, "spark.hadoop.fs.s3a.secret.key": secret,
        "spark.hadoop.fs.s3a.path.style.access": "true", "spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
    }
