"""Intermediate tables: written to a folder that all executors share, which cuts lineage and survives lost executors."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows, and bytes of files read, up to which the small side of a join may be broadcast; beyond either the join shuffles.
BROADCAST_ROWS, BROADCAST_BYTES = 100_000, 16 << 20


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir. Where it is unset, as in tests, a session whose tasks all run in this process gets a temporary
    folder; any other is an error."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError(f"spark.checkpoint.dir is unset and {master} has executors elsewhere: name a folder that all of them share")
        found = f"file://{tempfile.mkdtemp(prefix='millrace-')}"
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df``, computed once."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/millrace/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def file_bytes(df: DataFrame) -> int:
    """The bytes of the files that ``df`` reads."""
    spark, total = df.sparkSession, 0
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
        at = jvm.org.apache.hadoop.fs.Path(folder)
        total += at.getFileSystem(conf).getContentSummary(at).getLength()
    return total


def is_small(df: DataFrame) -> bool:
    """Whether a written table's rows and bytes are within the bounds."""
    return file_bytes(df) <= BROADCAST_BYTES and df.count() <= BROADCAST_ROWS


def small(df: DataFrame) -> DataFrame:
    """A written table with a broadcast hint if its rows and bytes are within the bounds."""
    return F.broadcast(df) if is_small(df) else df
