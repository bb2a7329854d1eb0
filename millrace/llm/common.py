"""What the operators share: the shared folder, written tables that cut lineage, size-checked broadcasts.

Intermediate tables go to ``<shared folder>/millrace/<application>``. Those of a finished stage are deleted by ``scratch``;
``clear`` deletes all of an application's, once its results have been read.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words as the contracts define them: runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = r"[\x20\x09-\x0D]+"
#: Rows, and bytes of their files, up to which the small side of a join may be broadcast; beyond either the join shuffles.
BROADCAST_ROWS, BROADCAST_BYTES = 100_000, 16 << 20

_scratch: list[list[str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor and the driver see: spark.checkpoint.dir. Where it is unset, as in tests, a session whose
    tasks all run in this process gets a temporary one; any other is an error."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError(f"spark.checkpoint.dir is unset and {master} has executors elsewhere: name a folder that all of them share")
        found = f"file://{tempfile.mkdtemp(prefix='millrace-')}"
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def _own_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/millrace/{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, name: str) -> str:
    path = f"{_own_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if _scratch:
        _scratch[-1].append(path)
    return path


def delete(spark: SparkSession, path: str) -> None:
    """Deletes a folder of any file system that Spark reaches, if it is there."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Intermediate tables named within are deleted at the end; what is to stay must be written outside."""
    _scratch.append([])
    try:
        yield
    finally:
        for path in _scratch.pop():
            delete(spark, path)


def clear(spark: SparkSession) -> None:
    """Deletes all intermediate tables of this application; DataFrames that still read them fail from then on."""
    delete(spark, _own_dir(spark))


def save(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def written(df: DataFrame, name: str, *, as_dealt: bool = False) -> DataFrame:
    """``df`` as a table in the shared folder: cuts lineage, is computed once, survives lost executors.

    It is written in at most four files a core, so that many almost empty partitions don't become as many files; ``as_dealt``
    keeps the partitions of a scan of texts, whose tasks are long as they are.
    """
    spark = df.sparkSession
    return save(df if as_dealt else df.coalesce(max(24, 4 * spark.sparkContext.defaultParallelism)), new_path(spark, name))


def file_bytes(df: DataFrame) -> int:
    """The bytes of the files that ``df`` reads, of all its columns, by the file systems' own listings."""
    spark, total = df.sparkSession, 0
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
        at = jvm.org.apache.hadoop.fs.Path(folder)
        total += at.getFileSystem(conf).getContentSummary(at).getLength()
    return total


def small(df: DataFrame, rows: int) -> DataFrame:
    """``df``, a written table or a projection of some, with a broadcast hint if its counted ``rows`` and the bytes of its
    files are within the bounds."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS and file_bytes(df) <= BROADCAST_BYTES else df


def bind(value: Column, fn) -> Column:
    """fn(value) with ``value`` computed once a row. A lambda that names a column's expression would compute it anew
    for each element; a lambda's own variable is a value."""
    return F.get(F.transform(F.array(value), fn), F.lit(0))


def own(column: str) -> Column:
    """A column by its very name, dots and all."""
    return F.col("`" + column.replace("`", "``") + "`")


def packed(docs: DataFrame, *keys: str) -> DataFrame:
    """``docs`` as one struct ``row`` of all its columns, beside copies of ``keys`` under their own names: whatever the
    columns are called, they can't clash with an operator's."""
    return docs.select(F.struct(*[own(c) for c in docs.columns]).alias("row"), *[own(c).alias(c) for c in keys])


def unpacked(columns: list[str]) -> list[Column]:
    """The columns of a packed row."""
    return [F.col("row").getField(c).alias(c) for c in columns]


def ascii_lower(c: Column) -> Column:
    """Lower-cases A-Z only, whatever the locale or script."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))
