"""Streaming forms: stateless curation, dedup across batches, and packing with carry-over. State lives in the checkpoint
(RocksDB), so a restarted query goes on where it stopped."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from millrace.functions import text as tx
from millrace.operators import curate

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def configure(spark: SparkSession) -> None:
    """State beyond the heap."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def read_documents(spark: SparkSession, path: str, schema: str = "doc_id long, text string", files: int = 1000) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)


def clean(stream: DataFrame) -> DataFrame:
    """Normalising, boilerplate and routing need no state: the same functions as for tables."""
    return curate.route(curate.strip_boilerplate(curate.normalise(stream)))


def exact_dedup(stream: DataFrame) -> DataFrame:
    """The first arrival of each content signature, across batches."""
    return stream.withColumn("document_hash_signature", tx.content_signature(tx.text("text"))).dropDuplicates(["document_hash_signature"])


def pack(stream: DataFrame, length: int, lanes: int = 8) -> DataFrame:
    """(lane, seq, input_ids): windows of ``length`` tokens, the rest carried over to the next batch. Documents are dealt over
    ``lanes`` independent packers, within which they come in order of doc_id batch by batch."""

    def step(key, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        seq, carry = state.get if state.exists else (0, [])
        carry, out = list(carry), []
        for row in pd.concat(frames).sort_values("doc_id")["input_ids"]:
            carry.extend(int(x) for x in row)
            whole = len(carry) // length * length
            out += [carry[i : i + length] for i in range(0, whole, length)]
            carry = carry[whole:]
        state.update((seq + len(out), carry))
        yield pd.DataFrame({"lane": [key[0]] * len(out), "seq": range(seq, seq + len(out)), "input_ids": out})

    laned = stream.select(F.pmod(F.xxhash64("doc_id"), F.lit(lanes)).cast("int").alias("lane"), "doc_id", "input_ids")
    return laned.groupBy("lane").applyInPandasWithState(step, "lane int, seq long, input_ids array<int>", "seq long, carry array<int>", "append", GroupStateTimeout.NoTimeout)


def drain(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Writes what has arrived to Parquet and stops."""
    query = df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def incremental_files(spark: SparkSession, source: str, schema: str, path: str, checkpoint: str) -> StreamingQuery:
    """Files landed since the last run, appended by date."""
    return drain(spark.readStream.schema(schema).parquet(source), path, checkpoint)
