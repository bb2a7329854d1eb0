"""Token counts as rollups that deltas maintain.

Totals of documents and tokens by source, language and tokenizer version are sums of signed rows, so they are updated
by adding a batch's rows: an insert adds a document's count, a delete takes away whatever its id has, in every version, a
revision does both. A batch is committed by an entry in a numbered log, made by a creation that never overwrites; the entry
names the batch and the files it wrote. So a batch that is sent again counts once, files of a broken attempt are never read,
and of two batches that were computed on the same state one is committed and the other computed anew.

A ledger keeps the signed rows per document, from which the counts that a deletion takes away are known without its
text; revisions that change neither text, source, language nor tokenizer are left out before anything is tokenised. Every
``COMPACT`` entries the net ledger and rollup are written anew, and older files are read no more.

Defined cases: null and empty texts have 0 tokens; a null doc_id, source or language is a value like any other; repeated
rows of a batch count as often as they are given, under one key; texts are tokenised whole; special tokens' strings are
ordinary text; an empty batch is committed and changes nothing; other columns play no part. An entry that its writer never
filled stops further batches with an error that names it.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import small, written

KEYS = ["source", "lang", "tokenizer"]
LEDGER = "key string, version long, source string, lang string, tokenizer string, docs long, tokens long"
ROLLUP = "source string, lang string, tokenizer string, docs long, tokens long"


class Tokenizer:
    """A byte-pair vocabulary in tiktoken's format, read on the driver and sent to the executors once."""

    def __init__(self, spark: SparkSession, path: str, pattern: str):
        with open(path, "rb") as f:
            data = f.read()
        self.version = f"{path.rpartition('/')[2].removesuffix('.tiktoken')}-{hashlib.sha256(data + pattern.encode()).hexdigest()[:12]}"
        self.shared = spark.sparkContext.broadcast((data, pattern))  # a vocabulary's file: a few MB at most

    def count(self, rows: DataFrame) -> DataFrame:
        """``rows`` with ``tokens``, the number of tokens of ``text``, in place of the text."""
        shared = self.shared
        others = [f for f in rows.schema.fields if f.name != "text"]
        schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in others), "tokens long"])

        def work(batches):
            import tiktoken

            data, pattern = shared.value
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines()) if a}
            encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
            for batch in batches:
                counts = [len(encoding.encode_ordinary(value.as_py() or "")) for value in batch.column("text")]
                yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in others), pa.array(counts, pa.int64())], names=[*(f.name for f in others), "tokens"])

        return rows.mapInArrow(work, schema)


def public_tokenizer(spark: SparkSession, name: str = "byte_bpe_50k.tiktoken") -> Tokenizer:
    """A tokenizer of the public vocabularies of this machine."""
    import public_tokenizers

    return Tokenizer(spark, public_tokenizers.path(name), public_tokenizers.PATTERN)


class Conflict(RuntimeError):
    """A log entry that another writer made first."""


class TokenRollup:
    """Rollups under ``root``, a folder that the driver and all executors share."""

    COMPACT, ATTEMPTS = 32, 8

    def __init__(self, spark: SparkSession, root: str, tokenizer: Tokenizer):
        self.spark, self.root, self.tokenizer = spark, root.rstrip("/"), tokenizer

    def _path(self, name: str):
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), path

    def log(self) -> list[dict]:
        """The entries since the last compaction, it included, oldest first: small files, read from the newest back."""
        fs, path = self._path("log")
        if not fs.exists(path):
            return []
        found = []
        for name in sorted((s.getPath().getName() for s in fs.listStatus(path)), reverse=True):
            stream = fs.open(self._path(f"log/{name}")[1])
            try:
                data = bytes(stream.readAllBytes())
            finally:
                stream.close()
            if not data:
                raise Conflict(f"{self.root}/log/{name} is empty: its writer is at work, or died; delete it in that case")
            found.append(json.loads(data))
            if found[-1]["compacted"]:
                break
        return found[::-1]

    def _enter(self, number: int, entry: dict) -> None:
        fs, path = self._path(f"log/{number:012d}")
        try:
            stream = fs.create(path, False)  # an error if it is there
        except Exception as error:
            if "FileAlreadyExists" in str(error):
                raise Conflict(f"entry {number} was made by another writer") from error
            raise
        stream.write(bytearray(json.dumps({"number": number, **entry}).encode()))
        stream.close()

    def batches(self) -> set[str]:
        """The batches that count."""
        return {b for entry in self.log() for b in entry["batches"]}

    def _read(self, part: str, schema: str, log: list[dict] | None = None) -> DataFrame:
        paths = [f"{self.root}/{part}/{entry['attempt']}" for entry in (self.log() if log is None else log)]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def ledger(self, log: list[dict] | None = None) -> DataFrame:
        """What every document counts now, by source, language and tokenizer."""
        held = self._read("ledger", LEDGER, log).groupBy("key", "version", *KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
        return held.where("docs <> 0 or tokens <> 0")

    def totals(self, log: list[dict] | None = None) -> DataFrame:
        """(source, lang, tokenizer, docs, tokens), from the batches' rollups alone."""
        sums = self._read("rollup", ROLLUP, log).groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
        return sums.where("docs <> 0 or tokens <> 0")

    def compact(self) -> None:
        """Writes the net ledger and rollup as one entry that stands for all before it."""
        log = self.log()
        if len(log) < 2:
            return
        attempt = f"compacted-{uuid.uuid4().hex}"
        self.ledger(log).write.parquet(f"{self.root}/ledger/{attempt}")
        self.totals(log).write.parquet(f"{self.root}/rollup/{attempt}")
        self._enter(log[-1]["number"] + 1, {"batches": sorted({b for e in log for b in e["batches"]}), "attempt": attempt, "compacted": True})

    def apply(self, batch_id: str, changes: DataFrame) -> bool:
        """Counts a batch: rows of (op, doc_id, source, lang, text), op insert, delete or revise. False if it was
        committed before, which changes nothing."""
        for turn in range(self.ATTEMPTS):
            log = self.log()
            if any(batch_id in entry["batches"] for entry in log):
                return False
            attempt = f"{base64.urlsafe_b64encode(batch_id.encode()).decode().rstrip('=')[:80]}-{uuid.uuid4().hex}"
            self._write(attempt, changes, log)
            try:
                self._enter(log[-1]["number"] + 1 if log else 0, {"batches": [batch_id], "attempt": attempt, "compacted": False})
            except Conflict:
                if turn == self.ATTEMPTS - 1:
                    raise
                continue
            if len(log) + 1 >= self.COMPACT:
                self.compact()
            return True
        return False

    def _write(self, attempt: str, changes: DataFrame, log: list[dict]) -> None:
        """The signed rows of a batch against the state of ``log``, and their sums."""
        key = F.coalesce(F.concat(F.lit("="), F.col("doc_id").cast("string")), F.lit("-"))
        rows = changes.select("op", key.alias("key"), F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"), F.coalesce(F.xxhash64("text"), F.lit(0)).alias("version"), "text")
        if log:
            held = self.ledger(log)
            # a key whose revisions are what it holds already is left out, whole: its texts aren't tokenised again
            revised = rows.where("op = 'revise'").withColumn("tokenizer", F.lit(self.tokenizer.version))
            own = ["key", "version", *KEYS]
            now = held.join(revised.select("key").distinct(), "key", "left_semi").select(*own, (-F.col("docs")).alias("d"))
            changed = revised.select(*own, F.lit(1).cast("long").alias("d")).unionByName(now).groupBy(*own).agg(F.sum("d").alias("d")).where("d <> 0").select("key").distinct()
            changed = written(changed, "token-changes")
            changed = small(changed, changed.count())  # few, as a rule: then texts aren't shuffled to find theirs
            rows = rows.where("op <> 'revise'").unionByName(revised.join(changed, "key", "left_semi").select(*rows.columns))
            gone = rows.where("op in ('delete', 'revise')").select("key").distinct()
            less = held.join(gone, "key", "left_semi").select("key", "version", *KEYS, (-F.col("docs")).alias("docs"), (-F.col("tokens")).alias("tokens"))
        else:
            less = self.spark.createDataFrame([], LEDGER)
        counted = self.tokenizer.count(rows.where("op in ('insert', 'revise')").drop("op"))
        more = counted.select("key", "version", "source", "lang", F.lit(self.tokenizer.version).alias("tokenizer"), F.lit(1).cast("long").alias("docs"), "tokens")
        more.unionByName(less).write.parquet(f"{self.root}/ledger/{attempt}")
        signed = self.spark.read.schema(LEDGER).parquet(f"{self.root}/ledger/{attempt}")
        signed.groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")).write.parquet(f"{self.root}/rollup/{attempt}")


def corpus_totals(docs: DataFrame, root: str, tokenizer: Tokenizer) -> DataFrame:
    """The totals of a corpus that reached its present state by deltas.

    Documents fall in 20 classes by a hash of their id. The load has those of one class as drafts, under another source and
    with a line more, and is sent twice; a batch deletes another class and revises the drafts to what the table holds; the next
    one inserts the deleted documents again and revises a third class without a change. Then the log is compacted.
    """
    spark = docs.sparkSession
    rollup = TokenRollup(spark, root, tokenizer)
    part = F.pmod(F.xxhash64(F.lit("delta"), F.col("doc_id").cast("string")), F.lit(20))
    rows = docs.select("doc_id", F.col("source").cast("string").alias("source"), "lang", "text").withColumn("part", part)
    op = lambda name: F.lit(name).alias("op")
    draft = rows.withColumns({"source": F.when(F.col("part") == 0, F.concat(F.lit("draft of "), F.coalesce("source", F.lit("?")))).otherwise(F.col("source")), "text": F.when(F.col("part") == 0, F.concat(F.coalesce("text", F.lit("")), F.lit("\nto be revised"))).otherwise(F.col("text"))})
    load = draft.select(op("insert"), "*")
    changes = rows.where("part = 1").select(op("delete"), "*").withColumn("text", F.lit(None).cast("string")).unionByName(rows.where("part = 0").select(op("revise"), "*"))
    again = rows.where("part = 1").select(op("insert"), "*").unionByName(rows.where("part = 2").select(op("revise"), "*"))
    for name, batch in (("load", load), ("load", load), ("changes", changes), ("again", again), ("changes", changes)):
        rollup.apply(name, batch)
    rollup.compact()
    return rollup.totals()
