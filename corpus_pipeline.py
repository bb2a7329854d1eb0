"""The corpus pipeline: five stages from raw documents to a training mix, each on all that its predecessor kept.

Every function takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each stage's result to the shared
folder, deletes what the stage wrote on its way, and reads the result again as the next one's documents.

Null and empty texts end at the first stage, which rejects what has no letter. Rows that repeat an earlier one wholly stay
together until near-dedup, which keeps or drops all rows of one doc_id and text alike; ties are broken by doc_id, null last.
Columns of any name are carried through every stage; only the last one adds ``epoch``, in place of one that is there.
An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import decontaminate, langid, linededup, mixing, neardup
from millrace.llm.common import new_path, save, scratch


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told from their text."""
    return langid.keep_identified(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of three lines and more that came before; a text of which nothing is left goes."""
    return linededup.drop_repeated_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return neardup.drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, with ``epoch``."""
    return mixing.mix_documents(docs)


STAGES = [
    ("language id", language),
    ("line dedup", line_dedup),
    ("near duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("source mixing", mix),
]

#: Classifier, sketches and seeded sampling can't be said in SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        path = new_path(spark, f"pipeline-{k}")
        with scratch(spark):
            docs = save(stage(spark, docs, sf_dir), path)
    return docs
