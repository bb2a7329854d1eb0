"""The registered queries of these operators, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import decontaminate, langid, linededup, mixing, neardup, pseudonyms, secrets, tokencounts, vafile, warc
from .common import new_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of every document."""
    mix = mixing.mix_plan(table(spark, sf_dir, "documents"))
    return mix.select("doc_id", "size", "source_size", "target", "taken", "source", "whole", "part")


#: For the registered query only; a real key is a secret of whoever runs the operator.
PSEUDONYM_KEY = "millrace-demonstration-key"


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens by source, language and tokenizer version, after a load, its repetition and a full refresh."""
    return tokencounts.corpus_totals(table(spark, sf_dir, "documents"), new_path(spark, "token-rollup"), tokencounts.public_tokenizer(spark))


def op2_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its personal numbers, dates and addresses pseudonymised."""
    return pseudonyms.pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"), PSEUDONYM_KEY)


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text less the passages that came before."""
    return linededup.dedup_lines(table(spark, sf_dir, "documents")).select("doc_id", "text", "n_lines", "n_removed")


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, and which."""
    found = decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "similarity", "start", "n_words", "n_windows")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The predicted language of every document."""
    return langid.identify(table(spark, sf_dir, "documents"))


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's component of near duplicates."""
    return neardup.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "kept")


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of secrets in every document."""
    return secrets.scan(table(spark, sf_dir, "documents"))


def secret_base_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The part of the scan that SQL can say: the fixed patterns' matches, from the same operator."""
    return secrets.scan(table(spark, sf_dir, "documents"), words=[]).select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256")


def op9_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages through monolithic archives, normalised ones and back."""
    return warc.round_trip(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_vafile_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five best others of every fiftieth vector."""
    return vafile.top_k(table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_token_counts": op1_token_counts,
    "op2_pii_pseudonyms": op2_pii_pseudonyms,
    "op3_line_dedup": op3_line_dedup,
    "op4_source_mixing": op4_source_mixing,
    "op5_decontamination": op5_decontamination,
    "op6_language_id": op6_language_id,
    "op7_near_duplicates": op7_near_duplicates,
    "op8_secret_scan": op8_secret_scan,
    "op9_warc_round_trip": op9_warc_round_trip,
    "op10_vafile_topk": op10_vafile_topk,
    "secret_base_spans": secret_base_spans,
}
ORACLES = {
    "op3_line_dedup": linededup.SQL,
    "op4_source_mixing": mixing.SQL,
    "op5_decontamination": decontaminate.SQL,
    "op7_near_duplicates": neardup.SQL,
    "secret_base_spans": secrets.BASE_SQL,
    "op9_warc_round_trip": warc.SQL,
    "op10_vafile_topk": vafile.SQL,
}
