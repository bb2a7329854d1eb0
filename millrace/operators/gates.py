"""Quality gates: rules as rows (gate, rule, observed, passed), and an error that names what failed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.sources.files import FileStore

from .curate import gram_candidates, gram_hits
from millrace.functions import text as tx
from millrace.tables import small

RULES = "gate string, rule string, observed string, passed boolean"
#: Canary texts whose 13-grams must not occur in a curated corpus.
CANARIES = {
    "mmlu_econ_001": "Which of the following describes the condition when market supply perfectly matches consumer demand at an equilibrium price level?",
    "gsm8k_math_001": "A compliance fund starts with 5000000 dollars and allocates 20 percent to equity pairs and 30 percent to fixed income instruments.",
    "humaneval_code_001": "def verify_transaction_sequence(orders: list[int], threshold: float) -> bool: return all(o > threshold for o in orders)",
}


class GateFailure(AssertionError):
    """A gate that must stop the pipeline."""


def enforce(rules: list[tuple[str, str, str, bool]]) -> list[tuple[str, str, str, bool]]:
    if failed := [f"{gate}: {rule} ({observed})" for gate, rule, observed, passed in rules if not passed]:
        raise GateFailure("; ".join(failed))
    return rules


def as_rows(spark: SparkSession, rules: list[tuple[str, str, str, bool]]) -> DataFrame:
    return spark.createDataFrame(rules, RULES)


def landing_rules(spark: SparkSession, prefixes: dict[str, str | None]) -> list[tuple[str, str, str, bool]]:
    """Gate 1 over landing folders (None: stream not active): some data file each, none of them empty. Names that start
    with _ or . are markers."""
    rules = []
    for stream, path in prefixes.items():
        if path is None:
            continue
        files = FileStore(spark, path).list()
        data = [f for f in files if f.path.rpartition("/")[2][0] not in "_."]
        empty = [f.path for f in data if f.size == 0]
        rules += [("1", f"{stream}: has objects", f"{len(files)} objects", bool(files)), ("1", f"{stream}: has data, not only metadata markers", f"{len(data)} data files", bool(data) or not files), ("1", f"{stream}: no zero-byte file", ", ".join(empty[:5]) or "none", not empty)]
    return rules


def silver_audit(df: DataFrame) -> DataFrame:
    """One row: n_rows, null_ids, null_texts of a curated table; doc_id is looked for before id."""
    id_col = next((c for c in ("doc_id", "id") if c in df.columns), None)
    if id_col is None or "text" not in df.columns:
        raise GateFailure(f"missing {'an id column' if id_col is None else 'text'}")
    return df.agg(F.count("*").alias("n_rows"), F.count_if(F.col(id_col).isNull()).alias("null_ids"), F.count_if(F.col("text").isNull()).alias("null_texts"))


def silver_rules(spark: SparkSession, path: str) -> list[tuple[str, str, str, bool]]:
    """Gate 2 over a curated Parquet table: files that hold bytes and rows, an id and a text in every row."""
    files = [f for f in FileStore(spark, path).list() if f.path.endswith(".parquet")]
    empty = [f.path for f in files if f.size == 0]
    rules = [("2", "has files", f"{len(files)} files", bool(files)), ("2", "no zero-byte file", ", ".join(empty[:5]) or "none", not empty)]
    if not files or empty:
        return rules
    df = spark.read.parquet(path)
    held = df.select(F.col("_metadata.file_name").alias("name")).distinct()
    listed = spark.createDataFrame([(f.path, f.path.rpartition("/")[2]) for f in files], "path string, name string")
    without = [r["path"] for r in listed.join(held, "name", "left_anti").orderBy("path").limit(5).collect()]
    rules.append(("2", "every file has rows", ", ".join(without[:5]) or "all have", not without))
    n, ids, texts = silver_audit(df).first()
    return [*rules, ("2", "has rows", str(n), n > 0), ("2", "no null ids", str(ids), ids == 0), ("2", "no null texts", str(texts), texts == 0)]


def leakage(df: DataFrame, items: DataFrame, *, n: int = 13) -> DataFrame:
    """(doc_id, gram, items): every benchmark n-gram in every document, with the items that have it."""
    id_col = next((c for c in ("doc_id", "audit_uuid") if c in df.columns), None)
    text_col = next((c for c in ("text", "raw_audit_narrative") if c in df.columns), None)
    if id_col is None or text_col is None:
        raise GateFailure(f"missing {'an id column' if id_col is None else 'a text column'}")
    near = gram_candidates(df, items, n, alnum=True, id_col=id_col, text_col=text_col)
    df = df.join(small(near), id_col, "left_semi")
    known = items.select("item_id", F.explode(tx.ngrams(tx.alnum_tokens(tx.text("text")), n)).alias("gram")).groupBy("gram").agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    mine = df.select(F.col(id_col).alias("doc_id"), F.explode(F.array_distinct(tx.ngrams(tx.alnum_tokens(tx.text(text_col)), n))).alias("gram"))
    return mine.join(known, "gram").select("doc_id", "gram", "items")


def leakage_rules(df: DataFrame, items: DataFrame | None = None) -> list[tuple[str, str, str, bool]]:
    """Gate 3: no benchmark 13-gram in any document; the first five offenders are named."""
    items = items if items is not None else df.sparkSession.createDataFrame(list(CANARIES.items()), "item_id string, text string")
    hits = leakage(df, items)
    first = hits.orderBy("doc_id", "gram").limit(5).collect()
    n = hits.count() if first else 0
    return [("3", "no benchmark n-gram", f"{n} hits: {[(r['doc_id'], r['items']) for r in first]}" if n else "0 hits", n == 0)]


def should_fire(states: list[str]) -> bool:
    """Whether a gate runs after its streams: none failed and at least one succeeded."""
    return "failed" not in states and "success" in states


__all__ = ["CANARIES", "GateFailure", "as_rows", "enforce", "gram_hits", "landing_rules", "leakage", "leakage_rules", "should_fire", "silver_audit", "silver_rules"]
