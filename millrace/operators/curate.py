"""Curation operators: DataFrame in, DataFrame out, for ``df.transform``. Thresholds are arguments with the defaults that
define the results. Rows need doc_id and text; null texts are empty ones; order is that of doc_id. Each operator may
stamp its rows with a UTC time (``stamp``), which is off by default so that results repeat."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType
from pyspark.sql.window import Window

from millrace.functions import arrow, text as tx
from millrace.tables import small, written

#: Provenance that marks technical documents.
TECHNICAL_SOURCES = ["github_repo", "financial_pdf", "financial_audit_pdfs", "latex_research", "stack_overflow", "code_corpus"]

#: A scorer maps a text column to a score column; models are given as such functions.
Scorer = Callable[[Column], Column]


def stamped(df: DataFrame, column: str | None) -> DataFrame:
    """Adds the current UTC time as an ISO string, replacing the column if it exists."""
    return df.withColumn(column, F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")) if column else df


def need(df: DataFrame, *columns: str) -> DataFrame:
    """The contract at a stage's boundary: missing columns are an error, others are carried along."""
    if missing := [c for c in columns if c not in df.columns]:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def to_documents(ledger: DataFrame) -> DataFrame:
    """Relational rows as documents."""
    return ledger.withColumnsRenamed({"audit_uuid": "doc_id", "raw_audit_narrative": "text"})


def normalise(df: DataFrame, *, compose: bool = True, stamp: str | None = None) -> DataFrame:
    """Controls go, split words are joined, then compatibility composition for what isn't ASCII."""
    out = tx.dehyphenate(tx.strip_controls(tx.text("text")))
    return stamped(need(df, "text").withColumn("text", arrow.nfkc(out) if compose else out), stamp)


def strip_boilerplate(df: DataFrame, *, at_limit: bool = True, stamp: str | None = None) -> DataFrame:
    """Markup and stamps go; code-heavy texts are flagged, those of exactly 5 % too if ``at_limit``."""
    out = df.withColumn("text", tx.strip_boilerplate(tx.text("text")))
    return stamped(out.withColumn("is_code_heavy", tx.is_code_heavy(F.col("text"), at_limit=at_limit)), stamp)


def exact_dedup(df: DataFrame, history: DataFrame | None = None, *, order: str = "doc_id", stamp: str | None = None) -> DataFrame:
    """The first row of each content signature that history doesn't have; adds document_hash_signature.

    Only signatures and the order's values are shuffled, the least of each task. Rows that aren't the first of a text that
    occurs more than once are dropped by a join with them, which is a broadcast while they are few; texts that occur once,
    and those without history, never move. Rows of one text that share the least value count as one: any of them stays.
    """
    signed = df.withColumn("document_hash_signature", tx.content_signature(tx.text("text")))
    if history is not None:
        signed = signed.join(history.select("document_hash_signature").distinct(), "document_hash_signature", "left_anti")
    place = F.struct(F.col(order).isNull().alias("last"), F.col(order).alias("first"))
    groups = signed.groupBy(F.col("document_hash_signature").alias("signature")).agg(F.min(place).alias("least"), F.count("*").alias("n")).where("n > 1")
    groups = small(written(groups.select("signature", "least"), "dedup-groups"))
    found = signed.join(groups, F.col("document_hash_signature") == F.col("signature"), "left")
    once = found.where("signature is null")
    firsts = found.where("signature is not null").where(place == F.col("least")).dropDuplicates(["document_hash_signature"])
    return stamped(once.unionByName(firsts).select(*df.columns, "document_hash_signature"), stamp)


def route(df: DataFrame, *, least_density: float = 0.15, is_code: Scorer | None = None, stamp: str | None = None) -> DataFrame:
    """branch_id: 1 for technical provenance, or dense texts that the scorer, if there is one, calls code; else 0."""
    dense = tx.symbol_density(tx.text("text")) >= least_density
    if is_code is not None:
        dense = dense & is_code(tx.for_model(tx.text("text"), 1000))
    known = F.coalesce(F.col("source_type").isin(TECHNICAL_SOURCES), F.lit(False)) if "source_type" in df.columns else F.lit(False)
    return stamped(df.withColumn("branch_id", F.when(known | dense, 1).otherwise(0).cast("tinyint")), stamp)


def branch(df: DataFrame, k: int) -> DataFrame:
    return df.where(F.coalesce(F.col("branch_id"), F.lit(0)) == k)


def union_branches(a: DataFrame, b: DataFrame) -> DataFrame:
    """All rows of both; columns that one lacks are null there."""
    return a.unionByName(b, allowMissingColumns=True)


def prose_ratios(df: DataFrame) -> DataFrame:
    t = tx.text("text")
    return df.withColumns({"punctuation_ratio": tx.punctuation_ratio(t), "symbol_ratio": tx.symbol_ratio(t), "stop_word_ratio": tx.stop_word_ratio(t)})


def prose_rules(t: Column, *, punctuation: float = 0.3, symbols: float = 0.10, stop_words: float = 0.05) -> dict[str, Column]:
    """Why a text isn't prose, rule by rule."""
    p = tx.punctuation_ratio(t)
    return {"no_punctuation": p == 0, "much_punctuation": p > punctuation, "many_symbols": tx.symbol_ratio(t) > symbols, "few_stop_words": tx.stop_word_ratio(t) < stop_words}


def prose_filter(df: DataFrame, *, repetition: float = 0.15, stamp: str | None = None) -> DataFrame:
    """Keeps prose: the cheap ratios first, n-gram repetition for what they leave."""
    t = tx.text("text")
    bad = F.lit(False)
    for rule in prose_rules(t).values():
        bad = bad | rule
    return stamped(df.where(~bad).where(tx.top_gram_share(t) <= repetition), stamp)


def code_filter(df: DataFrame, *, low: float = 0.01, high: float = 0.45, longest: int = 2000, noise: Scorer | None = None, stamp: str | None = None) -> DataFrame:
    """Keeps code by symbol density and line length; ``noise`` gives the chance that a snippet is noise, 0.7 and more drops it."""
    t = tx.text("text")
    out = df.where(tx.symbol_density(t).between(low, high)).where(tx.longest_line(t) <= longest)
    if noise is not None:
        snippets = out.select("doc_id", F.explode(tx.code_snippets(t)).alias("snippet"))
        bad = snippets.where(noise(tx.for_model(F.col("snippet"), 1000)) >= 0.70).select("doc_id").distinct()
        out = out.join(bad, "doc_id", "left_anti")
    return stamped(out, stamp)


def quality_filter(df: DataFrame, label: Scorer | None = None, probability: Scorer | None = None, *, least: float = 0.65, stamp: str | None = None) -> DataFrame:
    """Keeps texts scored ``least`` or more; adds cqf_quality_score. hq counts its probability, lq what is left of 1,
    anything else 0; empty texts, or no scorer, 1."""
    t = tx.text("text")
    if label is None:
        score = F.lit(1.0)
    else:
        seen = tx.for_model(t, 2000)
        p, name = (probability(seen) if probability else F.lit(1.0)), label(seen)
        score = F.when(tx.trim_all(t) == "", 1.0).when(name == "hq", p).when(name == "lq", 1.0 - p).otherwise(0.0)
    out = df.withColumn("cqf_quality_score", score.cast("double"))
    return stamped(out.where(F.col("cqf_quality_score") >= least), stamp)


def domain_quality(df: DataFrame, scorer: Scorer | None = None, *, errors: float = 0.05, low: int = 2, high: int = 50, least: float = 0.60, stamp: str | None = None) -> DataFrame:
    """Keeps code with few lexer errors, middling complexity and a good score; adds domain_quality_score."""
    t = tx.text("text")
    out = df.where(tx.lexer_error_ratio(t) <= errors).where(arrow.cyclomatic(t).between(low, high))
    out = out.withColumn("domain_quality_score", (scorer(t) if scorer else F.lit(1.0)).cast("double"))
    return stamped(out.where(F.col("domain_quality_score") >= least), stamp)


def foreign_share(t: Column, target: str, detect: Scorer) -> Column:
    """Characters in paragraphs of another language than the target's, of all characters. The detector sees paragraphs whole; one
    with a limit cuts for itself (``tx.for_model``)."""
    foreign = F.aggregate(tx.paragraphs(t), F.lit(0), lambda acc, p: acc + F.when(detect(p) != target, F.length(p)).otherwise(0))
    return foreign / F.greatest(F.length(t), F.lit(1))


def language_filter(df: DataFrame, detect: Scorer, *, target: str = "en", most: float = 0.15, stamp: str | None = None) -> DataFrame:
    """Keeps texts with little in other languages. ``detect`` is a native expression of a paragraph."""
    return stamped(df.where(foreign_share(tx.text("text"), target, detect) <= most), stamp)


#: Function words.
FUNCTION_WORDS = {
    "en": "the and of to in is that was for with", "de": "der die und das ist nicht ein mit den von",
    "fr": "le la les des et est une dans que pour", "es": "el los las de que una con por para del",
}


def guess_language(p: Column) -> Column:
    """A native stand-in for a language model: whose function words are commonest."""
    low = F.concat(F.lit(" "), F.regexp_replace(F.lower(p), r"(?U)[^\w]+", "  "), F.lit(" "))

    def commonest(low: Column) -> Column:
        # two spaces between words, so matches never share one and a language takes one pass
        counts = [F.struct(F.regexp_count(low, F.lit(f" (?:{words.replace(' ', '|')}) ")).alias("n"), F.lit(-i).alias("i"), F.lit(name).alias("lang")) for i, (name, words) in enumerate(FUNCTION_WORDS.items())]
        return F.array_max(F.array(*counts))["lang"]

    return tx.bind(low, commonest)


def syntax_filter(df: DataFrame, *, stamp: str | None = None) -> DataFrame:
    """Keeps code that parses and doesn't break off; SQL may break off on an operator only if it still reads as SQL."""
    t = tx.text("text")
    good = F.when(tx.dangling_end(t), arrow.sql_valid(t)).otherwise(arrow.syntax_valid(t))
    return stamped(df.where(good), stamp)


#: Plain insults.
INSULTS = ["idiot", "moron", "scum", "stupid", "dumb", "pathetic", "loser", "worthless", "trash", "garbage", "disgusting", "clown", "imbecile", "jerk"]


def insult_score(t: Column) -> Column:
    """A native stand-in for a toxicity model, over whole texts: each insult leaves three quarters of the doubt, so two and more
    score above 0.4."""
    n = F.regexp_count(F.lower(t), F.lit(r"(?<![a-z])(?:" + "|".join(INSULTS) + r")s?(?![a-z])"))
    return F.lit(1.0) - F.pow(F.lit(0.75), n.cast("double"))


def toxicity_filter(df: DataFrame, score: Scorer | None, *, most: float = 0.4, whole: bool = False, stamp: str | None = None) -> DataFrame:
    """Drops texts scored above ``most``; empty texts and failed scores (null) stay. A model sees what fits it, a native scorer
    the ``whole`` text."""
    if score is None:
        return stamped(df, stamp)
    t = tx.text("text")
    seen = t if whole else tx.for_model(t, 2000, one_line=False)
    return stamped(df.where((tx.trim_all(t) == "") | (F.coalesce(score(seen), F.lit(0.0)) <= most)), stamp)


def redact(df: DataFrame, *, stamp: str | None = None) -> DataFrame:
    """Entities become bracketed names."""
    return stamped(df.withColumn("text", tx.redact(tx.text("text"))), stamp)


def drop_empty(df: DataFrame) -> DataFrame:
    return df.where(F.length("text") > 0)


def chunk(df: DataFrame, *, most: int = 128_000, separator: str = "\n\n") -> DataFrame:
    """Texts of at most ``most`` characters stay; longer ones are cut between paragraphs, which are never cut themselves.

    (text, branch_id, preserve_whitespace) and the chunk's number; chunks of white space alone go.
    """
    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit(None).cast("string").alias("open"), F.lit(0).alias("size"))

    def step(s, p):
        full = s["open"].isNotNull() & (s["size"] + F.length(p) > most)
        new = F.struct(F.concat(s["done"], F.array(s["open"])).alias("done"), p.alias("open"), F.length(p).alias("size"))
        more = F.struct(s["done"].alias("done"), F.when(s["open"].isNull(), p).otherwise(F.concat(s["open"], F.lit(separator), p)).alias("open"), (s["size"] + F.length(p) + 2).alias("size"))
        return F.when(full, new).otherwise(more)

    cut = F.aggregate(F.split("text", separator, -1), start, step, lambda s: F.concat(s["done"], F.array(s["open"])))
    branch_id = F.coalesce(F.col("branch_id"), F.lit(0)).cast("tinyint") if "branch_id" in df.columns else F.lit(0).cast("tinyint")
    keys = ["doc_id"] if "doc_id" in df.columns else []
    clean = drop_empty(df).withColumn("text", tx.utf8(F.col("text")))
    parts = F.when(F.length("text") <= most, F.array("text")).otherwise(cut)
    out = clean.select(*keys, branch_id.alias("branch_id"), F.posexplode(parts).alias("chunk", "text"))
    return out.where(tx.trim_all(F.col("text")) != "").withColumn("preserve_whitespace", F.col("branch_id") == 1)


def pack(tokens: DataFrame, *, length: int = 4096, order: str = "doc_id", emit_tail: bool = False) -> DataFrame:
    """(chunk, input_ids, attention_mask): all tokens in order, cut into windows of ``length``; the rest isn't emitted.

    Offsets come from a running sum in two levels, ranges of the order and rows within a range, so no task sees all rows.
    """
    sized = tokens.select(F.col(order).alias("o"), F.col("input_ids").alias("ids"), F.size("input_ids").cast("long").alias("n"))
    parts = sized.repartitionByRange("o").sortWithinPartitions("o").withColumn("p", F.spark_partition_id())
    parts = written(parts, "pack-ranges")  # ranges must not be drawn anew between the two reads, whatever is lost
    sums = parts.groupBy("p").agg(F.sum("n").alias("n")).withColumn("base", F.coalesce(F.sum("n").over(Window.orderBy("p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    before = F.sum("n").over(Window.partitionBy("p").orderBy("o").rowsBetween(Window.unboundedPreceding, -1))
    placed = parts.join(F.broadcast(sums.select("p", "base")), "p").withColumn("off", F.col("base") + F.coalesce(before, F.lit(0))).where("n > 0")
    first, last = F.floor(F.col("off") / length), F.floor((F.col("off") + F.col("n") - 1) / length)
    pieces = placed.withColumn("chunk", F.explode(F.sequence(first, last)))
    lo = F.greatest(F.lit(0), F.col("chunk") * length - F.col("off"))
    hi = F.least(F.col("n"), (F.col("chunk") + 1) * length - F.col("off"))
    pieces = pieces.select("chunk", F.struct("off", F.slice("ids", (lo + 1).cast("int"), (hi - lo).cast("int")).alias("ids")).alias("piece"))
    rows = pieces.groupBy("chunk").agg(F.flatten(F.array_sort(F.collect_list("piece"))["ids"]).alias("input_ids"))  # ``length`` tokens a group at most
    rows = rows if emit_tail else rows.where(F.size("input_ids") == length)
    return rows.withColumn("attention_mask", F.transform("input_ids", lambda _: F.lit(1)))


def tokenise(df: DataFrame, path: str, pattern: str, *, end: int | None = None) -> DataFrame:
    """``df`` with input_ids, the byte-pair tokens of the whole text and perhaps an end mark. ``path`` is a rank file (a token
    in base64 and its rank a line) that the driver reads and sends to the workers once; ``pattern`` splits texts."""
    with open(path, "rb") as f:
        shared = df.sparkSession.sparkContext.broadcast((f.read(), pattern))  # a vocabulary: a few MB
    fields = [f for f in df.schema.fields if f.name != "input_ids"]
    schema = StructType([*fields, StructField("input_ids", ArrayType(IntegerType()))])

    def work(batches):
        import base64

        import pyarrow as pa
        import tiktoken

        data, own = shared.value
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines()) if a}
        encoding, mark = tiktoken.Encoding("own", pat_str=own, mergeable_ranks=ranks, special_tokens={}), [] if end is None else [end]
        for batch in batches:
            ids = [encoding.encode_ordinary(v.as_py() or "") + mark for v in batch.column("text")]
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in fields), pa.array(ids, pa.list_(pa.int32()))], names=[*(f.name for f in fields), "input_ids"])

    return df.select(*[f"`{f.name}`" for f in fields]).mapInArrow(work, schema)


def write_packed(rows: DataFrame, path: str) -> int:
    """Packed windows as a Parquet table of arrays of integers, in ranges of their number; returns how many."""
    out = rows.select("chunk", F.col("input_ids").cast("array<int>").alias("input_ids"), F.col("attention_mask").cast("array<tinyint>").alias("attention_mask"))
    out.repartitionByRange("chunk").sortWithinPartitions("chunk").write.mode("overwrite").parquet(path)
    return rows.sparkSession.read.parquet(path).count()


def hash_tokens(df: DataFrame, vocabulary: int = 50_000) -> DataFrame:
    """A native stand-in for a tokenizer: a number for each word."""
    return df.withColumn("input_ids", F.transform(tx.tokens(tx.text("text")), lambda w: F.pmod(F.xxhash64(w), F.lit(vocabulary)).cast("int")))


def benchmark_grams(items: DataFrame, n: int = 13, *, alnum: bool = False) -> DataFrame:
    """Distinct n-grams of the benchmark."""
    words = tx.alnum_tokens if alnum else tx.tokens
    return items.select(F.explode(tx.ngrams(words(tx.text("text")), n)).alias("gram")).distinct()


def gram_candidates(docs: DataFrame, items: DataFrame, n: int, *, alnum: bool, id_col: str, text_col: str = "text") -> DataFrame:
    """id_col of the documents that may share an n-gram with an item: by hashes, which miss nothing and all but never add one."""
    words = tx.alnum_tokens if alnum else tx.tokens
    known = small(written(items.select(F.explode(tx.gram_hashes(words(tx.text("text")), n)).alias("h")).distinct(), "gram-hashes"))
    mine = docs.select(id_col, F.explode(tx.gram_hashes(words(tx.text(text_col)), n)).alias("h"))
    return written(mine.join(known, "h", "left_semi").select(id_col).distinct(), "gram-candidates")


def gram_hits(docs: DataFrame, items: DataFrame, n: int = 13, *, alnum: bool = False, id_col: str = "doc_id") -> DataFrame:
    """id_col of the documents that share an n-gram with the benchmark: candidates by hash, then the n-grams themselves."""
    words = tx.alnum_tokens if alnum else tx.tokens
    near = docs.join(small(gram_candidates(docs, items, n, alnum=alnum, id_col=id_col)), id_col, "left_semi")
    mine = near.select(id_col, F.explode(tx.ngrams(words(tx.text("text")), n)).alias("gram"))
    return mine.join(benchmark_grams(items, n, alnum=alnum), "gram", "left_semi").select(id_col).distinct()


def decontaminate(docs: DataFrame, items: DataFrame, *, n: int = 13, mode: str = "substring", share: float = 0.20, longest: int = 100, stamp: str | None = None) -> DataFrame:
    """Drops documents that share an n-gram with the benchmark and, but for mode "drop", a long common substring or
    subsequence with any item: over ``share`` of the document or ``longest`` characters."""
    hits = written(gram_hits(docs, items, n), "gram-hits")
    if mode == "drop":
        return stamped(docs.join(small(hits), "doc_id", "left_anti"), stamp)
    suspects = docs.join(small(hits), "doc_id", "left_semi").select("doc_id", tx.text("text").alias("text"))
    bad = written(confirmed(suspects, items, mode, share, longest), "confirmed")
    return stamped(docs.join(small(bad), "doc_id", "left_anti"), stamp)


#: Characters of items, and of suspects, that meet in one task.
ITEM_BLOCK, SUSPECT_BLOCK = 1 << 20, 8 << 20


def confirmed(suspects: DataFrame, items: DataFrame, mode: str, share: float, longest: int) -> DataFrame:
    """doc_id of the suspects that have over ``share`` of themselves or over ``longest`` characters in common with an item.

    Items are dealt in blocks, suspects in shares of bounded size for each block; a block's windows are hashed once for all of
    a share's suspects, so no pair of a suspect and an item is ever a row.
    """
    suspects = written(suspects, "suspects")
    items = items.select(tx.text("text").alias("item")).where("item <> ''").distinct()
    blocks = max(1, -(-(items.agg(F.sum(F.length("item"))).first()[0] or 0) // ITEM_BLOCK))
    shares = max(1, -(-(suspects.agg(F.sum(F.length("text"))).first()[0] or 0) // SUSPECT_BLOCK), suspects.sparkSession.sparkContext.defaultParallelism)
    upto = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = suspects.select("doc_id", "text", F.pmod(F.xxhash64("doc_id"), F.lit(shares)).cast("int").alias("share"), upto(blocks).alias("block"))
    right = items.select("item", F.pmod(F.xxhash64("item"), F.lit(blocks)).cast("int").alias("block"), upto(shares).alias("share"))

    blocks_of, subsequence = arrow.Passages, arrow.common_subsequence  # what travels, not the module with its user-defined functions

    def meet(mine, theirs):
        import math

        import pandas as pd

        texts, found = theirs["item"].tolist(), []
        passages = blocks_of(texts)
        # in order of the length asked for, so that windows of one length are hashed once
        wanted = sorted((min(math.floor(len(t) * share), longest) + 1, i, t) for i, t in enumerate(mine["text"]))
        for k, i, t in wanted:
            hit = passages.shares(t, k) if mode == "substring" else any(subsequence(t, x) >= k for x in texts)
            if hit:
                found.append(i)
        return pd.DataFrame({"doc_id": mine["doc_id"].iloc[sorted(found)]})

    kind = suspects.schema["doc_id"].dataType.simpleString()
    pairs = left.groupBy("block", "share").cogroup(right.groupBy("block", "share"))
    return pairs.applyInPandas(meet, f"doc_id {kind}").distinct()
