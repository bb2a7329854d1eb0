"""Every query of the library's own operators: name -> callable, and its DuckDB SQL where SQL can express it.

Queries run over whole tables. Stand-ins are named as such: ``labels`` stands for the scores of a quality model, so that what
is done with scores can be checked; texts of code and of judges, of which the tables have none, are made up of event ids.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import arrow, text as tx
from millrace.operators import curate, gates, lsh, registry, stats
from millrace.sources import ingest, seed
from millrace.sources.files import FileStore
from millrace.tables import shared_dir, written

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(name: str, sql: str | None = None):
    """Register a query under ``name``, with the SQL that gives the same rows."""

    def register(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return register


# --- SQL pieces -------------------------------------------------------------------------------------------------------

# The rules' patterns in DuckDB's dialect.
CONTROLS_SQL = r"[\x00-\x08\x0B-\x1F\x7F\x{200B}\x{200C}\x{00AD}\x{FFFD}]"
BOILERPLATE_SQL = r"(?is:<(?:script|style)\b[^>]*>.*?</(?:script|style)>)|<[^>]+>|(?i:\bpage\s+\d+\s+of\s+\d+\b)|(?i:copyright\s+(?:\(c\)|©)?\s*\d{4}[^.\n]*\.)|(?i:\b(?:confidential - internal use only|confidential|draft copy)\b)"


def _count(c: str, what: str) -> str:
    return f"((length({c}) - length(replace({c}, '{what}', ''))) // {len(what)})"


def _total(c: str, what: list[str]) -> str:
    return "(" + " + ".join(_count(c, w) for w in what) + ")"


_LOW = f"translate(text, '{''.join(map(chr, range(65, 91)))}', '{''.join(map(chr, range(97, 123)))}')"
_WORDS = f"({_count('text', ' ')} + 1)"
PUNCTUATION_SQL = f"cast({_total('text', tx.PUNCTUATION)} as double) / {_WORDS}"
SYMBOL_SQL = f"cast({_total('text', tx.SYMBOLS)} as double) / {_WORDS}"
STOP_SQL = f"cast({_total(_LOW, [f' {w} ' for w in tx.STOP_WORDS])} as double) / {_WORDS}"
DENSITY_SQL = f"cast({_total('t', tx.CODE_SYMBOLS)} as double) / greatest(length(regexp_replace(t, '\\s+', '', 'g')), 1)"
_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def strip_sql(c: str) -> str:
    return rf"trim(regexp_replace(regexp_replace({c}, '{BOILERPLATE_SQL}', '', 'g'), '\n[ \t\n]*\n', chr(10), 'g'), {_BLANKS})"


STRIP_SQL = strip_sql("coalesce(html, '')")
CLEAN_SQL = rf"regexp_replace(regexp_replace(coalesce(text, ''), '{CONTROLS_SQL}', '', 'g'), '\b([A-Za-z]{{2,}})-\s*\n\s*([A-Za-z]{{2,}})\b', '\1\2', 'g')"
REDACT_SQL = "regexp_replace(" * len(tx.ENTITIES) + "text" + "".join(f", '{p}', '[{e}]', 'g')" for e, p in tx.ENTITIES.items())


def language_sql(c: str) -> str:
    """The language whose function words are commonest, the first of equals."""
    low = rf"(' ' || regexp_replace(lower({c}), '[^\p{{L}}\p{{M}}\p{{N}}_]+', '  ', 'g') || ' ')"
    counts = ", ".join(_total(low, [f" {w} " for w in words.split()]) for words in curate.FUNCTION_WORDS.values())
    return f"list_element([{', '.join(repr(x) for x in curate.FUNCTION_WORDS)}], list_position([{counts}], list_max([{counts}])))"


def foreign_sql(source: str) -> str:
    """doc_id of texts that have over 15 % of their characters in paragraphs of other languages than English."""
    return rf"""(select doc_id from (select doc_id, n, trim(p, {_BLANKS}) as p from (select doc_id, length(text) as n, unnest(regexp_split_to_array(text, '\n\s*\n')) as p from {source})) where p <> ''
      group by doc_id, n having sum(case when {language_sql('p')} <> 'en' then length(p) else 0 end) / greatest(n, 1) > 0.15)"""


SIGNATURE_SQL = "md5_number_upper(text)"
TOKENS_SQL = r"list_filter(regexp_split_to_array(lower(text), '\s+'), lambda w: w <> '')"
ALNUM_SQL = r"list_filter(regexp_split_to_array(regexp_replace(lower(text), '[^\p{L}\p{M}\p{N}_\s]', ' ', 'g'), '\s+'), lambda w: w <> '')"


def grams_sql(source: str, key: str, n: int, words: str = TOKENS_SQL) -> str:
    """(key, gram): a row per n-gram of a table's texts."""
    return f"""(select {key}, array_to_string(w[i:i + {n - 1}], ' ') as gram
      from (select {key}, w, unnest(range(1, len(w) - {n - 2})) as i from (select {key}, {words} as w from {source}) where len(w) >= {n}))"""


DEDUP_SQL = "select * exclude (nth) from (select *, row_number() over (partition by md5(text) order by doc_id) as nth from documents) where nth = 1"
RATIOS_SQL = f"{PUNCTUATION_SQL} > 0 and {PUNCTUATION_SQL} <= 0.3 and {SYMBOL_SQL} <= 0.10 and {STOP_SQL} >= 0.05"


def repeats_sql(source: str) -> str:
    """doc_id of the texts of at least 15 words whose commonest 3-gram is over 15 % of all."""
    return f"""(select doc_id from (select doc_id, n, sum(n) over (partition by doc_id) as total from (
      select doc_id, gram, count(*) as n from {grams_sql(source, 'doc_id', 3)} group by doc_id, gram))
      group by doc_id having max(n) / max(total) > 0.15 and max(total) >= 13)"""


# --- cleaning and signatures ------------------------------------------------------------------------------------------


@query("normalize_controls", f"select doc_id, md5(regexp_replace(coalesce(text, ''), '{CONTROLS_SQL}', '', 'g')) as digest, cast(length(regexp_replace(coalesce(text, ''), '{CONTROLS_SQL}', '', 'g')) as bigint) as n_clean from documents")
def normalize_controls(spark, sf_dir):
    """Control and phantom characters out."""
    out = table(spark, sf_dir, "documents").select("doc_id", tx.strip_controls(tx.text("text")).alias("t"))
    return out.select("doc_id", F.md5(F.col("t").cast("binary")).alias("digest"), F.length("t").cast("long").alias("n_clean"))


@query("normalize_full")
def normalize_full(spark, sf_dir):
    """Controls, hyphenation and compatibility composition; SQL has no NFKC."""
    return curate.normalise(table(spark, sf_dir, "documents")).select("doc_id", "text")


@query("dehyphenate", r"""select doc_id, regexp_replace(text, '\b([A-Za-z]{2,})-\s*\n\s*([A-Za-z]{2,})\b', '\1\2', 'g') as text from documents""")
def dehyphenate(spark, sf_dir):
    """Words split over lines joined."""
    return table(spark, sf_dir, "documents").select("doc_id", tx.dehyphenate(tx.text("text")).alias("text"))


@query("boilerplate_strip", f"select page_id, md5({STRIP_SQL}) as digest, cast(length({STRIP_SQL}) as integer) as n from pages")
def boilerplate_strip(spark, sf_dir):
    """Markup, stamps and blank lines out of pages."""
    out = table(spark, sf_dir, "pages").select("page_id", tx.strip_boilerplate(tx.text("html")).alias("text"))
    return out.select("page_id", F.md5(F.col("text").cast("binary")).alias("digest"), F.length("text").alias("n"))


@query("code_density_flag", f"with p as (select page_id, {STRIP_SQL} as t from pages) select page_id, cast(cast({_total('t', tx.CODE_MARKS)} as double) / greatest(length(t), 1) as float) > 0.05 as is_code_heavy from p")
def code_density_flag(spark, sf_dir):
    """Pages whose text is code-heavy once stripped."""
    out = curate.strip_boilerplate(table(spark, sf_dir, "pages").select("page_id", F.col("html").alias("text")), at_limit=False)
    return out.select("page_id", "is_code_heavy")


@query("symbol_density", f"select page_id, {DENSITY_SQL} as density from (select page_id, coalesce(html, '') as t from pages)")
def symbol_density(spark, sf_dir):
    """Programming symbols per solid character."""
    return table(spark, sf_dir, "pages").select("page_id", tx.symbol_density(tx.text("html")).alias("density"))


@query("content_signature", f"select doc_id, cast(case when {SIGNATURE_SQL} >= 9223372036854775808 then cast({SIGNATURE_SQL} as hugeint) - 18446744073709551616 else {SIGNATURE_SQL} end as bigint) as signature from documents")
def content_signature(spark, sf_dir):
    """The 64-bit signature of every text."""
    return table(spark, sf_dir, "documents").select("doc_id", tx.content_signature(tx.text("text")).alias("signature"))


@query("exact_dedup", f"select doc_id from ({DEDUP_SQL})")
def exact_dedup(spark, sf_dir):
    """The first document of each text."""
    return curate.exact_dedup(table(spark, sf_dir, "documents")).select("doc_id")


@query("dup_clusters", "select min(doc_id) as first_id, count(*) as n_docs from documents group by md5(text) having count(*) > 1")
def dup_clusters(spark, sf_dir):
    """Texts that occur more than once."""
    signed = table(spark, sf_dir, "documents").select("doc_id", tx.content_signature(tx.text("text")).alias("s"))
    return signed.groupBy("s").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("n_docs")).where("n_docs > 1").select("first_id", "n_docs")


@query("historical_dedup_antijoin", "select min(doc_id) as doc_id from documents where source <> 'src0' and md5(text) not in (select md5(text) from documents where source = 'src0') group by md5(text)")
def historical_dedup_antijoin(spark, sf_dir):
    """First documents of texts that an earlier load, here all of one source, doesn't have."""
    docs = table(spark, sf_dir, "documents")
    earlier = curate.exact_dedup(docs.where("source = 'src0'")).select("document_hash_signature")
    return curate.exact_dedup(docs.where("source <> 'src0'"), earlier).select("doc_id")


@query("normalization_fixpoint")
def normalization_fixpoint(spark, sf_dir):
    """Normalising twice changes nothing: how many documents there are, and how many it would change."""
    once = curate.normalise(table(spark, sf_dir, "documents")).select("text")
    again = once.withColumn("again", arrow.nfkc(tx.strip_controls(F.col("text"))))
    return again.agg(F.count("*").alias("n_docs"), F.count_if(F.col("text") != F.col("again")).alias("n_changed"))


# --- routing and filters ----------------------------------------------------------------------------------------------


@query("route_branch", f"select page_id, cast(case when {DENSITY_SQL} >= 0.15 then 1 else 0 end as tinyint) as branch_id from (select page_id, coalesce(html, '') as t from pages)")
def route_branch(spark, sf_dir):
    """Pages to the technical or the prose branch."""
    return curate.route(table(spark, sf_dir, "pages").select("page_id", F.col("html").alias("text"))).select("page_id", "branch_id")


@query("branch_union", f"""with r as (select page_id, length(t) as n, {DENSITY_SQL} >= 0.15 as code from (select page_id, coalesce(html, '') as t from pages))
  select page_id, case when code then cast(n as bigint) end as n_code, case when not code then cast(n as bigint) end as n_prose from r""")
def branch_union(spark, sf_dir):
    """Both branches again in one table, each with its own columns."""
    routed = curate.route(table(spark, sf_dir, "pages").select("page_id", tx.text("html").alias("text")))
    n = F.length("text").cast("long")
    return curate.union_branches(curate.branch(routed, 0).select("page_id", n.alias("n_prose")), curate.branch(routed, 1).select("page_id", n.alias("n_code")))


@query("prose_ratios", f"select doc_id, {PUNCTUATION_SQL} as punctuation_ratio, {SYMBOL_SQL} as symbol_ratio, {STOP_SQL} as stop_word_ratio from documents")
def prose_ratios(spark, sf_dir):
    """Punctuation, symbols and stop words per word."""
    return curate.prose_ratios(table(spark, sf_dir, "documents")).select("doc_id", "punctuation_ratio", "symbol_ratio", "stop_word_ratio")


@query("prose_filter", f"select doc_id from documents where {RATIOS_SQL} and doc_id not in {repeats_sql('documents')}")
def prose_filter(spark, sf_dir):
    """Documents that pass every rule for prose."""
    return curate.prose_filter(table(spark, sf_dir, "documents")).select("doc_id")


@query("prose_reject_reasons", f"""select count(*) filter ({PUNCTUATION_SQL} = 0) as no_punctuation, count(*) filter ({PUNCTUATION_SQL} > 0.3) as much_punctuation,
  count(*) filter ({SYMBOL_SQL} > 0.10) as many_symbols, count(*) filter ({STOP_SQL} < 0.05) as few_stop_words, lang from documents group by lang""")
def prose_reject_reasons(spark, sf_dir):
    """How many documents each rule rejects, per language."""
    rules = curate.prose_rules(tx.text("text"))
    return table(spark, sf_dir, "documents").groupBy("lang").agg(*[F.count_if(rule).alias(name) for name, rule in rules.items()])


@query("ngram_repetition", f"""select doc_id, max(n) / max(total) as share from (select doc_id, n, sum(n) over (partition by doc_id) as total from (
  select doc_id, gram, count(*) as n from {grams_sql('documents', 'doc_id', 3)} group by doc_id, gram)) group by doc_id having max(total) >= 13""")
def ngram_repetition(spark, sf_dir):
    """The commonest 3-gram's share, of documents of 15 words and more."""
    out = table(spark, sf_dir, "documents").select("doc_id", tx.top_gram_share(tx.text("text")).alias("share"))
    return out.where("share > 0")


@query("empty_purge", r"select doc_id from documents where length(text) > 0")
def empty_purge(spark, sf_dir):
    """Documents with a text."""
    return curate.drop_empty(table(spark, sf_dir, "documents")).select("doc_id")


@query("code_band", f"select page_id from (select page_id, coalesce(html, '') as t from pages) where {DENSITY_SQL} between 0.01 and 0.45 and list_max(list_transform(string_split(t, chr(10)), lambda l: length(l))) <= 2000")
def code_band(spark, sf_dir):
    """Pages within the density band of code, without overlong lines."""
    return curate.code_filter(table(spark, sf_dir, "pages").select("page_id", F.col("html").alias("text"))).select("page_id")


@query("quality_filter", "select d.doc_id, coalesce(cast(l.quality as double), 1.0) as cqf_quality_score from documents d left join labels l using (doc_id) where coalesce(l.quality, 1) >= 0.65")
def quality_filter(spark, sf_dir):
    """Documents of good quality; labels stand for scores, and no label for no model."""
    docs = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "left")
    name = F.when(F.col("quality") == 0, "lq").otherwise("hq")
    return curate.quality_filter(docs, lambda _: name, lambda _: F.lit(1.0)).select("doc_id", "cqf_quality_score")


@query("toxicity_filter", rf"select doc_id from (select doc_id, coalesce(text, '') as t from documents) where trim(t, {_BLANKS}) = '' or 1 - pow(0.75, len(string_split_regex(regexp_replace(lower(t), '[^a-z]+', '  ', 'g'), '(?:^|[ ])(?:{'|'.join(curate.INSULTS)})s?(?:$|[ ])')) - 1) <= 0.4")
def toxicity_filter(spark, sf_dir):
    """Documents that aren't toxic, by the native scorer over whole texts."""
    return curate.toxicity_filter(table(spark, sf_dir, "documents"), curate.insult_score, whole=True).select("doc_id")


@query("toxicity_filter_labels", "select d.doc_id from documents d left join labels l using (doc_id) where trim(d.text) = '' or coalesce(l.toxic, 0) <= 0.4")
def toxicity_filter_labels(spark, sf_dir):
    """The same with a model's scores, for which labels stand; no label is a failed score, which passes."""
    docs = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels").select("doc_id", "toxic"), "doc_id", "left")
    return curate.toxicity_filter(docs, lambda _: F.col("toxic").cast("double")).select("doc_id")


@query("language_filter", f"select doc_id from documents where doc_id not in {foreign_sql('documents')}")
def language_filter(spark, sf_dir):
    """Documents with little in other languages than English, paragraph by paragraph, by the native detector."""
    return curate.language_filter(table(spark, sf_dir, "documents"), curate.guess_language).select("doc_id")


@query("language_agreement", f"select lang, {language_sql("coalesce(text, '')")} as guess, count(*) as n_docs from documents group by 1, 2")
def language_agreement(spark, sf_dir):
    """The function-word detector, over whole texts, against the lang column: counts of each pair."""
    docs = table(spark, sf_dir, "documents").select("lang", curate.guess_language(tx.text("text")).alias("guess"))
    return docs.groupBy("lang", "guess").agg(F.count("*").alias("n_docs"))


@query("pii_redact", "select doc_id, md5(" + "regexp_replace(" * len(tx.ENTITIES) + "text" + "".join(f", '{p}', '[{e}]', 'g')" for e, p in tx.ENTITIES.items()) + ") as digest from documents")
def pii_redact(spark, sf_dir):
    """Entities replaced by their names."""
    out = curate.redact(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.md5(F.col("text").cast("binary")).alias("digest"))


@query("pii_counts", "select " + ", ".join(f"sum(len(regexp_extract_all(text, '{p}'))) ::bigint as {e.lower()}" for e, p in tx.ENTITIES.items()) + " from documents")
def pii_counts(spark, sf_dir):
    """Entities of each kind in all texts."""
    return table(spark, sf_dir, "documents").agg(*[F.sum(tx.entity_count(tx.text("text"), e)).cast("long").alias(e.lower()) for e in tx.ENTITIES])


# --- fuzzy dedup and decontamination ----------------------------------------------------------------------------------


@query("shingle_jaccard_pairs", f"""with s as (select distinct doc_id, gram from {grams_sql('documents', 'doc_id', 3)} union select doc_id, coalesce(text, '') from documents where coalesce(len({TOKENS_SQL}), 0) < 3),
  n as (select doc_id, count(*) as n, md5(string_agg(gram, chr(10) order by gram)) as h from s group by doc_id),
  k as (select doc_id, n, min(doc_id) over (partition by h) as first from n),
  t as (select s.doc_id, gram, n from s join k on k.doc_id = s.doc_id and k.first = s.doc_id),
  c as (select a.doc_id as id_a, b.doc_id as id_b, a.n as x, b.n as y, count(*) as c from t a join t b on a.gram = b.gram and a.doc_id < b.doc_id group by all)
  select id_a, id_b, c / (x + y - c) as jaccard from c where c / (x + y - c) >= 0.8 union all select first, doc_id, 1.0 from k where first <> doc_id""")
def shingle_jaccard_pairs(spark, sf_dir):
    """Exactly similar pairs over word 3-grams, 0.8 and more, of distinct sets; copies with their first."""
    return lsh.similar_pairs(table(spark, sf_dir, "documents"))


@query("minhash_dedup")
def minhash_dedup(spark, sf_dir):
    """Documents that stay when each is taken unless it collides with one that stays. Depends on the hash family."""
    return lsh.fuzzy_dedup(table(spark, sf_dir, "documents")).select("doc_id")


@query("decontaminate_ngram", f"select doc_id from documents where doc_id not in (select doc_id from {grams_sql('documents', 'doc_id', 13)} where gram in (select gram from {grams_sql('benchmark', 'item_id', 13)}))")
def decontaminate_ngram(spark, sf_dir):
    """Documents that share no 13-gram with the benchmark."""
    return curate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), mode="drop").select("doc_id")


@query("decontaminate_lcs", f"""with hit as (select distinct doc_id from {grams_sql('documents', 'doc_id', 13)} where gram in (select gram from {grams_sql('benchmark', 'item_id', 13)})),
  d as (select doc_id, text, cast(least(floor(length(text) * 0.2::double), 100) as bigint) + 1 as k from documents where doc_id in (select doc_id from hit)),
  w as (select doc_id, k, substr(text, i, k) as part from (select *, unnest(range(1, length(text) - k + 2)) as i from d)),
  b as (select distinct k, substr(text, i, k) as part from (select k, text, unnest(range(1, length(text) - k + 2)) as i from benchmark, (select distinct k from d) where length(text) >= k))
  select doc_id from documents where doc_id not in (select doc_id from w join b using (k, part))""")
def decontaminate_lcs(spark, sf_dir):
    """As before, but a long common substring must confirm a shared 13-gram."""
    return curate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select("doc_id")


@query("contamination_report", f"""with b as (select distinct item_id, gram from {grams_sql('benchmark', 'item_id', 13, ALNUM_SQL)}), d as (select distinct doc_id, gram from {grams_sql('documents', 'doc_id', 13, ALNUM_SQL)})
  select doc_id, item_id, count(*) as n_grams from d join b using (gram) group by doc_id, item_id""")
def contamination_report(spark, sf_dir):
    """Which documents share how many 13-grams with which items."""
    hits = gates.leakage(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return hits.select("doc_id", F.explode("items").alias("item_id")).groupBy("doc_id", "item_id").agg(F.count("*").alias("n_grams"))


@query("gate2_audit", "select count(*) as n_rows, count(*) filter (doc_id is null) as null_ids, count(*) filter (text is null) as null_texts from documents")
def gate2_audit(spark, sf_dir):
    """Rows, null ids and null texts of the documents."""
    return gates.silver_audit(table(spark, sf_dir, "documents"))


@query("gate3_leakage", f"""with b as (select distinct gram from {grams_sql('benchmark', 'item_id', 13, ALNUM_SQL)}), d as (select distinct doc_id, gram from {grams_sql('documents', 'doc_id', 13, ALNUM_SQL)})
  select count(*) as n_hits, count(distinct doc_id) as n_docs from d join b using (gram)""")
def gate3_leakage(spark, sf_dir):
    """Hits of benchmark 13-grams, and the documents that have them."""
    return gates.leakage(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).agg(F.count("*").alias("n_hits"), F.count_distinct("doc_id").alias("n_docs"))


_CANARIES_SQL = "(select * from (values " + ", ".join(f"('{k}', '{v}')" for k, v in gates.CANARIES.items()) + ") as c(item_id, text))"


@query("gate3_canaries", f"""with b as (select distinct gram from {grams_sql(_CANARIES_SQL, 'item_id', 13, ALNUM_SQL)}), d as (select distinct doc_id, gram from {grams_sql('documents', 'doc_id', 13, ALNUM_SQL)})
  select 'no benchmark n-gram' as rule, count(*) = 0 as passed from d join b using (gram)""")
def gate3_canaries(spark, sf_dir):
    """The canary texts don't occur in the documents."""
    rules = gates.leakage_rules(table(spark, sf_dir, "documents"))
    return gates.as_rows(spark, rules).select("rule", "passed")


# --- chunks, tokens, packing ------------------------------------------------------------------------------------------


@query("audit_chunks", f"""with recursive d as (select doc_id, text from documents where length(text) > 0),
  l as materialized (select doc_id, unnest(string_split(text, chr(10))) as p, unnest(range(len(string_split(text, chr(10))))) as i from d where length(text) > 4000),
  s as materialized (select doc_id, i, cast(length(p) as bigint) as n, trim(p, {_BLANKS}) <> '' as solid from l),
  walk as (
    select doc_id, i, cast(0 as bigint) as chunk, n + 2 as size, n, solid from s where i = 0
    union all
    select s.doc_id, s.i, case when w.size + s.n > 4000 then w.chunk + 1 else w.chunk end, case when w.size + s.n > 4000 then s.n else w.size + s.n + 2 end, s.n, s.solid from walk w join s on s.doc_id = w.doc_id and s.i = w.i + 1
  )
  select doc_id, cast(chunk as integer) as chunk, cast(sum(n) + count(*) - 1 as integer) as n_chars, false as preserve_whitespace from walk group by doc_id, chunk having bool_or(solid)
  union all select doc_id, 0, cast(length(text) as integer), false from d where length(text) <= 4000 and trim(text, {_BLANKS}) <> ''""")
def audit_chunks(spark, sf_dir):
    """Documents cut between lines where they are longer than 4000 characters."""
    return curate.chunk(table(spark, sf_dir, "documents"), most=4000, separator="\n").select("doc_id", "chunk", F.length("text").alias("n_chars"), "preserve_whitespace")


@query("token_counts", f"select doc_id, cast(len({TOKENS_SQL}) as integer) as n_tokens from documents")
def token_counts(spark, sf_dir):
    """White-space tokens of every document."""
    return table(spark, sf_dir, "documents").select("doc_id", F.size(tx.tokens(tx.text("text"))).alias("n_tokens"))


@query("sequence_pack_windows", f"""with t as (select sum(len({TOKENS_SQL})) as n from documents) select cast(n as bigint) // 512 as n_windows, cast(512 as integer) as least, cast(512 as integer) as most from t""")
def sequence_pack_windows(spark, sf_dir):
    """Packed windows of 512 tokens: how many, and their lengths."""
    rows = curate.pack(curate.hash_tokens(table(spark, sf_dir, "documents")), length=512)
    return rows.agg(F.count("*").alias("n_windows"), F.min(F.size("input_ids")).alias("least"), F.max(F.size("attention_mask")).alias("most"))


@query("sequence_pack", f"""with w as (select doc_id, unnest({TOKENS_SQL}) as w, unnest(range(len({TOKENS_SQL}))) as k from documents),
  o as (select w, row_number() over (order by doc_id, k) - 1 as pos from w)
  select cast(pos // 512 as bigint) as chunk, md5(string_agg(w, ' ' order by pos)) as digest from o group by pos // 512 having count(*) = 512""")
def sequence_pack(spark, sf_dir):
    """Full windows of 512 words in document order, by digest."""
    words = table(spark, sf_dir, "documents").withColumn("input_ids", tx.tokens(tx.text("text")))
    return curate.pack(words, length=512).select("chunk", F.md5(F.array_join("input_ids", " ").cast("binary")).alias("digest"))


# --- ingestion --------------------------------------------------------------------------------------------------------


@query("incremental_delta", "select event_id from events where ts > timestamp '2024-01-20 12:00:00'")
def incremental_delta(spark, sf_dir):
    """Events after a watermark."""
    return table(spark, sf_dir, "events").where(ingest.newer(F.col("ts"), ingest.watermark("2024-01-20T12:00:00"))).select("event_id")


@query("watermark_max", "select count(*) as n, max(ts) as watermark from events")
def watermark_max(spark, sf_dir):
    """The watermark after a full load."""
    return table(spark, sf_dir, "events").agg(F.count("*").alias("n"), F.max("ts").alias("watermark"))


@query("delta_sensor", "select count(*) > 0 as has_delta from events where ts > timestamp '2024-01-20 12:00:00'")
def delta_sensor(spark, sf_dir):
    """Whether there is anything new."""
    found = ingest.has_delta(table(spark, sf_dir, "events"), ingest.watermark("2024-01-20 12:00:00"), "ts")
    return spark.createDataFrame([(found,)], "has_delta boolean")


@query("partition_counts_ymd", "select strftime(ts, '%Y') as year, strftime(ts, '%m') as month, strftime(ts, '%d') as day, count(*) as n from events group by 1, 2, 3")
def partition_counts_ymd(spark, sf_dir):
    """Rows of each date partition."""
    return ingest.with_date_parts(table(spark, sf_dir, "events"), "ts").groupBy("year", "month", "day").agg(F.count("*").alias("n"))


@query("division_filter", "select c_custkey from customer where c_mktsegment not in ('BUILDING', 'MACHINERY')")
def division_filter(spark, sf_dir):
    """Customers outside two segments; rows without a segment go too."""
    return ingest.division_filter(table(spark, sf_dir, "customer"), "c_mktsegment", ["BUILDING", "MACHINERY"]).select("c_custkey")


@query("jdbc_bounds", "select min(o_orderkey) as low, max(o_orderkey) as high, greatest(1, least(8, (max(o_orderkey) - min(o_orderkey)) // 500)) as partitions from orders")
def jdbc_bounds(spark, sf_dir):
    """Bounds of a range-partitioned read, and into how many ranges it goes."""
    low, high = ingest.bounds(table(spark, sf_dir, "orders"), "o_orderkey")
    return spark.createDataFrame([(low, high, ingest.partitions_for(low, high))], "low long, high long, partitions long")


# --- evaluation -------------------------------------------------------------------------------------------------------

_PAIRS = "(select user_id, event_type, case event_id % 3 when 0 then 'Candidate 1' when 1 then 'Candidate 2' else 'Tie' end as one, case event_id % 5 when 0 then 'Candidate 1' when 1 then 'Candidate 2' when 2 then 'Candidate 2' else 'Tie' end as two from events)"
_RESOLVED = f"(select event_type, case when one = 'Candidate 1' and two = 'Candidate 2' then 'candidate' when one = 'Candidate 2' and two = 'Candidate 1' then 'baseline' when one = two and one <> 'Tie' then 'inconsistent' else 'tie' end as w from {_PAIRS})"


def _trials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Judgements made up of event ids."""
    pick = lambda n, a, b: F.when(F.col("event_id") % n == 0, "Candidate 1").when((F.col("event_id") % n >= a) & (F.col("event_id") % n <= b), "Candidate 2").otherwise("Tie")
    out = table(spark, sf_dir, "events").select("event_type", pick(3, 1, 1).alias("one"), pick(5, 1, 2).alias("two"))
    return out.withColumn("resolved_winner", stats.resolve_pair(F.col("one"), F.col("two")))


@query("pairwise_resolution", f"select event_type, w as resolved_winner, count(*) as n from {_RESOLVED} group by event_type, w")
def pairwise_resolution(spark, sf_dir):
    """Judgements in both orders, resolved."""
    return _trials(spark, sf_dir).groupBy("event_type", "resolved_winner").agg(F.count("*").alias("n"))


@query("tournament_scorecard", f"""with c as (select event_type, count(*) as total, count(*) filter (w = 'candidate') as candidate_wins, count(*) filter (w = 'baseline') as baseline_wins, count(*) filter (w = 'tie') as ties, count(*) filter (w = 'inconsistent') as inconsistent_trials from {_RESOLVED} group by event_type),
  p as (select *, cast(total as double) as n, (candidate_wins + (ties + inconsistent_trials) * 0.5) / total as p from c),
  i as (select *, ((p + 3.8416 / (2 * n)) - sqrt(p * (1 - p) / n + 3.8416 / (4 * n * n)) * 1.96) / (1 + 3.8416 / n) as wilson_low, ((p + 3.8416 / (2 * n)) + sqrt(p * (1 - p) / n + 3.8416 / (4 * n * n)) * 1.96) / (1 + 3.8416 / n) as wilson_high from p)
  select event_type, total, candidate_wins, baseline_wins, ties, inconsistent_trials, round(candidate_wins / n, 9) as raw_win_rate, round(p, 9) as effective_win_rate, round(wilson_low, 9) as wilson_low, round(wilson_high, 9) as wilson_high, wilson_low >= 0.5 and p >= 0.52 as certified from i""")
def tournament_scorecard(spark, sf_dir):
    """Tournament counts, rates and Wilson bounds per segment."""
    out = stats.scorecard(_trials(spark, sf_dir), "event_type")
    return out.withColumns({c: F.round(c, 9) for c in ("raw_win_rate", "effective_win_rate", "wilson_low", "wilson_high")})


@query("mcnemar_counts", "select event_type, count(*) filter (event_id % 4 = 0 and event_id % 3 <> 0) as n_regressions, count(*) filter (event_id % 4 <> 0 and event_id % 3 = 0) as n_improvements from events group by event_type")
def mcnemar_counts(spark, sf_dir):
    """Discordant answers of two models made up of event ids."""
    answers = table(spark, sf_dir, "events").select("event_type", (F.col("event_id") % 4 == 0).cast("int").alias("base"), (F.col("event_id") % 3 == 0).cast("int").alias("cand"))
    return stats.paired_counts(answers, "event_type")


@query("composite_score", "select round(0.25 * avg(cast(quality as double)) + 0.25 * avg(1.0 - toxic) + 0.25 * avg(case when quality = 1 and toxic = 0 then 1.0 else 0.0 end) + 0.25, 9) as composite from labels")
def composite_score(spark, sf_dir):
    """Four accuracies under equal weights."""
    flags = {"a": F.col("quality") == 1, "b": F.col("toxic") == 0, "c": (F.col("quality") == 1) & (F.col("toxic") == 0), "d": F.lit(True)}
    return table(spark, sf_dir, "labels").agg(F.round(stats.composite({k: stats.accuracy(v) for k, v in flags.items()}), 9).alias("composite"))


@query("calibration_error", """with b as (select label, least(floor((conf) * 10), 9) as bin, count(*) as n, abs(avg(conf) - avg(correct)) as gap from (
  select event_type as label, (event_id % 97) / 97.0::double as conf, case when event_id % 2 = 0 then 1.0 else 0.0 end as correct from events) group by 1, 2) select label, round(sum(n * gap) / sum(n), 9) as ece from b group by label""")
def calibration_error(spark, sf_dir):
    """Expected calibration error over ten bins."""
    rows = table(spark, sf_dir, "events").select(F.col("event_type").alias("label"), ((F.col("event_id") % 97) / 97.0).alias("confidence"), (F.col("event_id") % 2 == 0).alias("correct"))
    return stats.calibration_error(rows, "label").withColumn("ece", F.round("ece", 9))


@query("best_choice", """select o_orderkey, choice from (select l_orderkey as o_orderkey, l_linenumber as choice, row_number() over (partition by l_orderkey order by -cast(l_extendedprice as double) / cast(l_quantity as double) desc, l_linenumber) as n from lineitem) where n = 1""")
def best_choice(spark, sf_dir):
    """The best of each question's choices; order lines stand for them."""
    choices = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_linenumber").alias("choice"), (-F.col("l_extendedprice").cast("double")).alias("logprob"), F.col("l_quantity").cast("double").alias("length"))
    return stats.best_choice(choices, "o_orderkey")


@query("lr_schedule", "select s as step, round(case when s < 100 then s * 0.001 / 100 when s > 1000 then 0.0001 else 0.0001 + 0.0009 * 0.5 * (1 + cos(pi() * (s - 100) / 900.0)) end, 12) as lr from (select unnest(range(1201)) as s)")
def lr_schedule(spark, sf_dir):
    """Learning rates of 1201 steps."""
    return spark.range(1201).select(F.col("id").alias("step"), F.round(stats.learning_rate(F.col("id"), warmup=100, total=1000, top=0.001, least=0.0001), 12).alias("lr"))


@query("snapshot_retention", "select event_type, event_id from (select event_type, event_id, row_number() over (partition by event_type order by event_id desc) as n from events where value > 0) where n <= 3")
def snapshot_retention(spark, sf_dir):
    """The three newest completed snapshots of each kind; events stand for them."""
    rows = table(spark, sf_dir, "events").select("event_type", "event_id", (F.col("value") > 0).alias("completed"))
    return stats.newest(rows, 3, "event_type", order="event_id").select("event_type", "event_id")


@query("final_number_extract", rf"""with t as (select conv_id, turn, coalesce(text, '') || case turn % 3 when 0 then ' #### $1,' || turn || '00.5 in all' when 1 then ' that is -' || conv_id || '.25 or 7,000' else '' end as t from conversations),
  p as (select conv_id, turn, t, regexp_replace(t, '[,$]', '', 'g') as plain from t)
  select conv_id, turn, coalesce(case when contains(t, '####') then nullif(regexp_extract(trim(list_extract(string_split(plain, '####'), -1), {_BLANKS}), '^-?[0-9]+(?:\.[0-9]+)?'), '') end, list_extract(regexp_extract_all(plain, '-?[0-9]+(?:\.[0-9]+)?'), -1)) as number from p""")
def final_number_extract(spark, sf_dir):
    """The final number of each turn, with two kinds of endings added."""
    kind = F.col("turn") % 3
    end = F.when(kind == 0, F.concat(F.lit(" #### $1,"), "turn", F.lit("00.5 in all"))).when(kind == 1, F.concat(F.lit(" that is -"), "conv_id", F.lit(".25 or 7,000"))).otherwise("")
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", tx.final_number(F.concat(tx.text("text"), end)).alias("number"))


@query("json_keys", """select event_id, coalesce(json_type(try_cast(props as json)) = 'OBJECT' and list_contains(json_keys(try_cast(props as json)), 'k'), false) as has_k, event_id % 4 = 0 and coalesce(json_type(try_cast(props as json)) = 'OBJECT', false) as has_both,
  false as of_broken from events""")
def json_keys(spark, sf_dir):
    """Which events' properties are objects with a key, with two keys (one is added to every fourth), and that broken ones have none."""
    more = F.when(F.col("event_id") % 4 == 0, F.replace("props", F.lit("{"), F.lit('{"m": null, '))).otherwise(F.col("props"))
    return table(spark, sf_dir, "events").select("event_id", tx.json_has_keys(F.col("props"), ["k"]).alias("has_k"), tx.json_has_keys(more, ["m", "k"]).alias("has_both"), tx.json_has_keys(F.concat("props", F.lit("}")), ["k"]).alias("of_broken"))


# --- code, judges, releases: texts and numbers made up of event ids ----------------------------------------------------


def _code(spark: SparkSession, sf_dir: str, *parts) -> DataFrame:
    # a file may be one task's; written, since filters on texts would be pushed below the exchange
    ids = written(table(spark, sf_dir, "events").select("event_id").repartition(3 * spark.sparkContext.defaultParallelism, "event_id"), "code-ids")
    return ids.select(F.col("event_id").alias("doc_id"), F.concat(*[x if not isinstance(x, str) else F.lit(x) for x in parts]).alias("text"))


def _id(n: int):
    return (F.col("event_id") % n).cast("string")


@query("code_cleaning", rf"""with p as (select page_id, coalesce(html, '') as t from pages),
  c as (select page_id, t, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(t, '(?s)\"\"\".*?\"\"\"', '', 'g'), '(?s)''''''.*?''''''', '', 'g'), '#[^\n]*', '', 'g'), '\n\s*\n', chr(10), 'g'), {_BLANKS}) as bare from p)
  select page_id, md5(bare) as digest, len(list_filter(list_transform(string_split(bare, chr(10)), lambda l: trim(l, {_BLANKS})), lambda l: l <> '')) as n_lines,
    regexp_matches(rtrim(t, {_BLANKS}), '(?:[-+=<>*/:,]|&&|\|\|)$') as dangling from c""")
def code_cleaning(spark, sf_dir):
    """Pages without comments, how many lines are left, and whether they break off on an operator."""
    out = table(spark, sf_dir, "pages").select("page_id", tx.text("html").alias("t")).withColumn("bare", tx.strip_comments(F.col("t")))
    return out.select("page_id", F.md5(F.col("bare").cast("binary")).alias("digest"), F.size(tx.solid_lines(F.col("bare"))).cast("long").alias("n_lines"), tx.dangling_end(F.col("t")).alias("dangling"))


@query("lexer_error_ratio", f"select page_id, case when a > 0 then (a - b) / a else 0.0 end as ratio from (select page_id, len(regexp_extract_all(t, '(?s){tx.TOKENS.replace(chr(39), chr(39) * 2)}|.')) as a, len(regexp_extract_all(t, '{tx.TOKENS.replace(chr(39), chr(39) * 2)}')) as b from (select page_id, coalesce(html, '') as t from pages))")
def lexer_error_ratio(spark, sf_dir):
    """Characters of pages that start no token of code, among tokens."""
    return table(spark, sf_dir, "pages").select("page_id", tx.lexer_error_ratio(tx.text("html")).alias("ratio"))


@query("domain_quality", "select event_id as doc_id, case when event_id % 2 = 0 then 0.9 else 0.6 end::double as domain_quality_score from events where event_id % 60 between 1 and 49 and event_id % 7 <> 0 and event_id % 5 <> 0")
def domain_quality(spark, sf_dir):
    """Functions of 0 to 59 branches: those of middling complexity, without stray characters, that a scorer likes."""
    body = F.expr("repeat('    if x > 1:\n        x = x - 1\n', cast(event_id % 60 as int))")
    stray = F.when(F.col("event_id") % 7 == 0, F.lit("`" * 400)).otherwise(F.lit(""))
    docs = _code(spark, sf_dir, "def f(x):\n", body, "    return x\n# ", stray)
    docs = docs.withColumn("text", F.when(F.col("doc_id") % 7 == 0, F.replace("text", F.lit("# `"), F.lit("``"))).otherwise(F.col("text")))
    score = lambda _: F.when(F.col("doc_id") % 5 == 0, 0.59).when(F.col("doc_id") % 2 == 0, 0.9).otherwise(0.6)
    return curate.domain_quality(docs, score).select("doc_id", "domain_quality_score")


_SAMPLES = [
    ("def f(x):\n    return x\n", True), ("def f(x)\n    return x\n", False), ("SELECT a, count(*) FROM t WHERE b IN (1, 2) GROUP BY a", True), ("SELECT a FROM t WHERE", False), ("x = 1 +", False), ("SELECT *", True), ("hello there, world", False),
    ("INSERT INTO t (a) VALUES (1); DELETE FROM u", True), ("UPDATE t SET a = b,", False), ("", True),
]


@query("syntax_filter", f"select event_id as doc_id from events where event_id % 10 in ({', '.join(str(k) for k, (_, good) in enumerate(_SAMPLES) if good)})")
def syntax_filter(spark, sf_dir):
    """Code that parses, or SQL that does though it ends on an operator."""
    pick = F.get(F.array(*[F.lit(t) for t, _ in _SAMPLES]), (F.col("event_id") % 10).cast("int"))
    return curate.syntax_filter(_code(spark, sf_dir, pick)).select("doc_id")


@query("structure_dedup", "select min(event_id) as doc_id from events group by event_id % 50")
def structure_dedup(spark, sf_dir):
    """One of each structure: functions with names of their own, alike but for one of 50 numbers."""
    name = F.col("event_id").cast("string")
    return lsh.structure_dedup(_code(spark, sf_dir, "def f", name, "(a", name, "):\n    b", name, " = a", name, " + ", _id(50), "\n    return b", name)).select("doc_id")


@query("code_fuzzy_dedup", "select min(event_id) as doc_id from events group by event_id % 40")
def code_fuzzy_dedup(spark, sf_dir):
    """One of each set of lines, whatever their order and comments: five lines of one of 40 families."""
    lines = [F.concat(F.lit(f"v{k}_"), _id(40), F.lit(f" = {k}")) for k in range(5)]
    order = F.when(F.col("event_id") % 3 == 0, F.concat_ws("\n", *lines)).otherwise(F.concat_ws("\n", *lines[::-1]))
    return lsh.code_fuzzy_dedup(_code(spark, sf_dir, order, "  # by ", _id(97))).select("doc_id")


@query("provenance_routing", "select doc_id, cast(case when source in ('src0', 'src1') then 1 else 0 end as tinyint) as branch_id from documents")
def provenance_routing(spark, sf_dir):
    """Documents of technical sources to the technical branch; the scorer says that no prose is code."""
    known = F.when(F.col("source") == "src0", "github_repo").when(F.col("source") == "src1", "latex_research").otherwise("web")
    return curate.route(table(spark, sf_dir, "documents").withColumn("source_type", known), is_code=lambda _: F.lit(False)).select("doc_id", "branch_id")


@query("fenced_answers", rf"""select conv_id, turn, md5(trim(t, {_BLANKS})) as digest from (select conv_id, turn, coalesce(text, '') as t from conversations) where not contains(t, '```')""")
def fenced_answers(spark, sf_dir):
    """Answers in a fence of their kind, in another one or in none, taken out again."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", tx.text("text").alias("t")).where(~F.col("t").contains("```"))
    kind = F.col("turn") % 3
    said = F.when(kind == 0, F.concat(F.lit("Here:\n```json\n"), "t", F.lit("\n```\nDone"))).when(kind == 1, F.concat(F.lit("So ```\n"), "t", F.lit("```"))).otherwise(F.col("t"))
    return rows.select("conv_id", "turn", F.md5(tx.unfence(said, "json").cast("binary")).alias("digest"))


@query("numeric_match", "select event_id % 6 as kind, event_id % 6 in (0, 2, 4) as same, count(*) as n from events group by 1, 2")
def numeric_match(spark, sf_dir):
    """Answers against the truth: close, too far, equal words, other words, exponents, none."""
    x = (F.col("event_id") + 1000).cast("double")
    pairs = [(x, x * 1.000001), (x, x * 1.001), (F.lit(" Yes"), F.lit("yes ")), (F.lit("yes"), F.lit("1")), (F.lit("1e3"), F.lit("1000.0")), (F.lit(None), F.lit("1"))]
    a, b = (F.get(F.array(*[p[k].cast("string") for p in pairs]), (F.col("event_id") % 6).cast("int")) for k in (0, 1))
    rows = table(spark, sf_dir, "events").select((F.col("event_id") % 6).alias("kind"), tx.numbers_match(a, b).alias("same"))
    return rows.groupBy("kind", "same").agg(F.count("*").alias("n"))


_JUDGED = [('```json\n{"winner": "Candidate 1"}\n```', "Candidate 1"), ("I find Candidate  2 better", "Candidate 2"), ('{"winner": "Candidate 2", "why": "Candidate 1 fails"}', "Candidate 2"), ("no idea", "Tie"), ('```\n{"winner": "both"}\n```', "Tie"), ('{"why": "Candidate 1"}', "Tie")]


@query("judge_parsing", "select event_type, case event_id % 6 " + " ".join(f"when {k} then '{w}'" for k, (_, w) in enumerate(_JUDGED)) + " end as winner, count(*) as n from events group by 1, 2")
def judge_parsing(spark, sf_dir):
    """Winners named in judges' answers of six kinds."""
    said = F.get(F.array(*[F.lit(x) for x, _ in _JUDGED]), (F.col("event_id") % 6).cast("int"))
    return table(spark, sf_dir, "events").select("event_type", tx.judge_winner(said).alias("winner")).groupBy("event_type", "winner").agg(F.count("*").alias("n"))


_DISCORDANT = "select event_type, count(*) filter (event_id % 4 = 0 and event_id % 3 <> 0) as n_regressions, count(*) filter (event_id % 4 <> 0 and event_id % 3 = 0) as n_improvements from events group by event_type"


def _answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_type", F.col("event_id").alias("item"), (F.col("event_id") % 4 == 0).cast("int").alias("base"), (F.col("event_id") % 3 == 0).cast("int").alias("cand"))


@query("mcnemar_test", f"""with c as ({_DISCORDANT}), x as (select event_type, n_regressions + n_improvements as n, pow(abs(n_improvements - n_regressions) - 1, 2) / (n_regressions + n_improvements) as chi2 from c)
  select event_type, round(case when n >= 25 then chi2 else 0 end, 9) as statistic, n >= 25 and chi2 > 3.841458820694124 as significant from x""")
def mcnemar_test(spark, sf_dir):
    """McNemar's statistic per benchmark, and whether it is significant at 5 %; every benchmark has more than 25 discordant pairs."""
    counts = stats.paired_counts(_answers(spark, sf_dir), "event_type").collect()  # a row per benchmark
    tests = [(r["event_type"], *stats.mcnemar(r["n_regressions"], r["n_improvements"])) for r in counts]
    return spark.createDataFrame([(k, round(x, 9), p < 0.05) for k, x, p in tests], "event_type string, statistic double, significant boolean")


@query("paired_bootstrap", "select event_type, round(avg((case when event_id % 3 = 0 then 1 else 0 end) - (case when event_id % 4 = 0 then 1 else 0 end)), 9) as mean, true as inside from events group by event_type")
def paired_bootstrap(spark, sf_dir):
    """Mean differences per benchmark, and that they lie within their resampled interval."""
    rows = _answers(spark, sf_dir)
    means = rows.groupBy("event_type").agg(F.avg(F.col("cand") - F.col("base")).alias("mean"))
    joined = means.join(stats.intervals(rows, "event_type", resamples=500), "event_type")
    return joined.select("event_type", F.round("mean", 9).alias("mean"), ((F.col("low") <= F.col("mean")) & (F.col("mean") <= F.col("high")) & (F.col("low") < F.col("high"))).alias("inside"))


@query("release_verdict", """with j as (select count(*) filter (event_id % 3 = 0) as wins, count(*) filter (event_id % 3 = 2) as ties, count(*) as n from events), p as (select (wins + 0.5 * ties) / n as p, cast(n as double) as n from j)
  select 'PROMOTED' as verdict, cast(0 as bigint) as n_failed, 'good' as candidate where (select p from p) < 2 union all
  select 'QUARANTINED', 2 + cast(((p + 3.8416 / (2 * n)) - 1.96 * sqrt(p * (1 - p) / n + 3.8416 / (4 * n * n))) / (1 + 3.8416 / n) < 0.5 as bigint) + cast(p < 0.52 as bigint), 'leaky' from p""")
def release_verdict(spark, sf_dir):
    """Verdicts on two candidates: one without fault, one with a leak, slow, and judged by the events."""
    wins, ties, total = table(spark, sf_dir, "events").agg(F.count_if(F.col("event_id") % 3 == 0), F.count_if(F.col("event_id") % 3 == 2), F.count("*")).first()
    m = {"ast_syntax_rate": 1.0, "eos_rate": 1.0, "kv_delta": 1e-5, "pii_leaks": 0, "ece": 0.01, "itl_ms": 10.0, "itl_sla_ms": 25.0, "vram_gb": 12.0, "vram_limit_gb": 24.0}
    good = stats.verdict(stats.release_rules(m, {"b": ([0, 1] * 50, [1, 1] * 50)}, (90, 5, 5, 100), resamples=200))
    bad = stats.verdict(stats.release_rules(m | {"pii_leaks": 3, "itl_ms": 30.0}, {"b": ([0, 1] * 50, [0, 1] * 50)}, (wins, total - wins - ties, ties, total), resamples=200))
    return spark.createDataFrame([(v["verdict"], len(v["rejection_reasons"]), k) for k, v in (("good", good), ("leaky", bad))], "verdict string, n_failed long, candidate string")


@query("registry_states", "select * from (values ('archived', 'v1'), ('champion', 'v1'), ('champion', 'v2'), ('quarantined', 'v2'), ('staged', 'v2')) as t(alias, version)")
def registry_states(spark, sf_dir):
    """The aliases that two versions go through: staged, champion, archived, quarantined after a rollback."""
    import uuid

    found, model = set(), registry.Registry(FileStore(spark, f"{shared_dir(spark)}/millrace/registry-{uuid.uuid4().hex}"), "m")
    model.register("v1", {"verdict": "PROMOTED"}, "a")
    model.promote("v1")
    for step in (lambda: model.register("v2", {"verdict": "PROMOTED", "sha256": "b"}, "b"), lambda: model.promote("v2"), model.rollback):
        step()
        found |= set(model.state()["aliases"].items())
    return spark.createDataFrame(sorted(found), "alias string, version string")


@query("record_bootstrap", "select (select count(*) from customer) * 3 as n, (select count(*) from customer) * 3 as n_keys, cast(0 as bigint) as n_outside from region limit 1")
def record_bootstrap(spark, sf_dir):
    """Suppliers replicated to three times the customers: rows, distinct keys, and amounts off by more than 5 % and rounding."""
    seeds = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("audit_uuid"), F.col("s_acctbal").cast("double").alias("amount"), F.lit("AAPL by Trader-12").alias("narrative"), F.col("s_acctbal").cast("double").alias("own"))
    rows = seed.replicate(seeds, 3 * table(spark, sf_dir, "customer").count(), order="audit_uuid")
    return rows.agg(F.count("*").alias("n"), F.count_distinct("audit_uuid").alias("n_keys"), F.count_if(F.abs(F.col("amount") - F.col("own")) > F.abs("own") * 0.05 + 0.011).alias("n_outside"))


@query("dataset_fingerprint")
def dataset_fingerprint(spark, sf_dir):
    """A digest of the documents that doesn't depend on their order."""
    return stats.fingerprint(table(spark, sf_dir, "documents"))


# --- the flagship -----------------------------------------------------------------------------------------------------


def funnel(docs: DataFrame, items: DataFrame) -> list[tuple[str, DataFrame]]:
    """Exact dedup, the rules for prose, decontamination; without compatibility composition, which SQL lacks. Each stage is
    computed once: its rows are written for the next one and for the counts."""
    unique = curate.exact_dedup(docs)
    prose = written(curate.prose_filter(unique), "funnel-prose")
    return [("deduplicated", unique), ("prose", prose), ("decontaminated", curate.decontaminate(prose, items, mode="drop"))]


_FUNNEL_SQL = f"""with unique_docs as ({DEDUP_SQL}), prose as (select * from unique_docs where {RATIOS_SQL} and doc_id not in {repeats_sql('unique_docs')}),
  clean as (select * from prose where doc_id not in (select doc_id from {grams_sql('prose', 'doc_id', 13)} where gram in (select gram from {grams_sql('benchmark', 'item_id', 13)})))"""


@query("curation_funnel", _FUNNEL_SQL + " select 'deduplicated' as stage, count(*) as n_docs from unique_docs union all select 'prose', count(*) from prose union all select 'decontaminated', count(*) from clean")
def curation_funnel(spark, sf_dir):
    """Documents that each stage leaves."""
    stages = funnel(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    counts = [df.agg(F.count("*").alias("n_docs")).select(F.lit(name).alias("stage"), "n_docs") for name, df in stages]
    return counts[0].union(counts[1]).union(counts[2])


@query("curation_survivors", _FUNNEL_SQL + f" select lang, count(*) as n_docs, round(avg({PUNCTUATION_SQL}), 9) as punctuation, round(avg({STOP_SQL}), 9) as stop_words from clean group by lang")
def curation_survivors(spark, sf_dir):
    """Survivors of the funnel per language, with mean ratios."""
    clean = funnel(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))[-1][1]
    t = tx.text("text")
    return clean.groupBy("lang").agg(F.count("*").alias("n_docs"), F.round(F.avg(tx.punctuation_ratio(t)), 9).alias("punctuation"), F.round(F.avg(tx.stop_word_ratio(t)), 9).alias("stop_words"))


def curated(docs: DataFrame, items: DataFrame, *, sql_only: bool = False) -> dict[str, DataFrame]:
    """The whole run from raw to curated, by stage. Documents are written where branches or counts read them again. What SQL
    can't say (compatibility composition, MinHash, syntax trees) is left out if ``sql_only``."""
    out = {}
    clean = written(curate.strip_boilerplate(curate.normalise(docs, compose=not sql_only)), "curated-clean")  # dedup reads it three times
    out["deduplicated"] = trunk = written(curate.route(curate.exact_dedup(clean)), "curated-trunk")
    prose, code = curate.branch(trunk, 0), curate.branch(trunk, 1)
    prose = curate.prose_filter(prose)
    out["prose rules"] = prose = written(prose if sql_only else lsh.fuzzy_dedup(written(prose, "curated-ruled")), "curated-prose")
    out["quality"] = prose = curate.quality_filter(prose)
    out["language"] = prose = written(curate.language_filter(prose, curate.guess_language), "curated-language")
    out["code band"] = code = written(curate.code_filter(code), "curated-code")
    if not sql_only:
        out["code structure"] = code = written(lsh.structure_dedup(code), "curated-structure")
        out["code quality"] = code = curate.syntax_filter(curate.domain_quality(code))
    both = curate.toxicity_filter(curate.union_branches(prose, code), curate.insult_score, whole=True)
    out["safe"] = both = written(curate.drop_empty(curate.redact(both)), "curated-safe")
    out["decontaminated"] = curate.decontaminate(both, items, mode="drop" if sql_only else "substring")
    return out


def _stage_counts(stages: dict[str, DataFrame]) -> DataFrame:
    counts = [df.agg(F.count("*").alias("n_docs"), F.sum(F.length("text")).alias("n_chars")).select(F.lit(name).alias("stage"), "n_docs", F.coalesce("n_chars", F.lit(0)).alias("n_chars")) for name, df in stages.items()]
    return functools.reduce(DataFrame.union, counts)


_TOXIC_SQL = rf"1 - pow(0.75, len(string_split_regex(regexp_replace(lower(text), '[^a-z]+', '  ', 'g'), '(?:^|[ ])(?:{'|'.join(curate.INSULTS)})s?(?:$|[ ])')) - 1) <= 0.4"
_CURATED_SQL = f"""with a as (select doc_id, {strip_sql(CLEAN_SQL)} as text from documents),
  b as materialized (select doc_id, text from (select *, row_number() over (partition by md5(text) order by doc_id) as nth from a) where nth = 1),
  d as materialized (select doc_id, text, {DENSITY_SQL.replace('(t,', '(text,').replace('length(t)', 'length(text)').replace('replace(t,', 'replace(text,')} as density from b),
  p0 as materialized (select doc_id, text from d where density < 0.15), p1 as materialized (select * from p0 where {RATIOS_SQL} and doc_id not in {repeats_sql('p0')}),
  p2 as materialized (select * from p1 where doc_id not in {foreign_sql('p1')}),
  c1 as materialized (select doc_id, text from d where density >= 0.15 and density <= 0.45 and list_max(list_transform(string_split(text, chr(10)), lambda l: length(l))) <= 2000),
  s as materialized (select doc_id, {REDACT_SQL} as text from (select * from p2 union all select * from c1) where (trim(text, {_BLANKS}) = '' or {_TOXIC_SQL})),
  s1 as materialized (select * from s where length(text) > 0),
  z as (select * from s1 where doc_id not in (select doc_id from {grams_sql('s1', 'doc_id', 13)} where gram in (select gram from {grams_sql('benchmark', 'item_id', 13)})))
  """


@query("curation_full", _CURATED_SQL + " union all ".join(f"select '{name}' as stage, count(*) as n_docs, cast(coalesce(sum(length(text)), 0) as bigint) as n_chars from {source}" for name, source in (("deduplicated", "d"), ("prose rules", "p1"), ("quality", "p1"), ("language", "p2"), ("code band", "c1"), ("safe", "s1"), ("decontaminated", "z"))))
def curation_full(spark, sf_dir):
    """The whole run, in what SQL can say: documents and characters that each stage leaves."""
    return _stage_counts(curated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), sql_only=True))


@query("curation_run")
def curation_run(spark, sf_dir):
    """The whole run with composition, MinHash, syntax trees and long common substrings."""
    return _stage_counts(curated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


# --- chat -------------------------------------------------------------------------------------------------------------


@query("chat_messages", "select conv_id, count(*) as n_turns, count(*) filter (role = 'assistant') as n_trained, sum(length(text)) filter (role = 'assistant') ::bigint as trained_chars from conversations group by conv_id")
def chat_messages(spark, sf_dir):
    """Conversations as message lists, with what an assistant-only loss would train on."""
    rows = table(spark, sf_dir, "conversations")
    chats = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("messages"))
    own = F.filter("messages", lambda m: m["role"] == "assistant")
    trained = F.aggregate(own, F.lit(0).cast("long"), lambda acc, m: acc + F.coalesce(F.length(m["text"]), F.lit(0)))
    return chats.select("conv_id", F.size("messages").cast("long").alias("n_turns"), F.size(own).cast("long").alias("n_trained"), F.when(F.size(own) > 0, trained).alias("trained_chars"))
