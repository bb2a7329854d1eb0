"""Fixture generators: a few records replicated to any number with seeded variation. Every value follows from the seed and the
row's number, so reruns agree and rows can be made anywhere."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The pool of tickers, those of them that are exchanged, and prefixes of a log header.
TICKERS = ["AAPL", "MSFT", "GOOGL", "AMZN", "JPM", "GS", "BAC", "NVDA", "TSLA", "WFC", "C", "MS", "BLK"]
EXCHANGED = ["AAPL", "MSFT", "GOOGL", "AMZN", "JPM", "GS", "TSLA", "NVDA"]
PREFIXES = ["SYSTEM_AUDIT_TRACE", "SEC_MONITOR_ALERT", "COMPLIANCE_ENGINE_v4", "FINRA_AUTO_FLAG", "GITHUB_REPO_SYNC", "DB_QUERY_LOG"]
#: What is renumbered, by kind, as (pattern, new text); {low..high} is a number drawn from that range, {x low..high} one in hexadecimal.
RENUMBERED = {
    "address": (r"\b[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\b", "{10..192}.{0..255}.{0..255}.{1..254}"),
    "hex": (r"0x[0-9A-Fa-f]{6,8}", "0x{x 1048576..16777215}"),
    "order": (r"ORD-[0-9]+", "ORD-{100000..999999}"),
    "account": (r"Account #[0-9]+", "Account #{100000..999999}"),
    "operator": (r"Operator ID:\s*[0-9]+", "Operator ID: {1000..9999}"),
    "trader": (r"Trader-[0-9]+", "Trader-{1000..9999}"),
}
#: How a header is put before a text of each kind, the first that the pattern finds.
HEADERS = [(r"def |import ", "# {}\n"), (r"(?is)SELECT |INSERT |\{.*\}|\}.*\{", "/* {} */\n"), ("", "{} - ")]


def _draw(seed: int, row: Column, what: str, low: int, high: int) -> Column:
    """A whole number from low to high, by seed, row and purpose."""
    return F.pmod(F.xxhash64(F.lit(seed), row, F.lit(what)), F.lit(high - low + 1)) + low


def _filled(template: str, seed: int, row: Column, what: str) -> Column:
    """A template with its numbers drawn."""
    parts = []
    for k, part in enumerate(re.split(r"(\{(?:x )?[0-9]+\.\.[0-9]+\})", template)):
        if m := re.fullmatch(r"\{(x )?([0-9]+)\.\.([0-9]+)\}", part):
            number = _draw(seed, row, f"{what}{k}", int(m[2]), int(m[3]))
            parts.append(F.lower(F.hex(number)) if m[1] else number.cast("string"))
        else:
            parts.append(F.lit(part))
    return F.concat(*parts)


def _exchanged(text: Column, row: Column, seed: int) -> Column:
    """Every word that is a ticker as another one, the same throughout a text; one pass over the words."""
    moved = [F.array(*[F.lit(x) for x in TICKERS if x != t])[_draw(seed, row, t, 0, len(TICKERS) - 2).cast("int")] for t in EXCHANGED]
    new = F.map_from_arrays(F.array(*map(F.lit, EXCHANGED)), F.array(*moved))
    return F.array_join(F.transform(F.regexp_extract_all(text, F.lit(r"\w+|\W+"), F.lit(0)), lambda w: F.coalesce(F.try_element_at(new, w), w)), "")


def mutate(text: Column, row: Column, seed: int = 7) -> Column:
    """Tickers exchanged, ids, hex numbers and addresses renumbered, and a header that the kind of content can bear."""
    out = reduce(lambda t, rule: F.regexp_replace(t, F.lit(rule[1][0]), _filled(rule[1][1], seed, row, rule[0])), RENUMBERED.items(), _exchanged(text, row, seed))
    trace = F.upper(F.lpad(F.hex(_draw(seed, row, "trace", 0, 2**32 - 1)), 8, "0"))
    tag = F.concat(F.lit("["), F.array(*map(F.lit, PREFIXES))[_draw(seed, row, "prefix", 0, len(PREFIXES) - 1).cast("int")], F.lit("] TRACE_ID:"), trace)
    headed = [(text.rlike(pattern), F.concat(*[tag if x is None else F.lit(x) for x in (*template.partition("{}")[:1], None, template.partition("{}")[2])])) for pattern, template in HEADERS]
    return F.concat(F.coalesce(*[F.when(kind, header) for kind, header in headed]), out)


def replicate(seeds: DataFrame, target: int, *, order: str, amount: str = "amount", narrative: str = "narrative", key: str = "audit_uuid", seed: int = 7) -> DataFrame:
    """``target`` rows, the seeds over and over in order: a new key each, the amount varied by up to 5 %, the narrative mutated.

    Seeds are few by nature; they are numbered once and joined to the row numbers.
    """
    spark = seeds.sparkSession
    n = seeds.count()
    numbered = spark.createDataFrame([(i, *r) for i, r in enumerate(seeds.orderBy(order).collect())], "__k long, " + ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in seeds.schema.fields))
    rows = spark.range(target if n else 0).withColumnRenamed("id", "row").withColumn("__k", F.col("row") % max(1, n)).join(F.broadcast(numbered), "__k")
    share = 0.95 + _draw(seed, F.col("row"), "amount", 0, 1_000_000) / 10_000_000.0
    digest = F.md5(F.concat_ws("|", F.lit(seed), "row"))
    uuid = F.concat_ws("-", *[F.substring(digest, a, b) for a, b in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    return rows.withColumn(key, uuid).withColumn(amount, F.round(F.col(amount) * share, 2)).withColumn(narrative, mutate(F.col(narrative), F.col("row"), seed)).drop("__k")


def as_landing_text(docs: DataFrame, marker: str = "DOCUMENT BOUNDARY") -> DataFrame:
    """One line-feed separated text per landed file: documents, each followed by a boundary among blank lines."""
    parts = docs.groupBy("file").agg(F.array_sort(F.collect_list(F.struct("seq", "text"))).alias("d"))
    return parts.select("file", F.concat(F.array_join(F.col("d.text"), f"\n\n--- {marker} ---\n\n"), F.lit(f"\n\n--- {marker} ---\n\n")).alias("value"))
