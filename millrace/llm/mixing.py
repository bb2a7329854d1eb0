"""Mixing sources to target weights: capped water-filling, then seeded whole and fractional repetitions.

Every source gets a share of all words by its weight. A source whose share would exceed ``max_epochs``
passes over its own words stops there, and what it leaves is shared again among the others by weight until
none is above its cap. A source then repeats all of its documents ``target div size`` times; the words that
are left are taken from its documents in a seeded order, the last of them only in part.

Defined cases: null text and texts without words have size 0 and are taken 0 times; a null source is a source
of its own, ordered last; a source without words has target 0; an empty table gives no rows. Repeated rows are
rows like any other, beside each other in the seeded order. ``mix_documents`` carries all columns through, whatever
their names; only an ``epoch`` of its own is replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import packed, small, unpacked, word_count, written

#: The seeded order of a source is cut into a power of two of ranges of about so many of all rows; only the range in which
#: a source's budget ends is sorted.
RANGE_ROWS = 512
KEY_BITS = 60


def sized(docs: DataFrame, seed: int) -> DataFrame:
    """doc_id, source, text as size (words) and key, the place in the seeded order; other columns stay."""
    digest = F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit("|"), F.coalesce("text", F.lit(""))).cast("binary"))
    key = F.conv(F.substring(digest, 1, KEY_BITS // 4), 16, 10).cast("long")
    return docs.withColumns({"size": word_count(F.col("text")), "key": key, "source": F.col("source").cast("string")}).drop("text")


def range_of(key: Column, bits: int) -> Column:
    return F.shiftrightunsigned(key, KEY_BITS - bits).cast("int")


def weighted_sources(rows: DataFrame, weights: Sequence[float]) -> tuple[DataFrame, int]:
    """(source, source_size, weight) in code-point order, null last, weights repeating; and the number of sources.

    The order is found by a range partitioning and per-partition counts, so no task holds all sources.
    """
    spark = rows.sparkSession
    totals = rows.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    ranged = totals.repartitionByRange(F.col("source").isNull(), F.col("source")).sortWithinPartitions(F.col("source").isNull(), "source")
    ranged = written(ranged.withColumn("at", F.monotonically_increasing_id()), "mix-sources")
    part = F.shiftrightunsigned("at", 33)
    counts = {r["part"]: r["n"] for r in ranged.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect()}  # a row per partition
    before, starts = 0, []
    for p in sorted(counts):
        starts.append((p, before))
        before += counts[p]
    starts = spark.createDataFrame(starts or [(0, 0)], "part long, start long")
    index = F.col("start") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(index, F.lit(len(weights))) + 1).cast("int"))
    sources = ranged.withColumn("part", part).join(F.broadcast(starts), "part").select("source", "source_size", weight.alias("weight"))
    return sources, before


def water_fill(sources: DataFrame, max_epochs: int) -> DataFrame:
    """Adds ``target`` (double): one small aggregate per round, until no further source reaches its cap."""
    cap = F.col("source_size") * F.lit(float(max_epochs))
    total, weight = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0.0))).first()
    level, stopped = (total / weight if weight else 0.0), 0
    while True:
        above = cap < F.lit(level) * F.col("weight")
        n, held, rest = sources.agg(F.count_if(above), F.sum(F.when(above, cap)), F.sum(F.when(~above, F.col("weight")))).first()
        if n == stopped:
            break
        stopped = n
        if not rest:
            break
        level = (total - (held or 0.0)) / rest
    return sources.withColumn("target", F.least(cap, F.lit(level) * F.col("weight")))


def plan(rows: DataFrame, *, weights: Sequence[float] = (5, 2, 1), max_epochs: int = 3) -> tuple[DataFrame, int, int]:
    """A row per source: its target, whole repetitions, and where in its seeded order the rest ends; the number of sources;
    and of bits of a range's number.

    ``rows`` has source, size and key; it is read three times.
    """
    sources, n = weighted_sources(rows, weights)
    filled = water_fill(written(sources, "mix-weights"), max_epochs)
    words = F.round("target").cast("long")
    whole = F.when(F.col("source_size") > 0, F.expr("cast(round(target) as bigint) div source_size")).otherwise(F.lit(0)).cast("long")
    filled = written(filled.withColumn("whole", whole).withColumn("rest", words - F.col("whole") * F.col("source_size")), "mix-targets")
    bits = max(2, min(24, (rows.count() // RANGE_ROWS).bit_length()))
    spread = rows.groupBy("source", range_of(F.col("key"), bits).alias("range")).agg(F.sum("size").alias("words"))
    upto = F.sum("words").over(Window.partitionBy("source").orderBy("range"))  # a row per range
    spread = spread.withColumn("before", upto - F.col("words"))
    s, f = spread.alias("s"), small(filled, n).alias("f")
    end = s.join(f, F.col("s.source").eqNullSafe(F.col("f.source"))).where("before < rest and rest <= before + words")
    end = written(end.select(F.col("s.source").alias("source"), F.col("range").alias("end_range"), (F.col("rest") - F.col("before")).alias("end_words")), "mix-ends")
    e = small(end, n).alias("e")
    full = filled.alias("f").join(e, F.col("f.source").eqNullSafe(F.col("e.source")), "left")
    return written(full.select("f.source", "source_size", "target", "whole", "rest", "end_range", "end_words"), "mix-plan"), n, bits


def take(rows: DataFrame, mix: DataFrame, n_sources: int, bits: int) -> DataFrame:
    """``rows`` (source, size, key and perhaps doc_id and row) with source_size, target, whole (repetitions), part (words of one
    repetition more) and taken."""
    r, m = rows.alias("r"), small(mix, n_sources).alias("m")
    joined = r.join(m, F.col("r.source").eqNullSafe(F.col("m.source"))).select("r.*", "m.source_size", "m.target", "m.whole", "m.rest", "m.end_range", "m.end_words")
    at = range_of(F.col("key"), bits)
    ends = (F.col("rest") > 0) & (at == F.col("end_range"))
    inside = F.when((F.col("rest") > 0) & (at < F.col("end_range")), F.col("size")).otherwise(F.lit(0))
    away = joined.where(~F.coalesce(ends, F.lit(False))).withColumn("part", inside.cast("long"))
    order = Window.partitionBy("source", at).orderBy("key", "size").rowsBetween(Window.unboundedPreceding, -1)
    left = F.col("end_words") - F.coalesce(F.sum("size").over(order), F.lit(0))
    near = joined.where(F.coalesce(ends, F.lit(False))).withColumn("part", F.greatest(F.lit(0), F.least(F.col("size"), left)).cast("long"))
    both = away.unionByName(near).withColumn("taken", F.col("whole") * F.col("size") + F.col("part"))
    return both.select(*rows.columns, "source_size", "target", "whole", "part", "taken")


def mix_plan(docs: DataFrame, *, weights: Sequence[float] = (5, 2, 1), max_epochs: int = 3, seed: int = 17) -> DataFrame:
    """Per document: doc_id, source, size, source_size, target, whole, part, taken. Texts are read once and never shuffled."""
    rows = written(sized(docs.select("doc_id", "source", "text"), seed), "mix-sizes", as_dealt=True)
    return take(rows, *plan(rows, weights=weights, max_epochs=max_epochs)).drop("key")


def mix_documents(docs: DataFrame, *, weights: Sequence[float] = (5, 2, 1), max_epochs: int = 3, seed: int = 17) -> DataFrame:
    """The mix itself: each document as often as it is taken, with ``epoch`` from 0. A partly taken repetition is
    given whole if at least half of its words are due, so texts are never cut."""
    columns = [c for c in docs.columns if c != "epoch"]
    rows = sized(packed(docs, "doc_id", "source", "text"), seed)
    found = plan(written(rows.select("source", "size", "key"), "mix-sizes", as_dealt=True), weights=weights, max_epochs=max_epochs)
    times = (F.col("whole") + F.when((F.col("part") > 0) & (F.col("part") * 2 >= F.col("size")), 1).otherwise(0)).cast("int")
    taken = take(rows, *found).withColumn("times", times).where("size > 0 and times > 0")
    return taken.select(*unpacked(columns), F.explode(F.sequence(F.lit(0), F.col("times") - 1)).alias("epoch"))


#: The same in DuckDB: a round of water-filling per source at most, then running sums in the seeded order.
SQL = r"""
with recursive d as (
  select doc_id, source, cast(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) as bigint) as size,
    substr(md5('17|' || coalesce(cast(doc_id as varchar), '') || '|' || coalesce(text, '')), 1, 15) as key from documents
), s as (
  select source, sum(size)::bigint as own, row_number() over (order by source is null, encode(source)) as k from d group by source
), w as (
  select source, own, cast(case (k - 1) % 3 when 0 then 5 when 1 then 2 else 1 end as double) as weight, 3.0::double * own as most from s
), fill as (
  select 0 as round, cast(sum(own) as double) / sum(weight) as level, cast(0 as bigint) as held from w
  union all
  select f.round + 1, (sum(w.own) - coalesce(sum(w.most) filter (w.most < f.level * w.weight), 0)) / sum(w.weight) filter (w.most >= f.level * w.weight), count(*) filter (w.most < f.level * w.weight)
  from fill f, w group by f.round, f.level, f.held having count(*) filter (w.most < f.level * w.weight) > f.held and count(*) filter (w.most >= f.level * w.weight) > 0
), last as (select level from fill order by round desc limit 1),
t as (select source, own, least(most, level * weight) as target from w, last),
p as (select *, case when own > 0 then cast(round(target) as bigint) // own else 0 end as whole from t),
o as (select *, sum(size) over (partition by source order by key, size rows between unbounded preceding and current row) - size as before from d)
select o.doc_id, o.size, p.own as source_size, p.target, o.source, p.whole, cast(greatest(0, least(o.size, cast(round(p.target) as bigint) - p.whole * p.own - o.before)) as bigint) as part,
  cast(p.whole * o.size + greatest(0, least(o.size, cast(round(p.target) as bigint) - p.whole * p.own - o.before)) as bigint) as taken
from o join p on o.source is not distinct from p.source
"""
