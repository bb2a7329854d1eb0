"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming search, exact weighted similarity.

A document holds an item if some window of it, of as many five-word shingles as the item has, is at least 75 %
similar to the item: sum of minimal over sum of maximal shingle counts. Windows start at every word, for items of 256
shingles and more at every (n div 128)th, so that a document that holds a long item has windows by its length and not by
the item's square; a copy then still has 98 % in common with a window. A document shorter than an item is one window.

* Only windows that can qualify are fingerprinted: a window that similar shares one of the item's rarest shingles
  (the quarter by which it may differ, and one more), so starts are those that cover such a shingle. This loses nothing.
* A fingerprint has 64 bits, each the majority of that bit over the hashes of the window's shingles and their occurrences
  (first, second, ...), so that distances follow the weighted similarity of windows with repeated shingles, too.
* Fingerprints are cut into eight blocks of eight bits. Within ``RADIUS`` = 23 bits, one block differs in at most two
  (eight blocks with three or more would be 24), so items are indexed under all 37 values that near for each block,
  and every pair within the radius meets. What the radius itself misses is measured in the README.
* Pairs within the radius are verified on the windows' shingles themselves.

Only DataFrame functions are used. Defined cases: null and empty texts, and texts and items of fewer than five words,
have no shingles and match nothing; texts and items are of any length (counters of a fingerprint hold 2^31 shingles); items that share an id or a text are compared each on its own; documents equal in
doc_id and text give one row per item; null ids are kept as such; other columns, of any name, play no part and come through ``drop_contaminated``; without items or
documents there are no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import SPACES, bind, packed, small, unpacked, word_count, written

WORDS = 5
BLOCKS, NEAR = 8, 2
RADIUS = BLOCKS * (NEAR + 1) - 1
#: Rows of the item index up to which it is broadcast (three longs each); beyond it, it is shuffled.
INDEX_ROWS = 400_000
#: Windows of an item of n shingles start at every (n div STARTS)th word.
STARTS = 128
LANES = 32  # longs that hold the 64 counters, two of 32 bits each


def shingle_array(text: Column) -> Column:
    """Hashes of every run of five words, in order; null with fewer."""
    words = F.filter(F.split(F.lower(text), SPACES), lambda w: w != "")
    runs = lambda w: F.transform(F.sequence(F.lit(1), F.size(w) - (WORDS - 1)), lambda i: F.xxhash64(F.slice(w, i, WORDS)))
    return bind(words, lambda w: F.when(F.size(w) >= WORDS, runs(w)))


def lanes(h: Column) -> list[Column]:
    """The bits of a hash, two to a long, 32 bits apart, ready to be summed."""
    bit = lambda b: F.shiftright(h, b).bitwiseAND(F.lit(1).cast("long"))
    return [bit(2 * j).bitwiseOR(F.shiftleft(bit(2 * j + 1), 32)) for j in range(LANES)]


def fingerprints(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``keys`` and fp, the SimHash of the shingles in ``sh``, told apart by occurrence: a shingle that occurs k times counts
    with k, not its square."""
    each = rows.select(*keys, F.explode(tagged(F.col("sh"))).alias("h"))
    sums = each.groupBy(*keys).agg(F.count("*").alias("m"), *[F.sum(x).alias(f"s{j}") for j, x in enumerate(lanes(F.col("h")))])
    count = lambda b: F.shiftrightunsigned(f"s{b // 2}", 32 * (b % 2)).bitwiseAND(F.lit(0xFFFFFFFF).cast("long"))
    bits = [F.when(count(b) * 2 > F.col("m"), F.lit((1 << b) if b < 63 else -(1 << 63)).cast("long")).otherwise(F.lit(0).cast("long")) for b in range(64)]
    while len(bits) > 1:
        bits = [x.bitwiseOR(y) for x, y in zip(bits[::2], bits[1::2], strict=True)]
    return sums.select(*keys, bits[0].alias("fp"))


def block(fp: Column, b: int) -> Column:
    return F.shiftrightunsigned(fp, 8 * b).bitwiseAND(F.lit(0xFF).cast("long"))


def least_common(n: Column, num: int, den: int) -> Column:
    """Shingles that a similar window has in common with an item of n at least."""
    return F.ceil(n * F.lit(num) / F.lit(den))


def item_tables(items: DataFrame, num: int, den: int) -> tuple[DataFrame, DataFrame]:
    """(iid, item_id, n, sh, fp) per item, and (s, n): the rare shingles by which items are found and the items' sizes."""
    rows = items.select("item_id", "text").distinct().withColumn("iid", F.xxhash64(F.coalesce(F.col("item_id").cast("string"), F.lit("null")), "text"))
    rows = written(rows.select("iid", "item_id", shingle_array(F.col("text")).alias("sh")), "decon-shingles").where("sh is not null").withColumn("n", F.size("sh")).dropDuplicates(["iid"])
    rows = written(rows, "decon-items")
    each = rows.select("iid", "n", F.explode("sh").alias("s"))
    spread = each.groupBy("s").agg(F.count_distinct("iid").alias("items"))
    rank = F.row_number().over(Window.partitionBy("iid").orderBy("items", "s"))
    rare = each.join(spread, "s").withColumn("r", rank).where(F.col("r") <= F.col("n") - least_common(F.col("n"), num, den) + 1)
    full = rows.join(fingerprints(rows, ["iid"]), "iid")
    return written(full, "decon-items-fp"), written(rare.select("s", "n").distinct(), "decon-rare")


def multi_index(items: DataFrame) -> DataFrame:
    """(n, b, value, iid, ifp): items under every value within two bits of each block."""
    masks = [m for m in range(256) if m.bit_count() <= NEAR]
    blocks = F.array(*[F.struct(F.lit(b).alias("b"), block(F.col("fp"), b).alias("v")) for b in range(BLOCKS)])
    each = items.select("n", "iid", F.col("fp").alias("ifp"), F.inline(blocks))
    return each.select("n", "iid", "ifp", "b", "v", F.explode(F.array(*[F.lit(m).cast("long") for m in masks])).alias("mask")).select("n", "b", F.col("v").bitwiseXOR(F.col("mask")).alias("value"), "iid", "ifp")


def windows(docs: DataFrame, rare: DataFrame, n_rare: int) -> DataFrame:
    """(doc_id, version, start, n, sh): the windows that cover a rare shingle of an item of n shingles."""
    keyed = docs.select("doc_id", F.xxhash64("text").alias("version"), "text")
    found = keyed.select("doc_id", "version", (word_count(F.col("text")) - (WORDS - 1)).cast("int").alias("m"), F.posexplode(shingle_array(F.col("text"))).alias("pos", "s"))
    index = F.broadcast(rare) if n_rare <= INDEX_ROWS else rare
    anchors = found.join(index, "s").select("doc_id", "version", "n", F.greatest(F.lit(0), F.col("pos") - F.col("n") + 1).alias("lo"), F.greatest(F.lit(0), F.least(F.col("pos"), F.col("m") - F.col("n"))).alias("hi"))
    anchors = written(anchors.distinct(), "decon-anchors")
    step = F.greatest(F.expr(f"cast(n div {STARTS} as int)"), F.lit(1))
    first = F.least("lo", "hi") - F.least("lo", "hi") % step
    starts = anchors.select("doc_id", "version", "n", F.explode(F.sequence(first, F.col("hi"), step)).alias("start")).distinct()
    each = written(starts.groupBy("doc_id", "version").agg(F.collect_set(F.struct("start", "n")).alias("ws")), "decon-starts")
    wanted = small(each.select(F.col("doc_id").alias("__id"), F.col("version").alias("__version"), "ws"), each.count())
    texts = keyed.join(wanted, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("version") == F.col("__version"))).select("doc_id", "version", "text", "ws").dropDuplicates(["doc_id", "version"])
    each = texts.select("doc_id", "version", shingle_array(F.col("text")).alias("sh"), "ws").select("doc_id", "version", "sh", F.explode("ws").alias("w"))
    return each.select("doc_id", "version", F.col("w.start").alias("start"), F.col("w.n").alias("n"), F.slice("sh", F.col("w.start") + 1, F.col("w.n")).alias("sh"))


def tagged(sh: Column) -> Column:
    """Shingles told apart by occurrence, so that sets of them have the multisets' minima and maxima; in no particular order.

    In a sorted array the occurrences before one are its equals to the left; how many there are is found by halving steps.
    """
    steps = F.array(*[F.lit(1 << k) for k in range(30, -1, -1)])

    def before(a, x, i):
        return F.aggregate(steps, F.lit(0), lambda d, k: F.when((i - d >= k) & (F.get(a, i - d - k) == x), d + k).otherwise(d))

    nth = bind(F.array_sort(sh), lambda a: F.transform(a, lambda x, i: F.xxhash64(x, before(a, x, i))))
    first = F.transform(sh, lambda x: F.xxhash64(x, F.lit(0)))
    return F.when(F.size(F.array_distinct(sh)) == F.size(sh), first).otherwise(nth)


def contaminated(docs: DataFrame, items: DataFrame, *, num: int = 75, den: int = 100) -> DataFrame:
    """(doc_id, version, item_id, similarity, start, n_words, n_windows): every document and item that it holds, with the
    best window's similarity and where it starts (in words)."""
    known, rare = item_tables(items, num, den)
    made = written(windows(docs, rare, rare.count()), "decon-windows")
    prints = fingerprints(made, ["doc_id", "version", "start", "n"])
    index = multi_index(known.select("n", "iid", "fp"))
    blocks = F.array(*[F.struct(F.lit(b).alias("b"), block(F.col("fp"), b).alias("value")) for b in range(BLOCKS)])
    probes = prints.select("doc_id", "version", "start", "n", "fp", F.inline(blocks))
    n_index = known.count() * BLOCKS * (1 + BLOCKS + BLOCKS * (BLOCKS - 1) // 2)
    met = probes.join(F.broadcast(index) if n_index <= INDEX_ROWS else index, ["n", "b", "value"])
    off = F.col("fp").bitwiseXOR(F.col("ifp"))
    before = reduce(lambda x, y: x & y, [(F.col("b") <= b) | (F.bit_count(block(off, b)) > NEAR) for b in range(BLOCKS - 1)])
    near = met.where((F.bit_count(off) <= RADIUS) & before).select("doc_id", "version", "start", "n", "iid")  # each pair once, at its first near block
    sides = near.join(small(known.select("iid", "item_id", F.col("sh").alias("ish")), known.count()), "iid")
    w, s = made.alias("w"), sides.alias("s")
    same = F.col("w.doc_id").eqNullSafe(F.col("s.doc_id")) & (F.col("w.version") == F.col("s.version")) & (F.col("w.start") == F.col("s.start")) & (F.col("w.n") == F.col("s.n"))
    pairs = w.join(s, same).select("w.doc_id", "w.version", "w.start", "w.n", "iid", "item_id", "ish", "sh")
    common = F.size(F.array_intersect(tagged(F.col("sh")), tagged(F.col("ish"))))
    pairs = pairs.withColumn("common", common).withColumn("union", F.size("sh") + F.size("ish") - F.col("common"))
    good = pairs.where(F.col("common") * den >= F.col("union") * num).withColumn("similarity", F.col("common") / F.col("union"))
    best = good.groupBy("doc_id", "version", "iid", "item_id").agg(F.max(F.struct("similarity", (-F.col("start")).alias("back"), "n")).alias("best"), F.count("*").alias("n_windows"))
    return best.select("doc_id", "version", "item_id", F.col("best.similarity").alias("similarity"), (-F.col("best.back")).alias("start"), (F.col("best.n") + WORDS - 1).alias("n_words"), "n_windows")


def drop_contaminated(docs: DataFrame, items: DataFrame, *, num: int = 75, den: int = 100) -> DataFrame:
    """``docs`` without those that hold an item."""
    bad = written(contaminated(docs, items, num=num, den=den).select(F.col("doc_id").alias("bad_id"), F.col("version").alias("bad_version")).distinct(), "decon-bad")
    rows = packed(docs, "doc_id", "text").select("row", "doc_id", F.xxhash64("text").alias("version"))
    clean = rows.join(small(bad, bad.count()), F.col("doc_id").eqNullSafe(F.col("bad_id")) & (F.col("version") == F.col("bad_version")), "left_anti")
    return clean.select(*unpacked(docs.columns))


#: The same in DuckDB, window by window, for documents that share a shingle with an item.
SQL = r"""
with dw as (select doc_id, list_filter(regexp_split_to_array(lower(text), '[\x20\x09-\x0D]+'), lambda w: w <> '') as w from documents where text is not null),
bw as (select distinct item_id, list_filter(regexp_split_to_array(lower(text), '[\x20\x09-\x0D]+'), lambda w: w <> '') as w from benchmark where text is not null),
d as (select doc_id, len(w) - 4 as m, i - 1 as pos, array_to_string(w[i:i + 4], ' ') as g from (select doc_id, w, unnest(range(1, len(w) - 3)) as i from dw where len(w) >= 5)),
b as (select item_id, len(w) - 4 as n, array_to_string(w[i:i + 4], ' ') as g from (select item_id, w, unnest(range(1, len(w) - 3)) as i from bw where len(w) >= 5)),
bc as (select item_id, n, g, count(*) as c from b group by item_id, n, g),
pairs as (select distinct d.doc_id, d.m, b.item_id, b.n from d join b on d.g = b.g),
windows as (select doc_id, item_id, m, n, unnest(range(0, greatest(m - n, 0) + 1, greatest(n // 128, 1))) as start from pairs),
counts as (select w.doc_id, w.item_id, w.m, w.n, w.start, d.g, count(*) as c from windows w join d on d.doc_id = w.doc_id and d.pos >= w.start and d.pos < w.start + w.n group by all),
common as (select x.doc_id, x.item_id, least(x.m, x.n) as size, x.n, x.start, sum(least(x.c, y.c)) as common from counts x join bc y on y.item_id = x.item_id and y.g = x.g group by all),
good as (select *, common / (size + n - common) as similarity from common where 100 * common >= 75 * (size + n - common))
select doc_id, item_id, max(similarity) as similarity, cast(min(start) filter (similarity = best) as integer) as start, cast(max(n) + 4 as integer) as n_words, count(*) as n_windows
from (select *, max(similarity) over (partition by doc_id, item_id) as best from good) group by doc_id, item_id
"""
