"""Near-duplicate documents by HyperMinHash, with exact links.

A document is its set of distinct five-word shingles. Sets are sketched into 256 registers: the top byte of a
shingle's hash picks the register, which stores the least remaining value as its leading-zero count and ten mantissa
bits. Documents with equal sets form one class and only classes are compared. Bands of compressed registers give
candidates; a register that is empty has, in bands, the minimum of the whole set under a hash of its own, so every register
of two sets is equal with the chance of their similarity. Sets of up to ``SMALL`` shingles meet by their prefix under a
fixed order, which loses no pair. A candidate's similarity is estimated from the registers, less the collisions expected by
chance, and what may reach the threshold is verified on the full sets.

Pairs in a band's bucket are not expanded. Every member meets the bucket's centre, another one in each band, in two
turns; members already connected then need no pair of their own, and only buckets that still hold several components are
compared, on full sets: the members outside of the bucket's largest component, in chunks of about ``BLOCK`` shingles, with all
members, in chunks of about ``PART``; only links are given out. So a group of near copies makes about its size times the number of bands
rows, not its square, and is copied once for each block of outsiders.

Defined cases: null and empty texts and texts without words have no shingles, link with nothing and are their own
component; texts under five words are one shingle; rows that share a doc_id with equal texts get the same result; a
null doc_id is never a component's id unless there is no other; other columns play no part and are carried through by
``drop_near_duplicates``, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import packed, small, unpacked, written
from .components import components
from .shingles import mix, shingle_set

WORDS = 5
REGISTERS, MANTISSA, REST = 256, 10, 56
BAND, BANDS = 4, 34
#: The share of buckets, one in so many, whose stars are looked at first.
EARLY = 8
SMALL = 40
#: Shingles of a chunk of a bucket's outsiders, and of all its members.
BLOCK, PART = 60_000, 15_000


def compressed(minima: np.ndarray, bits: int) -> np.ndarray:
    """1, leading zeros of a number of ``bits`` bits, and the mantissa's first bits."""
    part, exponent = np.frexp(minima.astype(np.float64))
    zeros = np.minimum(bits - exponent, bits)
    mantissa = np.clip((part - 0.5) * 2 * (1 << MANTISSA), 0, (1 << MANTISSA) - 1).astype(np.int64)
    return 1 + (zeros.astype(np.int64) << MANTISSA) + mantissa


def registers(shingles: np.ndarray) -> np.ndarray:
    """256 compressed minima of a sorted set of hashes; 0 where a register is empty."""
    out = np.zeros(REGISTERS, np.uint16)
    bucket = (shingles >> np.uint64(REST)).astype(np.int64)
    first = np.flatnonzero(np.diff(bucket, prepend=-1))
    out[bucket[first]] = compressed(shingles[first] & np.uint64((1 << REST) - 1), REST)
    return out


#: The registers of the bands, in a fixed shuffled order.
_ORDER = np.argsort(mix(np.arange(REGISTERS, dtype=np.uint64) + np.uint64(977)))[: BANDS * BAND]
_SEEDS = mix(np.arange(BANDS * BAND, dtype=np.uint64) + np.uint64(31337))


def band_keys(shingles: np.ndarray, regs: np.ndarray) -> np.ndarray:
    """A key for each band of ``BAND`` registers of a set."""
    values = regs[_ORDER].astype(np.uint64)
    empty = np.flatnonzero(values == 0)
    if len(empty):
        values[empty] = compressed(mix(shingles[None, :] ^ _SEEDS[empty, None]).min(1), 64)
    rows = values.reshape(BANDS, BAND)
    key = np.arange(BANDS, dtype=np.uint64) + np.uint64(1)
    for k in range(BAND):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + rows[:, k])
    return key


def set_keys(shingles: np.ndarray, regs: np.ndarray, num: int, den: int) -> np.ndarray:
    """The keys by which a set meets others."""
    n, out = len(shingles), []
    if 0 < n <= SMALL * den // num + 1:
        out.append(mix(prefix_keys(shingles, num, den)))
    if n > SMALL:
        out.append(band_keys(shingles, regs))
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def prefix_keys(shingles: np.ndarray, num: int, den: int) -> np.ndarray:
    """The least hashes of a set of which any set at least ``num/den`` similar shares one."""
    n = len(shingles)
    return shingles[: n - -(-n * num // den) + 1]


def chance(n: np.ndarray) -> np.ndarray:
    """For each set size, the chance that a register's minimum has each leading-zero count."""
    zeros = np.arange(REST + 1)
    rate = np.asarray(n, float)[..., None] / REGISTERS
    return np.exp(-rate * 0.5 ** (zeros + 1)) - np.exp(-rate * 0.5**zeros)


def may_reach(equal, either, by_chance, threshold: float):
    """Whether sets with ``equal`` of ``either`` non-empty registers equal may be that similar: the estimate is corrected
    by the collisions of different minima, with five standard deviations to spare."""
    either = np.maximum(either, 1)
    estimate = (equal - REGISTERS * by_chance * (1 - np.minimum(1, equal / either))) / either
    return estimate >= threshold - 5 * np.sqrt(threshold * (1 - threshold) / either)


def signatures(docs: DataFrame, num: int, den: int) -> DataFrame:
    """(doc_id, version, n_shingles, h1, h2, regs, keys): one read of the texts.

    version tells texts of one doc_id apart; h1 and h2 are 128 bits of the set, null without shingles; keys are those by
    which it meets others.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, version long, n_shingles long, h1 long, h2 long, regs binary, keys binary"

    def work(batches):
        for batch in batches:
            n, h1, h2, regs, keys = [], [], [], [], []
            for value in batch.column("text"):
                found = shingle_set(value.as_py(), WORDS)
                n.append(len(found))
                digest = hashlib.blake2b(found.tobytes(), digest_size=16).digest()
                h1.append(int.from_bytes(digest[:8], "little", signed=True) if len(found) else None)
                h2.append(int.from_bytes(digest[8:], "little", signed=True) if len(found) else None)
                own = registers(found)
                regs.append(own.tobytes() if len(found) else None)
                keys.append(set_keys(found, own, num, den).tobytes() or None)
            columns = [batch.column("doc_id"), batch.column("version"), *(pa.array(x, pa.int64()) for x in (n, h1, h2)), pa.array(regs, pa.binary()), pa.array(keys, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "version", "n_shingles", "h1", "h2", "regs", "keys"])

    return docs.select("doc_id", F.xxhash64("text").alias("version"), "text").mapInArrow(work, schema)


def set_classes(signed: DataFrame) -> DataFrame:
    """(node, h1, h2, doc_id, version, n_shingles, regs, keys): a row per distinct set, with its least document.
    Copies are merged before the shuffle, so a large group of them weighs no more than another."""
    least = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "version", "n_shingles", "regs", "keys")).alias("m")
    return signed.where("n_shingles > 0").groupBy("h1", "h2").agg(least).select(F.monotonically_increasing_id().alias("node"), "h1", "h2", "m.doc_id", "m.version", "m.n_shingles", "m.regs", "m.keys")


def bucket_rows(classes: DataFrame) -> DataFrame:
    """(key, x): a row for each class and band or prefix shingle. x is the node hidden by the key, so that the least x of
    a bucket is another member in each band."""

    def work(batches):
        for batch in batches:
            nodes, keys = [], []
            for node, own in zip(*(batch.column(c).to_pylist() for c in ("node", "keys")), strict=True):
                keys.append(np.frombuffer(own, np.int64))
                nodes.append(np.full(len(keys[-1]), node, np.int64))
            if keys:
                key = np.concatenate(keys)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(np.concatenate(nodes) ^ key)], names=["key", "x"])

    return classes.select("node", "keys").mapInArrow(work, "key long, x long")


def full_sets(nodes: DataFrame, docs: DataFrame, classes: DataFrame) -> DataFrame:
    """(node, shingles): the full sets of these classes, from their whole texts. Texts are read once; they are shuffled only if
    the classes are too many to be broadcast."""
    nodes = written(nodes.join(classes.select("node", F.col("doc_id").alias("own_id"), F.col("version").alias("own_version")), "node"), "neardup-nodes")
    wanted = small(nodes, nodes.count())
    texts = docs.select("doc_id", "text").join(wanted, F.col("doc_id").eqNullSafe(F.col("own_id")) & (F.xxhash64("text") == F.col("own_version"))).select("node", "text")

    def work(batches):
        for batch in batches:
            values = [shingle_set(x.as_py(), WORDS).view(np.int64) for x in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(values, pa.list_(pa.int64()))], names=["node", "shingles"])

    return written(texts.mapInArrow(work, "node long, shingles array<bigint>"), "neardup-sets", as_dealt=True)


def estimated(pairs: DataFrame, classes: DataFrame, num: int, den: int) -> DataFrame:
    """``pairs`` (a, b) whose sizes and registers allow the similarity."""
    one = classes.select(F.col("node").alias("a"), F.col("n_shingles").alias("na"), F.col("regs").alias("ra"))
    two = classes.select(F.col("node").alias("b"), F.col("n_shingles").alias("nb"), F.col("regs").alias("rb"))
    joined = pairs.join(one, "a").join(two, "b").where((F.col("na") * den >= F.col("nb") * num) & (F.col("nb") * den >= F.col("na") * num))

    def work(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            ra = np.frombuffer(b"".join(batch.column("ra").to_pylist()), np.uint16).reshape(-1, REGISTERS)
            rb = np.frombuffer(b"".join(batch.column("rb").to_pylist()), np.uint16).reshape(-1, REGISTERS)
            na, nb = np.array(batch.column("na").to_pylist()), np.array(batch.column("nb").to_pylist())
            equal = ((ra == rb) & (ra > 0)).sum(1)
            either = ((ra > 0) | (rb > 0)).sum(1)
            by_chance = (chance(na) * chance(nb)).sum(1) / (1 << MANTISSA)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(may_reach(equal, either, by_chance, num / den)))

    return joined.select("a", "b", "na", "nb", "ra", "rb").mapInArrow(work, "a long, b long")


def verified(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The links among ``pairs``, on full sets."""
    one, two = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa")), sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
    common = F.size(F.array_intersect("sa", "sb"))
    union = F.size("sa") + F.size("sb") - common
    return pairs.join(one, "a").join(two, "b").where(common * den >= union * num).select("a", "b")


class Postings:
    """Sorted sets, to tell how many values each shares with another one."""

    def __init__(self, sets: list[np.ndarray]):
        self.sets = sets
        values, owners = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(x) for x in sets])
        order = np.argsort(values, kind="stable")
        self.values, self.owners = values[order], owners[order]

    def overlaps(self, own: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How many values of ``own`` each of the sets ``at`` has too."""
        if len(at) > 40:
            lo, hi = np.searchsorted(self.values, own, "left"), np.searchsorted(self.values, own, "right")
            size = hi - lo
            rows = np.repeat(lo - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(int(size.sum()))
            return np.bincount(self.owners[rows], minlength=len(self.sets))[at]
        out = np.zeros(len(at), np.int64)
        for k, i in enumerate(at):
            other = self.sets[i]
            found = np.searchsorted(other, own)
            out[k] = np.count_nonzero(other[np.minimum(found, len(other) - 1)] == own)
        return out


def compare_block(one: list[np.ndarray], two: list[np.ndarray], allowed: np.ndarray, key: int, num: int, den: int) -> Iterator[tuple[int, int]]:
    """(index in one, index in two) of the links among ``allowed`` pairs of sets that share the bucket ``key``. A pair that shares
    several buckets is met in the first of its bands."""

    def sides(sets, none):
        regs = np.stack([registers(x) for x in sets])
        keys = np.full((len(sets), BANDS), none, np.uint64)  # ``none`` differs between the sides, so it never meets itself
        for row, r, x in zip(keys, regs, sets, strict=True):
            if len(x) > SMALL:
                row[:] = band_keys(x, r)
        return regs, keys.view(np.int64), np.array([len(x) for x in sets])

    rows = np.flatnonzero(allowed.any(1))
    if not len(rows):
        return
    (regs_one, keys_one, n_one), (regs_two, keys_two, n_two) = sides(one, 0), sides(two, 1)
    likely, postings = chance(n_two), Postings(two)
    for k in rows:
        n = n_one[k]
        at = np.flatnonzero(allowed[k] & (n_two * den >= n * num) & (n * den >= n_two * num))
        if len(at) and n > SMALL and (keys_one[k] == key).any():
            band = np.flatnonzero(keys_one[k] == key)[0]
            at = at[((keys_two[at] == keys_one[k]).argmax(1) == band) | (n_two[at] <= SMALL)]
        if not len(at):
            continue
        equal = ((regs_two[at] == regs_one[k]) & (regs_one[k] > 0)).sum(1)
        either = ((regs_two[at] > 0) | (regs_one[k] > 0)).sum(1)
        at = at[may_reach(equal, either, likely[at] @ chance(n) / (1 << MANTISSA), num / den)]
        common = postings.overlaps(one[k], at)
        for i in at[common * den >= (n + n_two[at] - common) * num]:
            yield k, i


def cross_links(members: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """(a, b): the links between components in buckets that hold several, of members (key, node, label, n_shingles), found on
    full sets in blocks.

    A bucket's members, and those outside of its largest component once more, are cut into chunks of bounded size by hash of
    the node; each chunk of outsiders meets each of all members in a group of its own, so a group's size is bounded
    and only links leave it.
    """
    each = members.groupBy("key", "label").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("w"))
    top = each.groupBy("key").agg(F.max(F.struct("n", "label", "w")).alias("top"), F.sum("w").alias("w"), F.count("*").alias("labels")).where("labels > 1")
    chunks = lambda w, size: F.greatest(F.ceil(w / F.lit(size)), F.lit(1)).cast("int")
    top = top.select("key", F.col("top.label").alias("main"), chunks(F.col("w"), PART).alias("n_all"), chunks(F.col("w") - F.col("top.w"), BLOCK).alias("n_out"))
    rows = members.select("key", "node", "label").join(top, "key").join(sets, "node").withColumn("out", F.col("label") != F.col("main"))
    dealt = lambda n, salt: F.pmod(F.xxhash64(F.lit(salt), "node"), F.col(n)).cast("int")
    upto = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    mine = rows.where("out").select("key", dealt("n_out", 1).alias("i"), upto("n_all").alias("j"), F.lit(True).alias("asks"), "out", "node", "label", "shingles")
    every = rows.select("key", upto("n_out").alias("i"), dealt("n_all", 2).alias("j"), F.lit(False).alias("asks"), "out", "node", "label", "shingles")

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        one, two = frame[frame["asks"]], frame[~frame["asks"]]
        found = []
        if len(one) and len(two):
            a, b = one["node"].to_numpy(np.int64), two["node"].to_numpy(np.int64)
            # two outsiders are met once, from the lesser one
            allowed = (one["label"].to_numpy(np.int64)[:, None] != two["label"].to_numpy(np.int64)[None, :]) & (~two["out"].to_numpy(bool)[None, :] | (a[:, None] < b[None, :]))
            sets_ = [[np.asarray(x, np.int64).view(np.uint64) for x in f["shingles"]] for f in (one, two)]
            found = [(min(a[k], b[m]), max(a[k], b[m])) for k, m in compare_block(*sets_, allowed, int(frame["key"].iloc[0]), num, den)]
        return pd.DataFrame({"a": np.array([x[0] for x in found], np.int64), "b": np.array([x[1] for x in found], np.int64)})

    return mine.unionByName(every).groupBy("key", "i", "j").applyInPandas(compare, "a long, b long").distinct()


def links(docs: DataFrame, classes: DataFrame, num: int, den: int) -> DataFrame:
    """(node, label) of the classes that are linked."""
    rows = written(bucket_rows(classes), "neardup-bands")
    held = rows.groupBy("key").agg(F.min("x").alias("c"), F.count("*").alias("n")).where("n > 1")
    met = written(rows.join(held, "key").where("x <> c").select("key", F.col("x").bitwiseXOR(F.col("key")).alias("node"), F.col("c").bitwiseXOR(F.col("key")).alias("centre")), "neardup-buckets")
    # whoever shares a bucket may have to be verified, at one turn or another
    sets = full_sets(met.select("node").union(met.select(F.col("centre").alias("node"))).distinct(), docs, classes)
    pair = [F.least("node", "centre").alias("a"), F.greatest("node", "centre").alias("b")]

    def linked(pairs):
        pairs = written(pairs, "neardup-stars")
        return written(verified(written(estimated(pairs, classes, num, den), "neardup-likely"), sets, num, den), "neardup-links")

    # a few of every class's stars connect most of a large group; of the others only those between components are left
    sure = linked(met.where(F.pmod("key", F.lit(EARLY)) == 0).select(*pair).distinct())
    labels = components(sure, least=False)
    one, two = (labels.select(F.col("node").alias(v), F.col("label").alias(f"label_{v}")) for v in ("a", "b"))
    late = met.where(F.pmod("key", F.lit(EARLY)) != 0).select(*pair).distinct().join(one, "a", "left").join(two, "b", "left")
    late = late.where(F.coalesce("label_a", "a") != F.coalesce("label_b", "b")).select("a", "b")
    sure = sure.unionByName(linked(late))
    labels = components(sure, least=False)
    member = met.select("key", "node").join(labels, "node", "left").join(classes.select("node", "n_shingles"), "node")
    member = written(member.select("key", "node", F.coalesce("label", "node").alias("label"), "n_shingles"), "neardup-members")
    more = written(cross_links(member, sets, num, den), "neardup-links")
    if more.limit(1).count():
        labels = components(sure.unionByName(more), least=False)
    return labels


def near_duplicates(docs: DataFrame, *, num: int = 75, den: int = 100) -> DataFrame:
    """(doc_id, version, n_shingles, component_id, kept) for every row; links have den * |A & B| >= num * |A | B|."""
    signed = written(signatures(docs, num, den), "neardup-signatures", as_dealt=True)
    classes = written(set_classes(signed), "neardup-classes")
    labels = links(docs, classes, num, den)
    owned = written(classes.select("node", "h1", "h2", "doc_id").join(labels, "node", "left").select(F.coalesce("label", "node").alias("label"), "h1", "h2", "doc_id"), "neardup-owned")
    least = owned.groupBy("label").agg(F.min("doc_id").alias("component_id"), F.count("*").alias("classes"))
    merged = owned.join(least.where("classes > 1"), "label", "left").select("h1", "h2", F.coalesce("component_id", "doc_id").alias("component_id"))
    rows = signed.select("doc_id", "version", "n_shingles", "h1", "h2").join(merged, ["h1", "h2"], "left")
    found = F.coalesce("component_id", "doc_id")
    return rows.select("doc_id", "version", "n_shingles", found.alias("component_id"), F.col("doc_id").eqNullSafe(found).alias("kept"))


def drop_near_duplicates(docs: DataFrame, *, num: int = 75, den: int = 100) -> DataFrame:
    """The rows of ``docs`` that stand for their component, in full and with the columns of ``docs``."""
    gone = near_duplicates(docs, num=num, den=den).where("not kept").select(F.col("doc_id").alias("gone_id"), F.col("version").alias("gone_version")).distinct()
    gone = written(gone, "neardup-gone")
    rows = packed(docs, "doc_id", "text").select("row", "doc_id", F.xxhash64("text").alias("version"))
    stays = rows.join(small(gone, gone.count()), F.col("doc_id").eqNullSafe(F.col("gone_id")) & (F.col("version") == F.col("gone_version")), "left_anti")
    return stays.select(*unpacked(docs.columns))


#: The same in DuckDB, on the shingles themselves.
SQL = r"""
with recursive words as (
  select doc_id, list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') as w
  from documents where text is not null
), s as (
  select distinct doc_id, array_to_string(w[i:i + 4], ' ') as g from (select doc_id, w, unnest(range(1, len(w) - 3)) as i from words where len(w) >= 5)
  union all select doc_id, 'short ' || array_to_string(w, ' ') from words where len(w) between 1 and 4
), n as (select doc_id, count(*) as n from s group by doc_id),
common as (select a.doc_id as a, b.doc_id as b, count(*) as c from s a join s b on a.g = b.g and a.doc_id <> b.doc_id group by 1, 2),
links as (select a, b from common join n x on x.doc_id = a join n y on y.doc_id = b where 100 * c >= 75 * (x.n + y.n - c)),
reach(id, root) as (
  select doc_id, doc_id from documents
  union select l.b, r.root from reach r join links l on l.a = r.id where r.root < l.b
), least_root as (select id, min(root) as component_id from reach group by id)
select d.doc_id, coalesce(n.n, 0) as n_shingles, r.component_id, d.doc_id = r.component_id as kept
from documents d left join n using (doc_id) join least_root r on r.id = d.doc_id
"""
